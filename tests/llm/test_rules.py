"""Quality rules against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postolake.llm import rules

from .helpers import prose

FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
WORD = re.compile("[^\x20\x09-\x0d]+")
CLASS = ["[A-Z]", "[0-9]", "[.,;:!?'\"()-]", "[^\x00-\x7f]", "[\x09-\x0d]", "[^A-Z0-9.,;:!?'\"()\\-\x09-\x0da-z \x80-\U0010ffff]", "[a-z ]"]


def base(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    symbols = len(re.findall("[#*$%&|<>]", text))
    return w, (len(w), sum(map(len, w)), symbols, dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w))


def distance(p, q):
    total = 0.0
    for a, b in zip(p, q):
        for x in (a, b):
            if x > 0:
                total += x / 2 * math.log2(2 * x / (a + b))
    return math.sqrt(max(total, 0.0))


def plain(rows, common=rules.COMMON, least=rules.REFERENCE_WORDS):
    words, chars, bases = {}, {}, []
    for _, text, lang, *_ in rows:
        w, b = base(text)
        sizes = [len(re.findall(c, text or "")) for c in CLASS]
        bases.append((w, b, sizes))
        if len(w) >= 50:
            words.setdefault(lang or "und", Counter()).update(w)
            own = chars.setdefault(lang or "und", [0] * 7)
            for k in range(7):
                own[k] += sizes[k]
    top = {k: sorted(c, key=lambda x: (-c[x], x.encode()))[:common] for k, c in words.items()}
    out = []
    for (doc_id, text, lang, *_), (w, b, sizes) in zip(rows, bases):
        lang, near = lang or "und", True
        total = sum(words.get(lang, Counter()).values())
        if total >= least:
            n = len(text or "")
            if n >= rules.MIN_CHARS:
                all_ = sum(chars[lang])
                d = distance([s / n for s in sizes], [s / all_ for s in chars[lang]])
                near &= d * d <= rules.CHAR_DISTANCE**2 + 6 / (8 * math.log(2) * n)
            if len(w) >= rules.MIN_WORDS:
                own = Counter(w)
                p = [own[x] / len(w) for x in top[lang]]
                q = [words[lang][x] / total for x in top[lang]]
                d = distance([*p, 1 - sum(p)], [*q, 1 - sum(q)])
                near &= d * d <= rules.WORD_DISTANCE**2 + len(p) / (8 * math.log(2) * len(w))
        out.append((doc_id, *b, not b[-1] and near))
    return out


def got(frame):
    return sorted((r["doc_id"], *(r[f] for f in FIELDS)) for r in frame.collect())


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for k in range(80):
        n = rng.randrange(1, 400)
        text = prose(seed * 1000 + k, n, 60 if k % 3 else 3000, "wé"[k % 2])
        if k % 7 == 0:
            text = text.upper()
        if k % 11 == 0:
            text = "\n".join([text, text, "", " \t", text[:20], text[:20]])
        if k % 13 == 0:
            text = " ".join(f"{w}{rng.choice('#*$%&|<>')}" for w in text.split())
        rows.append((k, text, ["en", "fr", None][k % 3]))
    return rows


def test_equals_plain_python(spark, docs):
    odd = ["", None, " \t\n ", "a b c", "a b c a b c", "x " * 60, "a b c d " * 40, "\n\n x\n x\n", "é😀\U0010ffff ^ \x00 ~ " * 30, "one\x0btwo\x1cthree " * 40]
    rows = corpus(3) + [(100 + k, t, "en") for k, t in enumerate(odd)]
    for least in (rules.REFERENCE_WORDS, 100):
        found = got(rules.apply_rules(docs(rows).repartition(4), reference_words=least))
        assert found == sorted(plain(rows, least=least))
    kept = [r[-1] for r in found]
    assert any(kept) and not all(kept)


def test_few_common_words_and_shuffled_references(spark, docs):
    rows = corpus(4)
    for limit in (rules.BROADCAST_BYTES, 0):
        found = got(rules.apply_rules(docs(rows), common=5, reference_words=100, broadcast_bytes=limit))
        assert found == sorted(plain(rows, common=5, least=100))


def test_without_a_free_shift_the_list_is_searched(spark, docs, monkeypatch):
    monkeypatch.setattr(rules, "SLOT_BITS", 5)  # 64 words never have 32 slots of their own
    rows = corpus(5)
    assert got(rules.apply_rules(docs(rows), reference_words=100)) == sorted(plain(rows, least=100))


def test_junk_goes_and_prose_stays(spark, docs):
    good = [(k, prose(k, 300, 200), "en") for k in range(60)]
    junk = [(100, prose(90, 300, 200).upper(), "en"), (101, " ".join(w + "&&&" for w in prose(91, 300, 200).split()), "en"), (102, prose(92, 300, 10**6, "q"), "en")]
    found = {r["doc_id"]: r["kept"] for r in rules.apply_rules(docs(good + junk)).collect()}
    assert all(found[k] for k in range(60)) and not any(found[k] for k in (100, 101, 102))


def test_one_long_text_repeats_and_null_ids_and_clashing_columns(spark):
    long_text = prose(1, 60_000, 500)
    rows = [(None, long_text, "en"), (7, long_text, "en"), (7, long_text, "en"), (8, "a b c " * 5000, "en")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clash = ("w", "t", "h", "classes", "slots", "common", "places", "kept", "n_words", "a.b")
    out = rules.apply_rules(table.withColumns({c: F.lit("x") for c in clash}))
    found = [(r["doc_id"], *(r[f] for f in FIELDS)) for r in out.collect()]
    assert sorted(found, key=str) == sorted(plain(rows), key=str)


def test_empty_table(spark, docs):
    out = rules.apply_rules(docs([]))
    assert out.collect() == [] and dict(out.dtypes)["kept"] == "boolean"


def test_no_python_in_the_plan(spark, docs):
    out = rules.apply_rules(docs(corpus(1)))
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 50])
def test_short_texts(spark, docs, n):
    rows = [(0, " ".join(["w"] * n), "en")]
    assert got(rules.apply_rules(docs(rows))) == plain(rows)
