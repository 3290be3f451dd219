"""Phrase mining against counting in plain Python; the transducer against dictionaries."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from postolake.llm import phrases as ph
from postolake.llm.transducer import CountTransducer, of_hashes, union

from .helpers import fold

FIELDS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        name = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", fold(text)):
            w = re.findall("[^ \t]+", piece)
            totals[name] += len(w)
            for k in (1, 2, 3):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cand.items():
            if len(p) == 2 and any(len(q) == 3 and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in cand.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def table_of(spark, rows):
    return spark.createDataFrame([(t, x) for t, x in rows], "text string, lang string")


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["é", "ß", "en", "de"]
    for _ in range(n):
        words = rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rng.randrange(1, 40))
        yield "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n"]) for w in words), rng.choice(["en", "de", None])


def test_equals_plain_counting_for_any_size_of_shard_and_range(spark):
    rows = [*texts(1, 150), ("", "en"), (None, "en"), ("  .. ,", "fr"), ("A b A B a b. a B", None), ("en de " * 30, "en"), ("de en " * 30, "de")]
    expected = plain(rows, 3, 50)
    table = table_of(spark, rows).repartition(3)
    for shard, span in ((ph.SHARD_TOKENS, ph.RANGE_RUNS), (64, 200), (7, 40)):
        got = ph.mine_phrases(table, least=3, top=50, shard_tokens=shard, range_runs=span).collect()
        assert sorted(tuple(r[f] for f in FIELDS) for r in got) == expected
    assert any(len(e[2].split()) == 3 for e in expected)


def test_top_and_ties_go_by_bytes(spark):
    rows = [(f"x{k} y{k}. " * 4, "en") for k in range(30)] + [("é y. Z z. z Z. " * 4, "en")]
    expected = plain(rows, 3, 10)
    got = ph.mine_phrases(table_of(spark, rows), least=3, top=10).collect()
    assert sorted(tuple(r[f] for f in FIELDS) for r in got) == expected and len(expected) == 10


def test_products_beyond_64_bits_stay_exact(spark):
    row = spark.createDataFrame([(6_000_000_000, 6_000_000_007, 6_000_000_011)], "a long, l1 long, r1 long")
    got = row.select(F.expr(ph._score("l1", "r1"))).first()[0]
    assert got == 1_000_000 * 6_000_000_000**2 // (6_000_000_007 * 6_000_000_011)


def test_one_long_text_hot_words_clashing_columns_and_empty_table(spark):
    rows = [("the the cat " * 3000, "en"), ("the the cat " * 3000, "en"), ("the", None)]
    table = table_of(spark, rows).withColumns({c: F.lit("x") for c in ("blob", "range", "a", "of", "k", "names", "d.e")})
    got = ph.mine_phrases(table, shard_tokens=500, range_runs=64).collect()
    assert sorted(tuple(r[f] for f in FIELDS) for r in got) == plain(rows, 10, 2000)
    empty = ph.mine_phrases(table.where("false"))
    assert empty.collect() == [] and empty.columns == FIELDS


def random_grams(seed, n, alphabet):
    rng = random.Random(seed)
    counts = Counter()
    for _ in range(n):
        w = [rng.randrange(1, alphabet) * 0x9E3779B97F4A7C15 % 2**64 for _ in range(3)]
        for k in (1, 2, 3):
            counts[tuple(w[:k]) + (0,) * (3 - k)] += 1
    return counts


def columns(counts):
    keys = np.array(list(counts), dtype=np.uint64).reshape(-1, 3)
    return (*keys.T, np.array(list(counts.values()), dtype=np.int64))


def as_dict(t):
    g = t.grams()
    return dict(zip(zip(*(t.hashes(c).tolist() for c in g[:3])), g.counts.tolist()))


def test_transducer_round_trip_union_and_composition():
    parts = [random_grams(k, 400, 9) for k in range(5)]
    whole = sum(parts, Counter())
    built = [of_hashes(*columns(p)) for p in parts]
    for t, p in zip(built, parts):
        assert as_dict(CountTransducer.from_bytes(t.to_bytes())) == p
    assert as_dict(union(built)) == whole
    pruned = union(built, 12)
    assert as_dict(pruned) == {k: n for k, n in whole.items() if n >= 12}
    asked = list(whole) + [(1, 2, 3), (5, 0, 0)]
    keys = np.array(asked, dtype=np.uint64)
    assert pruned.compose(*keys.T).tolist() == [whole[k] if whole[k] >= 12 else 0 for k in asked]


def test_equal_states_are_one():
    counts = {(a, b, c): 2 for a in (1, 2, 3) for b in (4, 5) for c in (6, 7)}
    counts |= {(a, b, 0): 4 for a in (1, 2, 3) for b in (4, 5)} | {(a, 0, 0): 8 for a in (1, 2, 3)}
    t = of_hashes(*columns(counts))
    assert [len(level.offsets) - 1 for level in t.levels] == [1, 1, 1]
    assert [len(level.labels) for level in t.levels] == [3, 2, 2]
    assert as_dict(t) == counts


def test_transducer_of_nothing_and_of_a_range_without_its_beginnings():
    nothing = of_hashes(*columns({}))
    assert as_dict(CountTransducer.from_bytes(nothing.to_bytes())) == {}
    assert nothing.compose(np.array([3], dtype=np.uint64)).tolist() == [0]
    tail = of_hashes(*columns({(9, 8, 7): 5}))
    assert as_dict(CountTransducer.from_bytes(tail.to_bytes())) == {(9, 8, 7): 5}
