"""Cross-tokenizer alignment against one text at a time in plain Python."""

from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from postolake.llm import align as al

pytestmark = pytest.mark.skipif(not os.path.isdir(al.TOKENIZERS), reason="vocabulary files not present")


def plain(texts):
    """Expected rows (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) in the order of ``texts``."""
    a, b = al.tokenizers(al.TOKENIZERS)
    per, counts = [], Counter()
    for text in texts:
        if not text:
            per.append(None)
            continue
        want = f" {text}".encode()
        ia, ib = a([text])[0].as_py(), b([text])[0].as_py()
        ba, bb = [a.bytes[i].as_py() for i in ia], [b.bytes[i].as_py() for i in ib]
        if b"".join(ba) != want or b"".join(bb) != want:
            per.append(None)
            continue
        ends = []
        for spelled in (ba, bb):
            upto, at = 0, {}
            for k, t in enumerate(spelled):
                upto += len(t)
                at[upto] = k
            ends.append(at)
        groups, links, la, lb = [], [], 0, 0
        for cut in sorted(ends[0].keys() & ends[1].keys()):
            ka, kb = ends[0][cut], ends[1][cut]
            groups.append(",".join(map(str, ia[la : ka + 1])) + "|" + ",".join(map(str, ib[lb : kb + 1])))
            links.append((ia[ka], ib[kb]))
            la, lb = ka + 1, kb + 1
        counts.update(links)
        per.append((len(ia), len(ib), ";".join(groups), len(groups), links))
    top = defaultdict(int)
    for (_, ib), n in counts.items():
        top[ib] = max(top[ib], n)
    out = []
    for p in per:
        if p is None:
            out.append((0, 0, 0, 0, 0, 0, "", ""))
            continue
        n_a, n_b, groups, n_groups, links = p
        best = sum(counts[x] == top[x[1]] for x in links)
        total = sum(counts[x] for x in links)
        out.append((n_a, n_b, n_groups, len(links), best, total, groups, hashlib.sha256(groups.encode()).hexdigest()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256"]

TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "Größe, Straße und naïve café – tokenisation",
    "",
    None,
    "▁ marks a space in pieces",
    "ends here <|endoftext|> and </s> goes on <s> <unk>",
    "  leading  and   inner\t\n\nspaces  ",
    "emoji 👩‍👩‍👧 and 漢字かな and \x00 control \x07",
    "a",
    " ",
    "x" * 3000,
    "1234567890 " * 400,
    "The quick brown fox jumps over the lazy dog.",
    "élan à été, ça où ×÷ ſ ž  a\u00a0b \u2003c \x85 d 'tis it's I'll we've x 's 't",
    "don 't a 1 2 ! ? a. b, c\r\n d\t e \u3000 f é\u00a0 g ï\u0301 h ​ i ﻿ j",
]


def test_equals_plain_python_in_blocks_of_any_size(spark, docs):
    table = docs(TEXTS)
    expected = sorted(zip(range(len(TEXTS)), plain(TEXTS)))
    for size in (al.BLOCK_BYTES, 64):
        found = al.align(table, with_groups=True, block_bytes=size).collect()
        got = sorted((r["doc_id"], tuple(r[c] for c in COLUMNS)) for r in found)
        assert got == expected
    assert sum(e[1][0] == 0 for e in expected) >= 3  # null, empty and the changed text


def test_counts_are_of_the_whole_table_whatever_its_partitions(spark, docs):
    texts = [f"word{k % 7} the cat {k % 3} sat" for k in range(60)]
    got = al.align(docs(texts).repartition(5)).collect()
    expected = dict(enumerate(plain(texts)))
    assert len(got) == 60
    for r in got:
        assert tuple(r[c] for c in COLUMNS[:6]) == expected[r["doc_id"]][:6]
        assert r["groups"] is None and r["groups_sha256"] == expected[r["doc_id"]][7]


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "one two"), (1, "one two"), (None, "one two"), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("block", "links", "pairs", "counts", "place", "n_a", "a.b"):
        table = table.withColumn(name, F.lit("x"))
    got = sorted((str(r["doc_id"]), r["n_links"], r["count_sum"], r["n_best"]) for r in al.align(table).collect())
    assert got == [("1", 2, 6, 2), ("1", 2, 6, 2), ("None", 0, 0, 0), ("None", 2, 6, 2)]


def test_empty_table(spark, docs):
    out = al.align(docs([]))
    assert out.collect() == [] and dict(out.dtypes)["count_sum"] == "bigint"


def test_digits_of_the_byte_alphabet():
    back = al.byte_alphabet()
    assert sorted(back.values()) == list(range(256)) and back["Ġ"] == 0x20 and back["Ċ"] == 0x0A and back["a"] == 0x61
