from __future__ import annotations

import random

from pyspark.sql import functions as F

from postolake.llm.quality import classify

from .helpers import prose

LABELS = "doc_id long, quality int, toxic int"


def _good(k):
    w = prose(k, 80, 900, "word").split()
    return ". ".join(" ".join(w[i : i + 8]).capitalize() for i in range(0, 80, 8)) + "."


def _poor(k):
    kind = k % 3
    if kind == 0:
        return " ".join(f"{x}$$$" for x in prose(k, 60).split())
    return " ".join(f"{x}!!" for x in prose(k, 60).upper().split()) if kind == 1 else "same same same " * 40


def _run(docs, spark, rows, labels):
    frame = docs(rows)
    out = classify(frame, spark.createDataFrame(labels, LABELS), F.col("source"), F.col("lang"))
    return out.collect()


def test_held_out_rows_are_classified(docs, spark):
    rows = [(k, _good(k) if k % 5 else _poor(k // 5), "en", f"h{k % 7}") for k in range(400)]
    labels = [(k, int(bool(k % 5)), 0) for k in range(0, 200)]
    out = {r["doc_id"]: r for r in _run(docs, spark, rows, labels)}
    assert len(out) == 400 and sum(r["labelled"] for r in out.values()) == 200
    right = sum(out[k]["keep"] == bool(k % 5) for k in range(200, 400))
    assert right >= 196


def test_sparse_sites_shrink_toward_the_level_above(docs, spark):
    rng = random.Random(0)
    rows = []
    for k in range(300):
        rows.append((k, _poor(k) if rng.random() < 0.9 else _good(k), "x", "bad"))
    for k in range(300, 900):
        rows.append((k, _poor(k) if rng.random() < 0.1 else _good(k), "x", "fine"))
    rows += [(1000, _good(1), "x", "tiny"), (1001, _good(2), "new", "bad")]
    labels = [(d, int("word" in t.lower() and "!!" not in t), 0) for d, t, _, _ in rows[:900:2]]
    out = {r["doc_id"]: r for r in _run(docs, spark, rows, labels)}
    site = lambda d: out[d]["path_share"]
    assert site(10) < 0.25 and site(500) > 0.8
    assert site(10) < site(1000) < site(500)  # one page says little about a host
    assert abs(site(1001) - out[1001]["host_share"]) < 0.05  # a new path starts from its host
    assert all(0 <= r["quality"] <= 1 for r in out.values())


def test_nulls_repeats_missing_labels_and_empty_tables(docs, spark):
    rows = [(1, None, None, None), (1, None, None, None), (None, "some text", "en", "h"), (2, "", "en", "h"), (3, "w " * 50_000, "en", "h")]
    out = _run(docs, spark, rows, [])
    assert len(out) == 5 and all(r["evidence"] == 0 and abs(r["quality"] - 0.5) < 1e-9 for r in out)
    one_sided = _run(docs, spark, rows, [(3, 1, 0), (3, 0, 0), (2, None, 0), (None, 1, 0)])
    assert len(one_sided) == 5 and all(r["evidence"] == 0 for r in one_sided)
    assert _run(docs, spark, [], [(1, 1, 0)]) == []
