from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from postolake.llm import ann
from postolake.llm.ann import nearest

VECTORS = "vec_id long, embedding array<float>, label int"


def _exact(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and any(x not in (0, None) for x in v) and all(x is not None and np.isfinite(x) for x in v):
            good[i] = v
    out = {}
    for q, v in good.items():
        if q % 20 == 0:
            a = np.array(v, dtype=np.float32).astype(float)
            scored = [(-float(np.array(w, dtype=np.float32).astype(float) @ a), i) for i, w in good.items() if i != q and len(w) == len(v)]
            out[q] = sorted(scored)[:k]
    return out


def _run(spark, rows, k=20, **options):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    found = {}
    for r in nearest(frame, F.col("id") % 20 == 0, k, **options).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return found


def test_recall_over_several_shards(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((10, 32))
    data = centres[rng.integers(0, 10, 4000)] + 0.8 * rng.standard_normal((4000, 32))
    data *= rng.uniform(0.2, 3, 4000)[:, None]  # norms differ, so the lift matters
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(data)]
    found = _run(spark, rows, shard_rows=1500, query_rows=60)
    exact = _exact(rows, 20)
    assert set(found) == set(exact)
    hit = sum(len({i for _, i in exact[q]} & {i for _, i, _ in found[q]}) for q in exact)
    assert hit / (20 * len(exact)) >= 0.9
    for q, got in found.items():
        assert [r for r, _, _ in got] == list(range(1, 21))
        assert got == sorted(got, key=lambda x: (-x[2], x[1])) or [x[2] for x in got] == sorted((x[2] for x in got), reverse=True)
        for _, i, score in got:
            a, b = (np.array(rows[j][1], dtype=np.float32).astype(float) for j in (q, i))
            assert abs(score - a @ b) < 1e-9


def _recall_on_a_full_shard(spark, data, least):
    data = np.asarray(data, dtype=np.float32).astype(float)
    found = _run(spark, [(k, [float(x) for x in v]) for k, v in enumerate(data)])
    hit = 0
    for q, got in found.items():
        score = data @ data[q]
        score[q] = -np.inf
        hit += len({i for _, i, _ in got} & set(np.argsort(-score)[:20].tolist()))
    assert len(found) == -(-len(data) // 20)
    assert hit / (20 * len(found)) >= least


def test_recall_with_one_long_vector(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((50, 32))
    data = centres[rng.integers(0, 50, 8192)] + 0.7 * rng.standard_normal((8192, 32))
    data /= np.linalg.norm(data, axis=1)[:, None]
    data[5] *= 30
    _recall_on_a_full_shard(spark, data, 0.95)


def test_recall_of_unclustered_vectors_of_many_norms(spark):
    rng = np.random.default_rng(2)
    data = rng.standard_normal((8192, 32))
    data *= (rng.lognormal(0, 0.7, 8192) / np.linalg.norm(data, axis=1))[:, None]
    _recall_on_a_full_shard(spark, data, 0.9)


def _one_shard(data, k=20):
    """(recall, share of the vectors scored) of every 20th row's search in one shard, without Spark."""
    ids, asks = np.arange(len(data)), np.arange(0, len(data), 20)
    p = {"projections": ann.PROJECTIONS, "collisions": ann.COLLISIONS, "widen": ann.WIDEN, "recall": ann.RECALL, "seed": ann.SEED}
    row, found, _ = ann._nearest_in(ids, data, asks, data[asks], k, p)
    hit = 0
    for q in range(len(asks)):
        score = data @ data[asks[q]]
        score[asks[q]] = -np.inf
        hit += len(set(found[row == q]) & set(np.argsort(-score)[:k]))
    shard = ann._Shard(data, p["projections"], p["seed"])
    plan = ann._plan(shard, ids, data, asks, data[asks], k, p)
    return hit / (k * len(asks)), shard.colliding(data[asks[:64]], *plan, p["widen"]).mean()


@pytest.mark.parametrize("width", [64, 384])
def test_recall_of_wide_unclustered_vectors(width):
    assert _one_shard(np.random.default_rng(3).standard_normal((8192, width)))[0] >= 0.9


def test_few_clustered_vectors_are_scored():
    rng = np.random.default_rng(4)
    data = rng.standard_normal((50, 64))[rng.integers(0, 50, 8192)] + 0.7 * rng.standard_normal((8192, 64))
    recall, share = _one_shard(data / np.linalg.norm(data, axis=1)[:, None])
    assert recall >= 0.9 and share <= 0.05


def test_norms_at_the_ends_of_double(spark):
    frame = spark.createDataFrame([(0, [1e300, 1e300]), (1, [-1e300, 1e-300]), (2, [1e-320, 0.0]), (3, [0.5, 0.0])], "vec_id long, embedding array<double>")
    got = nearest(frame, F.col("id") == 3).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [0, 2, 1]


def test_ties_bad_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]),
        (3, [2.0, 0.0]),
        (1, [2.0, 0.0]),
        (2, [2.0, 5.0]),
        (20, [-1.0, 0.0]),
        (40, [0.0, 0.0]),
        (5, None),
        (6, [nan, 1.0]),
        (7, [inf, 1.0]),
        (8, [None, 1.0]),
        (None, [9.0, 9.0]),
        (60, [1.0, 2.0, 3.0]),
        (61, [1.0, 0.0, 0.0]),
        (3, [2.0, 0.0]),
    ]
    found = _run(spark, rows, k=3)
    assert [(i, s) for _, i, s in found[0]] == [(1, 2.0), (2, 2.0), (3, 2.0)]
    assert [(i, s) for _, i, s in found[20]] == [(0, -1.0), (1, -2.0), (2, -2.0)]
    assert [(i, s) for _, i, s in found[60]] == [(61, 1.0)]
    assert set(found) == {0, 20, 60}


def test_common_vector_and_empty_table(spark):
    rows = [(k, [1.0, 1.0]) for k in range(300)] + [(300, [3.0, 3.0])]
    found = _run(spark, rows, k=5)
    assert [i for _, i, _ in found[0]] == [300, 1, 2, 3, 4]
    assert [i for _, i, _ in found[300]] == [0, 1, 2, 3, 4]
    assert _run(spark, []) == {}
    assert _run(spark, [(20, [1.0])]) == {}
