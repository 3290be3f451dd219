from __future__ import annotations

import random

import numpy as np

from postolake.llm import setjoin


def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    return {x: find(x) for x in parent}


def _partition(labels):
    groups = {}
    for x, c in labels.items():
        groups.setdefault(c, set()).add(x)
    return sorted(map(sorted, groups.values()))


def test_components_match_union_find(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "EDGES_PER_TASK", 8)
    rng = random.Random(5)
    edges = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(70)] + [(500 + k, 501 + k) for k in range(40)]
    edges += [(1000, 1000 + k) for k in range(30)]
    out = setjoin.components(spark.createDataFrame(edges, "src long, dst long")).collect()
    expected = _union_find([(a, b) for a, b in edges if a != b])
    assert _partition({r["id"]: r["comp"] for r in out}) == _partition(expected)
    assert len(out) == len(expected)


def test_components_of_nothing(spark):
    assert setjoin.components(spark.createDataFrame([], "src long, dst long")).collect() == []


def test_verified_components_in_one_or_many_blocks(spark, monkeypatch):
    rng = random.Random(3)
    base = [rng.randrange(10**9) for _ in range(30)]
    sets = {}
    for k in range(90):
        s = set(base)
        for x in rng.sample(base, rng.randrange(6)):
            s.discard(x)
            s.add(rng.randrange(10**9))
        sets[k] = s
    rows = [(k, 1, bytearray(np.array(sorted(s), dtype=np.uint64).tobytes())) for k, s in sets.items()]
    rows += [(200 + k, 2, bytearray(np.array([7 + k], dtype=np.uint64).tobytes())) for k in range(3)]
    members = spark.createDataFrame(rows, "id long, comp long, tokens binary")
    linked = {
        a: {b for b in sets if b != a and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])} for a in sets
    }
    classes = _union_find([(a, b) for a in sets for b in linked[a] | {a}])
    for rows_a_block in (1000, 10):
        monkeypatch.setattr(setjoin, "BLOCK_ROWS", rows_a_block)
        monkeypatch.setattr(setjoin, "MAX_BLOCK_ROWS", rows_a_block)
        out = {r["id"]: r for r in setjoin.verify_components(members, [], 0.8).collect()}
        assert {k: out[k]["n_links"] for k in sets} == {k: len(v) for k, v in linked.items()}
        assert {k: out[k]["earlier"] for k in sets} == {k: any(b < k for b in v) for k, v in linked.items()}
        assert _partition({k: out[k]["class"] for k in sets}) == _partition(classes)
        assert all(out[200 + k]["n_links"] == 0 for k in range(3))
