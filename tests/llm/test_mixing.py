from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from postolake.llm import mixing
from postolake.llm.mixing import (
    capped_targets,
    connected_parts,
    mix_single_source,
    mix_sources,
    repeating_weights,
    route,
    route_parts,
)

from .helpers import prose


def test_targets_stop_at_three_times_the_source():
    t = capped_targets({"a": 10, "b": 100, "c": 1000, None: 0}, {"a": 5, "b": 2, "c": 1, None: 5}, 1110)
    assert t["a"] == 30 and t["b"] == 300 and t["c"] == 780 and t[None] == 0
    assert capped_targets({}, {}, 0) == {}
    assert repeating_weights(["a", "b", "c", None]) == [5, 2, 1, 5]


def _cost(used, capacity, copies):
    total = 0
    for p, u in used.items():
        for r in range(copies):
            part = min(max(u - r * capacity[p], 0), capacity[p])
            total += r * part
    return total


def test_flow_is_maximal_and_cheapest():
    rng = random.Random(4)
    for _ in range(30):
        sources = ["x", "y"]
        members = {"p": ["x"], "q": ["y"], "r": ["x", "y"]}
        capacity = {p: rng.randrange(0, 4) for p in members}
        quotas = {s: rng.randrange(0, 9) for s in sources}
        flow = route(capacity, members, quotas, copies=2)
        used = {p: sum(flow[p, s] for s in members[p]) for p in members}
        got = {s: sum(f for (_, t), f in flow.items() if t == s) for s in sources}
        assert all(used[p] <= 2 * capacity[p] for p in members) and all(got[s] <= quotas[s] for s in sources)
        best = None
        for p, q, rx, ry in itertools.product(*(range(2 * capacity[k] + 1) for k in ("p", "q", "r", "r"))):
            if rx + ry <= 2 * capacity["r"] and p + rx <= quotas["x"] and q + ry <= quotas["y"]:
                key = (-(p + q + rx + ry), _cost({"p": p, "q": q, "r": rx + ry}, capacity, 2))
                best = key if best is None or key < best else best
        assert (-sum(used.values()), _cost(used, capacity, 2)) == best


def _rows():
    rng = random.Random(1)
    rows = [(k, prose(k, rng.randrange(1, 60)), "en", rng.choice(["a", "a", "a", "b", "c", "ç", "Z", None])) for k in range(600)]
    return rows + [(900, None, "en", "a"), (901, "", "en", None), (902, " \t\n", "en", "b"), (None, "one two", "en", "c"), (7, "x y z", "en", "a"), (7, "x y z", "en", "a"), (903, "only", "en", "")]


def test_single_sources_reach_their_targets(docs):
    rows = _rows()
    out = mix_single_source(docs(rows)).collect()
    assert len(out) == len(rows)
    size = lambda t: len((t or "").split())
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = capped_targets(sizes, dict(zip(names, repeating_weights(names))), sum(sizes.values()))
    taken = {}
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - float(targets[r["source"]])) < 1e-6
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in names:
        assert abs(taken[s] - float(targets[s])) <= max(2, 0.01 * float(targets[s])), s
    again = mix_single_source(docs(rows[::-1]).repartition(5)).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"], str(r["source"]))
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_a_document_longer_than_the_rest_of_its_source(spark, docs):
    mark = F.xxhash64(F.lit(0), F.col("id"))
    first = spark.range(10_000, 20_000).where(mark >= 0).orderBy(mark).first()["id"]  # early in the seeded order
    rows = [(k, "w " * 5, "en", "b") for k in range(3000)] + [(first, "w " * 30_000, "en", "b"), (1, "one two", "en", "a")]
    rows += [(20_000 + k, "w " * (k % 200 + 1), "en", "c") for k in range(300)]
    out = mix_single_source(docs(rows)).collect()
    for source in "abc":
        part = [r for r in out if r["source"] == source]
        missing = round(part[0]["target"]) - sum(r["taken"] for r in part)
        assert abs(missing) <= 2, source
        fewest = min(r["taken"] // r["size"] for r in part)
        assert not any(r["taken"] == fewest * r["size"] and r["size"] <= missing for r in part)


def test_overlapping_sources(spark):
    rows = [(k, "w " * 10, ["a", "b"] if k % 3 == 0 else ["a"] if k % 3 == 1 else ["b", "b"]) for k in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    mixed, plan = mix_sources(frame, F.col("sources"), lambda names: [3, 1])
    assert plan["sizes"] == {"a": 600, "b": 600}
    assert {s: float(t) for s, t in plan["targets"].items()} == {"a": 675.0, "b": 225.0}
    by = {r["pattern"]: r["t"] for r in mixed.groupBy("pattern").agg(F.sum("taken").alias("t")).collect()}
    assert abs(sum(by.values()) - 900) <= 10  # every quota can be met without repeating all of a
    assert set(by) == {'["a"]', '["a","b"]', '["b"]'}


def test_parts_flow_like_the_whole():
    rng = random.Random(9)
    for _ in range(30):
        sources = ["a", "b", "c", "d", None]
        members = {f"p{k}": rng.sample(sources, rng.randrange(1, 3)) for k in range(5)}
        capacity = {p: rng.randrange(0, 9) for p in members}
        quotas = {s: rng.randrange(0, 15) for s in sources}
        whole, parts = route(capacity, members, quotas), route_parts(capacity, members, quotas)
        used = lambda flow: {p: sum(flow[p, s] for s in members[p]) for p in members}
        assert set(whole) == set(parts) and sum(whole.values()) == sum(parts.values())
        assert _cost(used(whole), capacity, 3) == _cost(used(parts), capacity, 3)
    assert connected_parts({"x": ["a"], "y": ["b", "c"], "z": ["c"], "w": [], "v": [None]}) == [["v"], ["w"], ["x"], ["y", "z"]]


@pytest.mark.parametrize("limit", [200_000, 10])
def test_twenty_thousand_sources(docs, monkeypatch, limit):
    monkeypatch.setattr(mixing, "BROADCAST_PLAN", limit)
    count = 20_000 if limit > 10 else 200
    rows = [(k, "w " * (k % 7 + 1), "en", f"source {k % count:05d}") for k in range(2 * count)]
    out = mix_single_source(docs(rows)).collect()
    sizes = {}
    for k, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + k % 7 + 1
    names = sorted(sizes)
    targets = capped_targets(sizes, dict(zip(names, repeating_weights(names))), sum(sizes.values()))
    assert len(out) == len(rows)
    taken = dict.fromkeys(names, 0)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == float(targets[r["source"]]) and r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 7 for s in names)


def test_empty_table(docs):
    assert mix_single_source(docs([])).collect() == []
    assert [r["taken"] for r in mix_single_source(docs([(1, None), (2, "")])).collect()] == [0, 0]
