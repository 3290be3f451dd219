from __future__ import annotations

import hashlib
import random

import pytest

from postolake.llm.decontaminate import contamination, without_contaminated

from .helpers import prose, words

BENCH = "item_id long, text string"


def _expected(rows, items):
    windows = []
    for item, text in items:
        w = words(text)
        if w:
            n = min(len(w), 13)
            windows += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1)]
    out = []
    for doc_id, text in rows:
        w = words(text)
        hit, found = set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found.add(item)
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        n_items = len({i for i in found if i is not None})
        out.append((doc_id, len(w), len(hit), n_items, hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def _result(frame):
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


def _fixture():
    rng = random.Random(2)
    items = [(k, prose(f"i{k}", 12 + 3 * k, 60)) for k in range(10)]
    items += [(10, items[3][1]), (3, items[3][1]), (None, items[4][1]), (11, None), (12, ""), (13, "!!")]
    rows = []
    for d in range(60):
        w = prose(f"d{d}", rng.randrange(5, 400), 60).split()
        for _ in range(rng.randrange(3)):
            src = rng.choice(items[:10])[1].split()
            a = rng.randrange(len(src))
            at = rng.randrange(len(w))
            w[at:at] = src[a : a + rng.randrange(8, 30)]
        rows.append((d, " ".join(w).title()))
    rows += [(100, None), (101, ""), (102, "?"), (103, " ".join([items[5][1]] * 200)), (None, items[6][1]), (104, items[6][1]), (104, items[6][1]), (104, "other words")]
    return rows, items


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_hits_match_brute_force(docs, spark, limit):
    rows, items = _fixture()
    out = contamination(docs(rows), spark.createDataFrame(items, BENCH), broadcast_bytes=limit)
    assert _result(out) == _expected(rows, items)


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_items_shorter_than_a_window(docs, spark, limit):
    rows = [(1, "a b c d e"), (2, "c b a"), (3, prose(1, 50) + " x y " + prose(2, 20)), (4, "x"), (5, "y x y x y"), (6, prose(3, 13))]
    items = [(1, "b c"), (2, "x y"), (3, "y"), (4, prose(3, 13)), (5, prose(3, 12))]
    out = contamination(docs(rows), spark.createDataFrame(items, BENCH), broadcast_bytes=limit)
    assert _result(out) == _expected(rows, items)


def test_empty_sides(docs, spark):
    nothing = spark.createDataFrame([], BENCH)
    assert contamination(docs([]), nothing).collect() == []
    assert _result(contamination(docs([(1, prose(1, 40)), (2, None)]), nothing)) == _expected([(1, prose(1, 40)), (2, None)], [])
    assert contamination(docs([]), spark.createDataFrame([(1, prose(1, 40))], BENCH)).collect() == []


def test_filter_keeps_clean_rows_and_columns(spark):
    passage = prose(1, 30)
    frame = spark.createDataFrame([(1, passage, "w", 1), (2, "clean words only", "s", 2), (None, None, "n", 3)], "doc_id long, text string, w string, places int")
    kept = without_contaminated(frame, spark.createDataFrame([(1, passage)], BENCH))
    assert kept.columns == frame.columns
    assert sorted(r["places"] for r in kept.collect()) == [2, 3]


def test_main_path_has_no_python(docs, spark):
    rows, items = _fixture()
    plan = contamination(docs(rows), spark.createDataFrame(items, BENCH))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoop"))
