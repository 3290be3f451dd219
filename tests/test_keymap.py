"""Keys over several loads, and the as-of scan against a join."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from postolake.operators.keymap import KeyConflictError, KeyMap
from postolake.operators.scd2 import carry_versions

KEYS = ["region", "city"]


def members(spark, rows):
    return spark.createDataFrame(rows, "region string, city string")


def ids(frame):
    return {(r["region"], r["city"]): r["id"] for r in frame.collect()}


def test_old_members_keep_their_ids_in_any_order_of_loads(spark, tmp_dir):
    a = [("S", "x"), ("N", None), (None, None), ("S", "x"), ("", "y")]
    b = [("A", "first by name"), ("S", "x"), (None, None), (None, "z")]
    km = KeyMap(spark, f"{tmp_dir}/m", KEYS, "id")
    assert km.read() is None
    first = ids(km.extend(members(spark, a)))
    assert first == {(None, None): 1, ("", "y"): 2, ("N", None): 3, ("S", "x"): 4}
    second = ids(km.extend(members(spark, b)))
    assert {k: v for k, v in second.items() if k in first} == first
    assert second[None, "z"] == 5 and second["A", "first by name"] == 6
    third = km.extend(members(spark, random.sample(a + b, 9)))
    assert ids(third) == second and km.loads() == [1, 2, 3]
    assert ids(km.read(1)) == first
    other = KeyMap(spark, f"{tmp_dir}/n", KEYS, "id")
    other.extend(members(spark, b))
    assert set(ids(other.extend(members(spark, a)))) == set(second)


def test_nothing_new_and_empty_loads(spark, tmp_dir):
    km = KeyMap(spark, tmp_dir + "/m", KEYS, "id")
    assert km.extend(members(spark, [])).count() == 0
    assert ids(km.extend(members(spark, [("S", "x")]))) == {("S", "x"): 1}
    got = km.attach(members(spark, [("S", "x"), ("S", None)])).collect()
    assert {(r["city"], r["id"]) for r in got} == {("x", 1), (None, None)}


def test_second_writer_of_a_number_fails_and_leaves_nothing(spark, tmp_dir, monkeypatch):
    km = KeyMap(spark, tmp_dir + "/m", KEYS, "id")
    km.extend(members(spark, [("S", "x")]))
    late = KeyMap(spark, tmp_dir + "/m", KEYS, "id")
    monkeypatch.setattr(late, "loads", lambda: [])
    with pytest.raises(KeyConflictError):
        late.extend(members(spark, [("N", "y")]))
    assert ids(km.read()) == {("S", "x"): 1}


def test_carried_versions_equal_the_range_join_with_hot_stations_cut(spark):
    rng = random.Random(5)
    day0 = date(2020, 1, 1)
    history, facts = [], []
    for s in range(6):
        starts = sorted(rng.sample(range(10, 300), rng.randrange(1, 9)))
        history += [(f"c{s}", day0 + timedelta(d), 100 * s + k) for k, d in enumerate(starts)]
    for k in range(800):
        station = "c0" if rng.random() < 0.6 else f"c{rng.randrange(8)}"
        facts.append((k, station, day0 + timedelta(200 if k % 3 == 0 else rng.randrange(330)), float(k)))
    h = spark.createDataFrame(history, "cnpj_revenda string, data_inicio date, posto_id int")
    f = spark.createDataFrame(facts, "fato_id long, cnpj_revenda string, data_coleta date, valor double")
    expected = []
    for k, station, day, v in facts:
        valid = [(d, p) for c, d, p in history if c == station and d <= day]
        if valid:
            expected.append((k, max(valid)[1], v))
    for slice_rows in (10**6, 50):
        got = carry_versions(f, h, slice_rows).select("fato_id", "posto_id", "valor").collect()
        assert sorted(map(tuple, got)) == sorted(expected)


def test_stations_to_cut_are_counted_without_the_facts(spark):
    h = spark.createDataFrame([("c", date(2020, 1, 1), 7)], "cnpj_revenda string, data_inicio date, posto_id int")
    f = spark.range(40).selectExpr("id AS fato_id", "'c' AS cnpj_revenda", "date'2020-02-01' AS data_coleta")
    got = carry_versions(f, h, 10, stations=f.select("cnpj_revenda"))
    assert sorted(r["fato_id"] for r in got.where("posto_id = 7").collect()) == list(range(40))
    # read by the scan alone, a fact that cannot be computed fails there and not in the count
    broken = f.withColumn("cnpj_revenda", F.raise_error(F.lit("read")).cast("string"))
    assert carry_versions(broken, h, 10, stations=f.select("cnpj_revenda")).columns[0] == "cnpj_revenda"
