"""The demo lake and its files: built when asked for, cut by rows."""

import datetime as dt
import os

import pytest
from conftest import bronze_rows

from postolake.constants import SILVER_COLUMNS
from postolake.plans import files, lake
from postolake.session import partitions_for, settings, shared_work_dir
from postolake.sources.bronze_csv import read_bronze, write_bronze_csv


LINES = 12


@pytest.fixture()
def tables(spark, tmp_dir):
    """Five driver tables of a few rows."""
    day = dt.date(1997, 3, 1)
    lines = [(k, 1, 1 + k % 2, 1 + k % 3, 2.0, 1000.0 + k, "N", day + dt.timedelta(days=k)) for k in range(1, LINES + 1)]
    schema = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_shipdate date"
    )
    frames = {
        "lineitem": spark.createDataFrame(lines, schema),
        "part": spark.createDataFrame([(1, "ECONOMY", 900.0)], "p_partkey long, p_type string, p_retailprice double"),
        "supplier": spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": spark.createDataFrame([(0, "x", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(0, "y")], "r_regionkey int, r_name string"),
    }
    for name, frame in frames.items():
        frame.coalesce(1).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


def _local(path):
    return path.replace("file://", "").replace("file:", "")


def test_layers_are_built_when_asked_for(spark, tables):
    demo = lake.demo_lake(spark, tables)
    copies = LINES // 3
    assert demo.bronze.count() == LINES + copies + 1
    assert "silver" not in vars(demo) and "gold" not in vars(demo)
    assert demo.silver.count() == LINES and "gold" not in vars(demo)
    assert demo.silver.columns == SILVER_COLUMNS
    assert demo.gold.fact.count() <= LINES
    assert lake.demo_lake(spark, tables + "/").silver is demo.silver


def test_layers_are_files_cut_by_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(lake, "TASK_ROWS", 3)
    demo = lake.Lake(spark, tables)
    assert len(demo.bronze.inputFiles()) >= (LINES + 5) // 3
    assert len(demo.silver.inputFiles()) >= LINES // 3


def test_files_are_written_when_asked_for(spark, tables):
    silver = files.demo_files(spark, tables, "silver")
    root = _local(os.path.dirname(silver))
    assert os.listdir(root) == ["silver"]
    mixed = files.demo_files(spark, tables, "bronze_mixed")
    assert sorted(os.listdir(root)) == ["bronze_mixed", "silver"]
    assert files.demo_files(spark, tables, "bronze_mixed") == mixed
    assert read_bronze(spark, mixed).count() == LINES + LINES // 3 + 1
    with pytest.raises(ValueError):
        files.demo_files(spark, tables, "gold")


def test_settings_hold_inside_only(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    with partitions_for(spark, 1000, 10):
        assert spark.conf.get(key) == "100"
    with pytest.raises(ZeroDivisionError), settings(spark, {key: "3"}):
        1 / 0
    assert spark.conf.get(key, None) == before


def test_more_sources_than_open_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr("postolake.sources.bronze_csv.OPEN_FILES", 2)
    rows = [{"produto": f"P{k}", "filename": f"f{k % 7}.csv"} for k in range(40)]
    write_bronze_csv(bronze_rows(spark, rows).coalesce(1), f"{tmp_dir}/csv")
    back = read_bronze(spark, f"{tmp_dir}/csv").select("Produto").collect()
    assert sorted(r[0] for r in back) == sorted(r["produto"] for r in rows)
    assert len([f for _, _, names in os.walk(f"{tmp_dir}/csv") for f in names if f.endswith(".csv")]) == 7


def test_batch_leaves_no_scratch(spark, tmp_dir):
    from postolake.streaming.incremental import append_new_silver

    some = bronze_rows(spark, [{"produto": "P", "data_coleta": "01/02/2003"}, {"produto": "Q"}])
    assert append_new_silver(some, f"{tmp_dir}/silver").rows == 2
    assert append_new_silver(some, f"{tmp_dir}/silver").possible == 2
    root = _local(shared_work_dir(spark, ""))
    assert not [n for n in os.listdir(root) if n.startswith("batch-")]


def test_dimensions_and_the_as_of_fact_store_no_other_fact(spark, tables):
    from postolake.plans.registry import QUERIES

    demo = lake.demo_lake(spark, tables)
    rows = QUERIES["fact_asof_posto"](spark, tables).count()
    assert QUERIES["dim_posto"](spark, tables).count() > 0
    assert "gold" not in vars(demo)
    # all rows of March are seen a second time under another brand
    assert rows == 2 * demo.gold.fact.count() > 0
