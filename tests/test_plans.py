"""Plan shapes that the scale design relies on (read from explain output)."""

import contextlib
import io
import re

import pytest
from conftest import bronze_rows
from test_silver import BASE

from postolake.operators import analytics as A
from postolake.operators.gold import build_gold
from postolake.operators.quality import unexpected_values
from postolake.operators.silver import build_silver
from postolake.sinks.parquet import read_gold, read_silver, write_gold, write_silver


def plan_of(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def rows(n=40):
    out = []
    for i in range(n):
        out.append(dict(BASE, data_coleta=f"{1 + i % 28:02d}/{1 + i % 12:02d}/{2019 + i % 3}",
                        valor_venda=f"{5 + i % 3},{i % 100:02d}", municipio=f"cidade {i % 5}",
                        filename=f"f{i % 4}.csv"))
    return out


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    silver = build_silver(bronze_rows(spark, rows() + rows()))  # every row twice
    write_silver(silver, f"{root}/silver")
    write_gold(build_gold(read_silver(spark, f"{root}/silver"), keep_year=True), f"{root}/gold")
    return root


def test_silver_single_exchange_with_map_side_combine(spark):
    plan = plan_of(build_silver(bronze_rows(spark, rows())))
    physical = plan.split("\n\n")[0]
    assert len(re.findall(r"Exchange", physical)) == 1
    assert "hashpartitioning(row_hash" in plan
    assert "partial_min" in plan  # partial aggregate before the exchange
    # cleaning and md5 run once: the blank-row filter stays above the aggregate
    below = [line for line in plan.splitlines() if line.startswith("Condition")]
    assert not any("md5" in line for line in below)


def test_fact_build_does_not_shuffle_fact_rows(spark, stored):
    gold = build_gold(read_silver(spark, f"{stored}/silver"))
    plan = plan_of(gold.fact)
    physical = plan.split("\n\n")[0]
    assert physical.count("BroadcastHashJoin") >= 4
    assert "SortMergeJoin" not in physical
    # hash exchanges exist only on the dimension side: per-partition id
    # offsets (one row per partition) and the station lookup's group-by;
    # with no sort-merge join, no fact row is shuffled.
    assert set(re.findall(r"hashpartitioning\((\w+)", plan)) <= {"_pid", "cnpj_revenda"}


def test_time_range_panel_prunes_partitions_and_columns(spark, stored):
    gold = read_gold(spark, f"{stored}/gold")
    plan = plan_of(A.dash_monthly_price(gold, "2020-01-01", "2020-12-31"))
    assert re.search(r"PartitionFilters: \[.*ano.*>= 2020.*ano.*<= 2020", plan)
    assert "ReadSchema: struct<data_id:int,produto_id:int,valor_venda:double>" in plan
    assert plan.count("BroadcastHashJoin") >= 2
    assert "partial_sum" in plan


def test_top_values_use_group_limit_before_exchange(spark):
    plan = plan_of(unexpected_values(bronze_rows(spark, rows())), "simple")
    assert plan.count("WindowGroupLimit") >= 2
