"""Declarative data-quality suite over raw bronze rows.

The suite is data: a list of ``Expectation``. Running it is one aggregation
pass (``count_if`` per expectation, map-side combined) whose single row is
unpivoted into one row per expectation:

    ordinal, expectation, column, element_count, missing_count,
    unexpected_count, unexpected_percent, success

Semantics follow the usual expectation framework: value expectations skip
NULLs and their percentage is over non-NULL values; "not null" counts NULLs
over all rows; a missing column fails its expectation; the suite succeeds
only if every expectation does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postolake.constants import (
    BRONZE_HEADERS,
    VALID_PRODUCTS,
    VALID_REGIONS,
    VALID_STATES,
    VALID_UNITS,
)
from postolake.functions import matches_dmy_format, ratio_percent


@dataclass(frozen=True)
class Expectation:
    name: str
    column: str
    kind: str  # not_null | in_set | dmy_format | exists | column_list
    values: tuple = field(default_factory=tuple)


def default_suite(include_products: bool = False, include_columns: bool = False) -> list[Expectation]:
    """Q1-Q7 (Q10, Q11 optional)."""
    suite = [
        Expectation("expect_column_values_to_not_be_null", "Estado - Sigla", "not_null"),
        Expectation("expect_column_values_to_not_be_null", "Produto", "not_null"),
        Expectation("expect_column_values_to_match_strftime_format", "Data da Coleta", "dmy_format", ("%d/%m/%Y",)),
        Expectation("expect_column_values_to_be_in_set", "Estado - Sigla", "in_set", tuple(VALID_STATES)),
        Expectation("expect_column_values_to_be_in_set", "Unidade de Medida", "in_set", tuple(VALID_UNITS)),
        Expectation("expect_column_to_exist", "CNPJ da Revenda", "exists"),
        Expectation("expect_column_values_to_be_in_set", "Regiao - Sigla", "in_set", tuple(VALID_REGIONS)),
    ]
    if include_products:
        suite.append(Expectation("expect_column_values_to_be_in_set", "Produto", "in_set", tuple(VALID_PRODUCTS)))
    if include_columns:
        suite.append(
            Expectation("expect_table_columns_to_match_ordered_list", "*", "column_list", tuple(BRONZE_HEADERS))
        )
    return suite


def sample_rows(raw: DataFrame, sample: str = "first") -> DataFrame:
    """S11: 'first' keeps the rows of the lowest file name; 'all' keeps all.

    The lowest name is a one-row aggregate, broadcast into a semi join.
    """
    if sample == "all":
        return raw
    if sample != "first":
        raise ValueError(f"sample must be 'first' or 'all', not {sample!r}")
    first = raw.agg(F.min("filename").alias("filename"))
    return raw.join(F.broadcast(first), "filename", "left_semi")


def _unexpected(e: Expectation, c: Column) -> Column:
    if e.kind == "not_null":
        return c.isNull()
    if e.kind == "in_set":
        return c.isNotNull() & ~c.isin(list(e.values))
    if e.kind == "dmy_format":
        return c.isNotNull() & ~matches_dmy_format(c)
    raise ValueError(e.kind)


def _value_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "filename"]


def run_suite(raw: DataFrame, suite: list[Expectation] | None = None, sample: str = "all") -> DataFrame:
    """Q8: run every expectation in one pass; one result row each."""
    suite = suite or default_suite()
    df = sample_rows(raw, sample)
    present = set(df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, e in enumerate(suite):
        if e.kind in ("not_null", "in_set", "dmy_format") and e.column in present:
            c = F.col(f"`{e.column}`")
            aggs.append(F.count_if(c.isNull()).alias(f"_m{i}"))
            aggs.append(F.count_if(_unexpected(e, c)).alias(f"_u{i}"))
    one = df.agg(*aggs)

    rows = []
    for i, e in enumerate(suite):
        rows_n = F.col("_rows")
        if e.kind == "exists":
            ok = e.column in present
            missing = F.lit(None).cast("bigint")
            unexpected = F.lit(0 if ok else None).cast("bigint")
            percent = F.lit(0.0 if ok else None).cast("double")
            success = F.lit(ok)
        elif e.kind == "column_list":
            ok = _value_columns(df) == list(e.values)
            missing = F.lit(None).cast("bigint")
            unexpected = F.lit(0 if ok else 1).cast("bigint")
            percent = F.lit(0.0 if ok else 100.0).cast("double")
            success = F.lit(ok)
        elif e.column not in present:
            missing = unexpected = F.lit(None).cast("bigint")
            percent = F.lit(None).cast("double")
            success = F.lit(False)
        else:
            missing = F.col(f"_m{i}")
            unexpected = F.col(f"_u{i}")
            base = rows_n if e.kind == "not_null" else rows_n - missing
            percent = ratio_percent(unexpected, base)
            success = unexpected == 0
        rows.append(
            F.struct(
                F.lit(i + 1).alias("ordinal"),
                F.lit(e.name).alias("expectation"),
                F.lit(e.column).alias("column"),
                rows_n.cast("bigint").alias("element_count"),
                missing.cast("bigint").alias("missing_count"),
                unexpected.cast("bigint").alias("unexpected_count"),
                percent.cast("double").alias("unexpected_percent"),
                success.alias("success"),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def suite_success(results: DataFrame) -> DataFrame:
    """Overall result: success only if every expectation succeeded."""
    return results.agg(
        F.bool_and("success").alias("success"),
        F.count(F.lit(1)).alias("expectations"),
        F.count_if(~F.col("success")).alias("failed"),
    )


def unexpected_values(
    raw: DataFrame, suite: list[Expectation] | None = None, sample: str = "all", top: int = 20
) -> DataFrame:
    """Q9: the most frequent unexpected values of each value expectation.

    One scan emits (ordinal, value) for every failing check of a row; counts
    are combined map-side; the top ``top`` per expectation are kept with a
    rank filter, which Spark evaluates as a per-task group limit before the
    final exchange, so no expectation's values are gathered whole.
    """
    suite = suite or default_suite()
    df = sample_rows(raw, sample)
    present = set(df.columns)
    findings = []
    names = {}
    for i, e in enumerate(suite):
        if e.kind in ("not_null", "in_set", "dmy_format") and e.column in present:
            c = F.col(f"`{e.column}`")
            findings.append(
                F.when(_unexpected(e, c), F.struct(F.lit(i + 1).alias("ordinal"), c.alias("value")))
            )
            names[i + 1] = (e.name, e.column)
    exploded = df.select(F.explode(F.array_compact(F.array(*findings))).alias("f")).select("f.*")
    counts = exploded.groupBy("ordinal", "value").agg(F.count(F.lit(1)).alias("count"))
    rank = F.row_number().over(
        Window.partitionBy("ordinal").orderBy(F.col("count").desc(), F.col("value").asc_nulls_first())
    )
    top_rows = counts.withColumn("rank", rank).filter(F.col("rank") <= top)
    label = F.create_map(*[x for k, (n, _) in names.items() for x in (F.lit(k), F.lit(n))])
    column = F.create_map(*[x for k, (_, c) in names.items() for x in (F.lit(k), F.lit(c))])
    return top_rows.select(
        "ordinal",
        label[F.col("ordinal")].alias("expectation"),
        column[F.col("ordinal")].alias("column"),
        "value",
        "count",
        F.col("rank").cast("int").alias("rank"),
    )
