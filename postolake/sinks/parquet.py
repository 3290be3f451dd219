"""K1, K4-K7, K9: silver and gold as Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postolake.operators.gold import Gold, build_posto_lookup


def write_silver(silver: DataFrame, path: str, records_per_file: int = 5_000_000) -> None:
    """K1: silver as Parquet partitioned by ``ano`` (NULL year -> default partition).

    Years present in the new data replace their partitions; other years stay
    (dynamic overwrite, like the source system's overwrite-or-ignore copy).

    Rows are rebalanced by year before the write: adaptive execution merges
    small years and splits large ones by bytes, so the number of files follows
    the size of the table, not tasks times years, and no task holds more than
    its share of a year. Rows are sorted by year then date in each task, which
    tightens Parquet min/max statistics for date filters.
    """
    (
        silver.hint("rebalance", "ano")
        .sortWithinPartitions(F.col("ano").asc_nulls_first(), "data_coleta")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", records_per_file)
        .partitionBy("ano")
        .parquet(path)
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """All silver partitions; partition discovery restores ``ano``."""
    return spark.read.parquet(path)


def write_gold(gold: Gold, root: str, records_per_file: int = 5_000_000) -> None:
    """K4-K7, K9: gold tables as Parquet; the fact is partitioned by year.

    Dimensions are small and written as single-digit file counts; the fact
    is written straight from its broadcast-join plan (no shuffle), at most
    ``records_per_file`` narrow rows in a file (some 100 MB by default).
    """
    gold.dim_data.coalesce(1).write.mode("overwrite").parquet(f"{root}/dim_data")
    gold.dim_produto.coalesce(1).write.mode("overwrite").parquet(f"{root}/dim_produto")
    gold.dim_localidade.write.mode("overwrite").parquet(f"{root}/dim_localidade")
    gold.dim_posto.write.mode("overwrite").parquet(f"{root}/dim_posto")
    (
        gold.fact.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")  # full reload: no stale years survive
        .option("maxRecordsPerFile", records_per_file)
        .partitionBy("ano")
        .parquet(f"{root}/fact_precos_combustivel")
    )


def read_gold(spark: SparkSession, root: str) -> Gold:
    """Gold tables from Parquet; the posto lookup is recomputed (tiny)."""
    dim_posto = spark.read.parquet(f"{root}/dim_posto")
    return Gold(
        dim_data=spark.read.parquet(f"{root}/dim_data"),
        dim_produto=spark.read.parquet(f"{root}/dim_produto"),
        dim_localidade=spark.read.parquet(f"{root}/dim_localidade"),
        dim_posto=dim_posto,
        posto_lookup=build_posto_lookup(dim_posto),
        fact=spark.read.parquet(f"{root}/fact_precos_combustivel"),
    )
