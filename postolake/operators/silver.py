"""Bronze -> silver: rename, clean, key, drop blank rows, deduplicate.

Deduplication is exact: rows are equal when their 16 cleaned columns are equal
with NULL == ''. Of each group the survivor is the row with the lowest
``filename`` (then NULL before '' column by column), so the result does not
depend on task order.

Plan shape: one narrow projection (codegen) and one aggregation on
``row_hash``. The aggregation runs partial-then-final, so a key repeated in
a third of the input collapses map-side to one row per task before the
shuffle; no group is ever gathered into a single task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postolake.constants import (
    BRONZE_HEADER_MAP,
    DIGIT_COLUMNS,
    SILVER_COLUMNS,
    SILVER_SOURCE_COLUMNS,
    TRIM_ONLY_COLUMNS,
    UPPER_TRIM_COLUMNS,
)
from postolake.functions import (
    blank_key_text,
    br_decimal,
    clean_text,
    digits_only,
    row_key_text,
    safe_date,
    trim_spaces,
)

# Columns a survivor is chosen by, after filename: the cleaned text columns.
_TIE_BREAK = [c for c in SILVER_SOURCE_COLUMNS if c not in ("data_coleta", "valor_venda", "valor_compra")]


def rename_bronze(raw: DataFrame) -> DataFrame:
    """The 16 raw headers to snake_case, plus filename, by name."""
    return raw.select(
        F.col("filename"),
        *[F.col(f"`{header}`").alias(name) for header, name in BRONZE_HEADER_MAP],
    )


def repair_text_columns(renamed: DataFrame) -> DataFrame:
    """X1 in silver: mojibake repair of the free-text columns (Arrow UDF)."""
    from postolake.functions.unicode_fix import fix_unicode

    text = set(UPPER_TRIM_COLUMNS) | set(TRIM_ONLY_COLUMNS)
    return renamed.select(*[fix_unicode(c).alias(c) if c in text else F.col(c) for c in renamed.columns])


def clean_bronze(renamed: DataFrame) -> DataFrame:
    """One projection of Column expressions (the cleaning CTE)."""
    exprs = [F.col("filename")]
    for name in SILVER_SOURCE_COLUMNS:
        if name in UPPER_TRIM_COLUMNS:
            exprs.append(clean_text(name).alias(name))
        elif name in DIGIT_COLUMNS:
            exprs.append(digits_only(name).alias(name))
        elif name in TRIM_ONLY_COLUMNS:
            exprs.append(trim_spaces(name).alias(name))
        elif name == "data_coleta":
            exprs.append(safe_date(name).alias(name))
        else:  # valor_venda, valor_compra
            exprs.append(br_decimal(name).alias(name))
    cleaned = renamed.select(*exprs)
    return cleaned.withColumn("ano", F.year("data_coleta")).withColumn("mes", F.month("data_coleta"))


def with_row_key(cleaned: DataFrame) -> DataFrame:
    """Row key text and its md5 (the silver ``row_hash``)."""
    key = row_key_text(SILVER_SOURCE_COLUMNS)
    return cleaned.withColumn("_row_key", key).withColumn("row_hash", F.md5(F.col("_row_key")))


# md5 of the key of a row whose 16 cleaned columns are all NULL or ''.
BLANK_ROW_HASH = hashlib.md5(blank_key_text(len(SILVER_SOURCE_COLUMNS)).encode("utf-8")).hexdigest()


def drop_blank_rows(deduplicated: DataFrame) -> DataFrame:
    """rows whose 16 cleaned columns are all NULL or '' are dropped.

    Applied after deduplication (all blank rows share one key, so one row
    goes) and tested on the survivor's columns. Those come out of the
    aggregate, so the filter stays above it; a test of ``row_hash`` would be
    pushed below the cleaning projection and evaluate cleaning and md5 twice.
    """
    return deduplicated.filter(F.concat_ws("", *[F.col(c).cast("string") for c in SILVER_SOURCE_COLUMNS]) != "")


def deduplicate(keyed: DataFrame) -> DataFrame:
    """W1 + F1: keep one row per row_hash, deterministically.

    ``min(struct(filename, text columns, rest))`` orders lexicographically with
    NULLs first, i.e. ROW_NUMBER() OVER (PARTITION BY key ORDER BY filename,
    columns NULLS FIRST) = 1, computed as a map-side-combinable aggregate.
    """
    payload = ["filename", *_TIE_BREAK, "data_coleta", "valor_venda", "valor_compra", "ano", "mes"]
    survivor = F.min(F.struct(*[F.col(c) for c in payload])).alias("s")
    return keyed.groupBy("row_hash").agg(survivor).select("row_hash", "s.*")


def keyed_rows(raw_bronze: DataFrame, repair_text: bool = False) -> DataFrame:
    """Bronze (raw headers + filename) cleaned, with ``row_hash``: one row for each raw row."""
    renamed = rename_bronze(raw_bronze)
    if repair_text:
        renamed = repair_text_columns(renamed)
    return with_row_key(clean_bronze(renamed)).drop("_row_key")


def distinct_silver(keyed: DataFrame) -> DataFrame:
    """Cleaned rows with ``row_hash`` -> the 20-column silver frame."""
    return drop_blank_rows(deduplicate(keyed)).select(*SILVER_COLUMNS)


def build_silver(raw_bronze: DataFrame, repair_text: bool = False) -> DataFrame:
    """Bronze (raw headers + filename) -> the 20-column silver frame.

    ``repair_text`` runs the mojibake repair on free-text columns first; it is
    off by default, as in the source system, where the function is registered
    but not called.
    """
    return distinct_silver(keyed_rows(raw_bronze, repair_text))


def dedup_counts(raw_bronze: DataFrame) -> DataFrame:
    """Row counts through the silver steps: input, blank, duplicate, output."""
    keyed = with_row_key(clean_bronze(rename_bronze(raw_bronze)))
    per_key = keyed.groupBy("row_hash").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "blank", F.col("row_hash") == F.lit(BLANK_ROW_HASH)
    )
    return per_key.agg(
        F.sum("n").cast("bigint").alias("input_rows"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).cast("bigint").alias("blank_rows"),
        F.sum(F.when(~F.col("blank"), F.col("n") - 1).otherwise(0)).cast("bigint").alias("duplicate_rows"),
        F.count_if(~F.col("blank")).cast("bigint").alias("silver_rows"),
    )
