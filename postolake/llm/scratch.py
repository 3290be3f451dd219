"""Written intermediate tables and bounded driver-side arrays."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_work_dir, ship_package


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> None:
    """What the Python tasks of these operators rely on: the package on the workers, and small batches of text.

    Batches are bounded by bytes, so long texts do not pile up in a worker; a
    value other than Spark's default of 64 MB is left alone.
    """
    ship_package(spark)
    if spark.conf.get(BATCH_BYTES) == "67108864b":
        spark.conf.set(BATCH_BYTES, "8m")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage on storage that every executor reaches, so a lost
    executor costs only the running stage. ``DataFrame.checkpoint`` would
    compute the last stage twice.
    """
    spark = df.sparkSession
    path = shared_work_dir(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered_columns(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns ``c0, c1, ...``, which clash with no operator's names, and the new name of each."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def id_bitmap(ids: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bit array of ``2**bits`` positions with the bit of every id set.

    A one-sided membership filter: an id of the table always tests true. The
    size is fixed by ``bits`` whatever the number of ids; a crowded bitmap
    lets more strangers through, which the exact join after it drops.
    """
    position = F.col(column).bitwiseAND((1 << bits) - 1)
    rows = ids.select(position.alias("p")).select(
        F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("m")
    )
    table = rows.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[table.column("w").to_numpy()] = table.column("m").to_numpy().view(np.uint64)
    return out


def in_bitmap(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    p = ids & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) > 0

