"""Surrogate keys 1..N without gathering rows into one task.

``rank_ids``: id = rank of the row in a total order (dimensions). The frame is
range-partitioned and sorted on the order, checkpointed so both passes see the
same partitions, then each partition adds the row count of the partitions
before it. Only one row per partition reaches the (broadcast) offset table.

``dense_ids``: id = position in the frame's own scan order (the fact). No
sort; the input must be deterministic (a file scan or a checkpoint) because
the count pass and the id pass read it separately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postolake.session import ensure_checkpoint_dir

_POS = "_pos"
_PID = "_pid"


def _partition_offsets(positioned: DataFrame) -> DataFrame:
    """One row per partition: first position and rows before it."""
    counts = positioned.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_first"))
    # A window over one row per partition: bounded by the partition count.
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(_PID, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))


def _attach(positioned: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    offsets = _partition_offsets(positioned)
    joined = positioned.join(F.broadcast(offsets), _PID)
    new_id = (F.col("_offset") + F.col(_POS) - F.col("_first") + 1).cast("bigint").alias(id_col)
    return joined.select(new_id, *columns)


def rank_ids(
    df: DataFrame,
    order: list[Column],
    id_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = 1-based rank of each row under ``order`` (a total order)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    columns = df.columns
    # Without an explicit count AQE may merge adjacent ranges of a small
    # input; merged ranges stay in order, so ranks are unaffected.
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ordered = (
        ranged.sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    return _attach(ordered, id_col, columns)


def dense_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Add ``id_col`` = 1..N in the (deterministic) scan order of ``df``."""
    columns = df.columns
    positioned = df.withColumn(_PID, F.spark_partition_id()).withColumn(_POS, F.monotonically_increasing_id())
    return _attach(positioned, id_col, columns)
