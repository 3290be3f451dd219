"""End-to-end assembly of the lake from a set of driver tables.

``demo_lake`` gives bronze -> silver -> gold of ``sf_dir``, each layer built when
it is first asked for and once per Spark application and directory. Bronze,
silver and the fact are Parquet tables in the shared work folder, which every
executor reaches: silver feeds five gold builds, and a fixed copy makes the dense
fact ids repeatable across the two passes that compute them. Files are cut by
rows, so a task's sort stays within its memory however well they compress.

``run_batch`` is the production shape: it writes silver as Parquet partitioned
by year, reads it back (a deterministic scan), and writes the gold tables.
"""

from __future__ import annotations

import dataclasses
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from postolake.operators.gold import Gold, build_gold
from postolake.operators.silver import build_silver
from postolake.session import ensure_checkpoint_dir, freeing_shuffles, partitions_for, shared_work_dir, size_tasks
from postolake.sinks.parquet import read_gold, read_silver, write_gold, write_silver
from postolake.sources.demo import demo_bronze

__all__ = ["Lake", "demo_lake", "read_gold", "read_silver", "run_batch", "write_gold", "write_silver"]


# rows of a stored file, which a task reads, and of a partition that silver's aggregation sorts
TASK_ROWS = 500_000


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    def _stored(self, frame: DataFrame, name: str) -> DataFrame:
        path = shared_work_dir(self._spark, f"lake-{name}-{uuid.uuid4().hex}")
        with freeing_shuffles(self._spark):
            frame.write.option("maxRecordsPerFile", TASK_ROWS).option("compression", "zstd").parquet(path)
        return self._spark.read.schema(frame.schema).parquet(path)

    @cached_property
    def bronze(self) -> DataFrame:
        # The demo frame stands in for raw files: store it like them, so later
        # plans start from a plain scan instead of its generator expressions.
        return self._stored(demo_bronze(self._spark, self._sf_dir), "bronze")

    @cached_property
    def silver(self) -> DataFrame:
        with partitions_for(self._spark, self.bronze.count(), TASK_ROWS):  # counted from the footers
            return self._stored(build_silver(self.bronze), "silver")

    @cached_property
    def star(self) -> Gold:
        """Gold whose fact is not stored, for what reads dimensions only."""
        return build_gold(self.silver)

    @cached_property
    def gold(self) -> Gold:
        # fact ids depend on the partitions they are computed in, so the fact is stored before anything is built on it
        return dataclasses.replace(self.star, fact=self._stored(self.star.fact, "fact"))


_LAKES: dict[tuple[str, int, str], Lake] = {}


def demo_lake(spark: SparkSession, sf_dir: str) -> Lake:
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"))
    if key not in _LAKES:
        ensure_checkpoint_dir(spark)
        size_tasks(spark)
        _LAKES[key] = Lake(spark, sf_dir)
    return _LAKES[key]


def run_batch(spark: SparkSession, raw_bronze: DataFrame, root: str) -> Gold:
    """Bronze frame -> written silver -> written gold; returns gold read back."""
    write_silver(build_silver(raw_bronze), f"{root}/silver/combustiveis")
    silver = read_silver(spark, f"{root}/silver/combustiveis")
    write_gold(build_gold(silver, keep_year=True), f"{root}/gold")
    return read_gold(spark, f"{root}/gold")
