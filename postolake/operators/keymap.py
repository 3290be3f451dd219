"""Dimension keys that outlive a reload: a versioned map from members to ids.

The source system truncates and renumbers its dimensions with every load, so an
id means another member afterwards. A ``KeyMap`` is a folder of loads; each holds
only the members that were new then, with ids after all earlier ones. A load is
written to a side folder and moved to its number in one step: readers see it
whole or not at all, and of two writers that made the same number one fails and
may try again. Old members keep their ids whatever files a load brings, and in
which order.

New members are found by an anti join (NULL equals NULL) and numbered by rank in
ranges with offsets of partitions (``surrogate.rank_ids``), so nothing passes
through one task; a load costs the distinct members it brings, not the fact.
"""

from __future__ import annotations

import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postolake.operators.surrogate import rank_ids


class KeyConflictError(RuntimeError):
    """Another load took the number this one was written for."""


class KeyMap:
    def __init__(self, spark: SparkSession, root: str, keys: list[str], id_col: str):
        self.spark, self.root, self.keys, self.id_col = spark, root.rstrip("/"), keys, id_col
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def loads(self) -> list[int]:
        """Numbers of the committed loads, ascending."""
        if not self._fs.exists(self._path(self.root)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.root))]
        return sorted(int(n[5:]) for n in names if n.startswith("load="))

    def read(self, upto: int | None = None) -> DataFrame | None:
        """(id, keys..., load) of all members known after load ``upto`` (default: the last); None before the first."""
        numbers = [n for n in self.loads() if upto is None or n <= upto]
        if not numbers:
            return None
        parts = [
            self.spark.read.parquet(f"{self.root}/load={n:09d}").withColumn("load", F.lit(n)) for n in numbers
        ]
        return reduce(DataFrame.unionByName, parts)

    def extend(self, members: DataFrame) -> DataFrame:
        """Give ids to the members not seen before and commit them as a load; the whole map after it."""
        known = self.read()
        number = (self.loads() or [0])[-1] + 1
        fresh = members.select(*self.keys).distinct()
        last = 0
        if known is not None:
            old = known.select(*[F.col(k).alias(f"_{k}") for k in self.keys])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
            fresh = fresh.join(old, same, "left_anti")
            last = known.agg(F.max(self.id_col)).first()[0] or 0
        ided = rank_ids(fresh, [F.col(k).asc_nulls_first() for k in self.keys], self.id_col)
        ided = ided.withColumn(self.id_col, F.col(self.id_col) + last)
        side = f"{self.root}/_writing-{uuid.uuid4().hex}"
        ided.write.parquet(side)
        self._commit(side, number)
        return self.read(number)

    def _commit(self, side: str, number: int) -> None:
        target = self._path(f"{self.root}/load={number:09d}")
        try:
            # a rename onto a folder would move into it on some file systems
            moved = not self._fs.exists(target) and self._fs.rename(self._path(side), target)
        except Py4JJavaError as problem:
            raise KeyConflictError(str(problem)) from problem
        if not moved:
            self._fs.delete(self._path(side), True)
            raise KeyConflictError(f"load {number} of {self.root} was committed by another writer")

    def attach(self, rows: DataFrame, upto: int | None = None) -> DataFrame:
        """``rows`` with the id of their members (NULL equals NULL); unknown members get a NULL id."""
        known = self.read(upto)
        if known is None:
            return rows.withColumn(self.id_col, F.lit(None).cast("bigint"))
        held = known.select(self.id_col, *[F.col(k).alias(f"_{k}") for k in self.keys])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        return rows.join(held, same, "left").drop(*[f"_{k}" for k in self.keys])
