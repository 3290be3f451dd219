"""The whole batch as one job: raw files -> quality -> silver -> gold.

``run_lake`` is what the source system's main program does, as Spark jobs:
read the bronze tree (per-file charset, archives included), run the quality suite (its result is
returned, it does not block, as in the source system; with ``sample="first"``
only the first file of the top level is checked, read under its own header so
column checks see the real file), write silver
partitioned by year, build and write gold, and return the load report.
Each stage's wall time is recorded.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postolake.operators.checks import load_report
from postolake.operators.gold import Gold, build_gold, gold_input
from postolake.operators.quality import default_suite, run_suite
from postolake.operators.silver import build_silver
from postolake.session import shared_work_dir, ship_package
from postolake.sinks.parquet import read_gold, read_silver, write_gold, write_silver
from postolake.sources.archives import archive_members_to_bronze, expand_archives, rejected_archives
from postolake.sources.bronze_csv import bronze_rejects, detect_encodings, literal_path, read_bronze, read_with_own_header
from postolake.sources.manifest import file_listing


@dataclass
class LakeRun:
    quality: DataFrame
    load_report: DataFrame
    gold: Gold
    rejects: DataFrame  # filename, reason, lines
    seconds: dict = field(default_factory=dict)


def run_lake(
    spark: SparkSession,
    bronze_root: str,
    out_root: str,
    sample: str = "first",
    include_archives: bool = True,
    encoding: str | None = None,
    suite=None,
    on_reject: str = "raise",
) -> LakeRun:
    """Run the batch. ``sample="first"`` needs a CSV file at the top level, as in the source system.

    CSV files without any expected column raise unless ``on_reject="skip"``;
    damaged archives are left out whole. Both are listed in ``rejects``.
    """
    seconds: dict[str, float] = {}
    ship_package(spark)

    def stage(name, fn):
        t0 = time.perf_counter()
        out = fn()
        seconds[name] = round(time.perf_counter() - t0, 3)
        return out

    rejects = spark.createDataFrame([], "filename string, reason string, lines long")

    def bronze_frame():
        raw = read_bronze(spark, bronze_root, encoding=encoding, rejects=on_reject)
        refused = bronze_rejects(spark, bronze_root) if on_reject == "skip" and encoding is None else rejects
        if include_archives and not file_listing(spark, bronze_root, "*.zip").isEmpty():
            # expanded once: lines are read for charset and header, then parsed
            path = shared_work_dir(spark, f"archives-{uuid.uuid4().hex}")
            expand_archives(spark, bronze_root).write.parquet(path)
            expanded = spark.read.parquet(path)
            raw = raw.unionByName(archive_members_to_bronze(expanded, rejects=on_reject))
            damaged = rejected_archives(expanded).select(
                F.col("archive").alias("filename"), F.col("error").alias("reason"), F.lit(0).cast("long").alias("lines")
            )
            refused = refused.unionByName(damaged)
        return raw, refused

    raw, rejects = stage("bronze", bronze_frame)

    def quality_stage():
        frame = raw
        if sample == "first":
            # The first file by name of the top level: found in the listing
            # (no file contents read); just that file is scanned.
            top = file_listing(spark, bronze_root, "*.csv", recursive=False)
            first = top.agg(F.min("path").alias("p")).first()["p"]
            if first is None:
                raise FileNotFoundError(f"no CSV file at the top level of {bronze_root}; use sample='all'")
            name = literal_path(first)
            charset = encoding or detect_encodings(spark, name, recursive=False).first()["encoding"]
            frame = read_with_own_header(spark, name, charset)
        return spark.createDataFrame(run_suite(frame, suite or default_suite(), "all").collect())

    quality = stage("quality", quality_stage)
    silver_path = f"{out_root}/silver/combustiveis"
    stage("silver", lambda: write_silver(build_silver(raw), silver_path))

    def gold_stage():
        silver = read_silver(spark, silver_path)
        write_gold(build_gold(silver, keep_year=True), f"{out_root}/gold")
        return silver

    silver = stage("gold", gold_stage)
    gold = read_gold(spark, f"{out_root}/gold")
    report = stage("report", lambda: spark.createDataFrame(load_report(gold_input(silver), gold.fact).collect()))
    return LakeRun(quality, report, gold, rejects, seconds)
