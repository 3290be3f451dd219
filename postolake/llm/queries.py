"""Registered queries of the numbered operators and their DuckDB oracles."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, phrases, quality, rules, warc
from .align import align
from .ann import nearest
from .hmm import score_texts
from .langid import identify
from .licenses import scan_licenses
from .line_dedup import dedup_lines
from .mixing import mix_single_source
from .ngram_join import ngram_jaccard_join
from .scratch import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_table(spark, sf_dir, "documents"))


@_query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dedup_lines(_table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), "removed")


@_query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


@_query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLES["op4_benchmark_decontamination"] = decontaminate.ORACLE


@_query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_round_trip(_table(spark, sf_dir, "pages"))


ORACLES["op5_warc"] = warc.ORACLE


@_query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_single_source(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@_query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


@_query
def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@_query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


@_query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), F.col("source"), F.col("lang")
    )


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(_table(spark, sf_dir, "documents")).drop("groups")


@_query
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(_table(spark, sf_dir, "documents"))


ORACLES["op12_phrase_mining"] = phrases.ORACLE


@_query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.apply_rules(_table(spark, sf_dir, "documents"))
    return found.drop("char_distance", "word_distance")


ORACLES["op11_quality_rules"] = rules.ORACLE
