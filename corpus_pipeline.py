"""Corpus pipeline: language, line dedup, near duplicates, decontamination, mixture.

Each stage takes (spark, docs, sf_dir) and returns a frame; the next stage reads
it back from Parquet. All stages but the last return the columns of
``documents``. The last returns one row per document that is left, with the
words the mixture takes from it (0: not in the mixture).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postolake.llm.decontaminate import without_contaminated
from postolake.llm.langid import with_language
from postolake.llm.line_dedup import dedup_lines
from postolake.llm.mixing import mix_single_source
from postolake.llm.ngram_join import one_of_each_class
from postolake.llm.scratch import prepare, written

# a character that is neither ASCII punctuation, space nor control
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language."""
    prepare(spark)
    return with_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that nearly repeat an earlier line; ``n_chars`` follows the text.

    A document that loses lines and has no word left goes with them.
    """
    prepare(spark)
    deduped = dedup_lines(docs)
    removed = F.col(f"`{deduped.columns[-1]}`")
    deduped = deduped.where((F.size(removed) == 0) | F.col("text").rlike(_WORD))
    kept = [F.length("text").cast("long").alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return deduped.select(*kept)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every near-duplicate class."""
    prepare(spark)
    return one_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents contaminated by the benchmark."""
    prepare(spark)
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources to their target weights."""
    prepare(spark)
    return mix_single_source(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
]

# The stages are not expressible in SQL; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
