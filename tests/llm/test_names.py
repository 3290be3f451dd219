"""Columns of other names than the operators expect, and of names they use themselves."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from .helpers import prose

CLASH = ["_id", "_hash", "_lines", "_class", "removed", "class", "id", "text_hash", "a.b"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_with_clashing_columns(spark, docs, tmp_dir, name, stage):
    same = prose(1, 80)
    rows = [(1, prose(2, 120), "en", "s"), (2, same, "en", "s"), (3, same, "en", "t"), (None, prose(3, 30), "en", None)]
    spark.createDataFrame([(1, prose(9, 40))], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    plain = docs(rows)
    clashing = plain.withColumns({c: F.lit(f"x{c}") for c in CLASH})
    expected = stage(spark, plain, tmp_dir)
    got = stage(spark, clashing, tmp_dir)
    key = lambda frame: sorted(map(str, frame.collect()))
    if name != "mixture":
        assert got.columns == clashing.columns
        assert {r[c] for r in got.select(*[f"`{c}`" for c in CLASH]).collect() for c in ["_id"]} <= {"x_id"}
        got = got.select(*plain.columns)
    assert key(got) == key(expected)
