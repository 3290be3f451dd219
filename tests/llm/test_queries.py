"""Registered queries on the smallest tables: oracles where SQL has them, contract columns, recall."""

from __future__ import annotations

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from postolake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op4_benchmark_decontamination": {
        "doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean",
    },
    "op5_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op7_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op9_lm_scoring": {
        "doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double",
    },
    "op10_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6_ngram_jaccard_join": {"doc_id": "bigint", "class_id": "bigint", "n_links": "bigint"},
    "op8_line_dedup": {"doc_id": "bigint", "text": "string", "n_removed": "bigint"},
    "op2_license_scan": {"doc_id": "bigint", "license": "string", "dice": "double"},
    "op13_token_alignment": {
        "doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string",
    },
    "op11_quality_rules": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op12_phrase_mining": {
        "lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint",
    },
    "op3_quality_classifier": {"doc_id": "bigint", "quality": "double", "keep": "boolean"},
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert any(k.startswith(f"op{n}_") for k in names)
    assert "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_rows_and_oracles(spark, name):
    out = QUERIES[name](spark, SF)
    types = dict(out.dtypes)
    assert COLUMNS[name].items() <= types.items()
    if name in ORACLES:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        expected = con.execute(ORACLES[name]).df()
        columns = list(expected.columns)
        got = out.select(*columns).toPandas()
        key = lambda df: sorted(map(str, df.astype(object).where(df.notna(), None).values.tolist()))
        assert key(got) == key(expected)
    elif "doc_id" in types:
        n = spark.read.parquet(f"{SF}/documents.parquet").count()
        assert out.count() == n


def test_recall_of_the_search_on_the_given_vectors(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids = np.array([r[0] for r in rows])
    data = np.array([r[1] for r in rows], dtype=np.float64)
    found = {}
    for r in QUERIES["op1_nearest_neighbours"](spark, SF).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = data @ data[q]
        score[q] = -np.inf
        hits += len({int(ids[i]) for i in np.argsort(-score, kind="stable")[:20]} & found[int(ids[q])])
    assert hits >= 0.9 * 20 * len(found)
