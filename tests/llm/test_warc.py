from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from postolake.llm import warc

PAGES = "page_id long, url string, html string"


def _expected(rows):
    first = {}
    for p, _, h in rows:
        if p is not None:
            key = (h or "").encode()
            first[key] = min(first.get(key, p), p)
    out = []
    for p, _, h in rows:
        body = (h or "").encode()
        f = first.get(body)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        response = f is None or p == f
        out.append((p, len(body), digest, "response" if response else "revisit", None if response else f))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = [
        (1, "http://a/", "<p>x</p>"),
        (2, "http://b/", "<p>x</p>"),
        (-3, "http://c/", "<p>é漢</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n"),
        (4, None, None),
        (5, "", ""),
        (6, "http://e/\r\nWARC-Type: evil", "\x00\r\n\r\n\r\n\r\n"),
        (7, "http://f/", "y" * 300_000),
        (8, "http://f/", "y" * 300_000),
        (None, "http://n/", "<p>x</p>"),
        (None, "http://n/", "only nulls"),
        (9, "http://r/", "repeated"),
        (9, "http://r/", "repeated"),
        (10, "http://r/", "repeated"),
    ]
    out = warc.page_round_trip(spark.createDataFrame(rows, PAGES))
    assert sorted(map(tuple, out.collect()), key=str) == _expected(rows)


def test_archives_are_cut_by_bytes(spark, tmp_path):
    """Short pages share an archive, those of 5 MB have one each, and all come back."""
    rows = [(k, "u", "s" * (k % 50)) for k in range(200)] + [(1000 + k, "u", chr(97 + k) * 5_000_000) for k in range(3)]
    rows += [(2000 + k, "u", f"{k:06d}" * 100) for k in range(60)]
    pages = spark.createDataFrame(rows, PAGES).repartition(2)
    captures = pages.selectExpr("page_id AS capture_id", "url", "html AS payload")
    warc.write_archives(captures, f"{tmp_path}/w", archive_bytes=1 << 20)
    sizes = {}
    for file in (tmp_path / "w").glob("*.gz"):
        records = list(warc.parse(file.read_bytes()))
        names = [r["record_id"] for r in records if r["type"] in ("response", "revisit")]
        sizes[file.name] = (sum(r["payload_bytes"] for r in records if r["type"] == "response"), len(names))
        # a capture's records stay together
        assert sorted(c for r in records for c in r["concurrent_to"]) == sorted(names * 2)
    assert sum(n for _, n in sizes.values()) == len(rows)
    assert sorted(s for s, _ in sizes.values())[-3:] == [5_000_000] * 3
    assert all(s <= 1 << 20 or n == 1 for s, n in sizes.values())
    assert sorted(map(tuple, warc.page_round_trip(pages).collect()), key=str) == _expected(rows)
    with pytest.raises(AnalysisException):
        warc.write_archives(captures, f"{tmp_path}/w")


def test_responses_are_spread(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = warc.page_round_trip(spark.createDataFrame([(k, "u", f"page {k}") for k in range(2000)], PAGES))
        parts = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(parts) == 2000 and max(parts) <= 2 * 2000 / len(parts)


def test_min_bytes_and_empty_table(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    kinds = {r["page_id"]: r["record_type"] for r in warc.page_round_trip(spark.createDataFrame(rows, PAGES), min_bytes=3).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.page_round_trip(spark.createDataFrame([], PAGES)).collect() == []


def _record(kind, name, body, **headers):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"Content-Length: {len(body)}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi"


def test_transactions_follow_either_direction(spark, tmp_path):
    one = _record("warcinfo", "w", b"software: x") + _record("request", "q1", b"GET /", WARC_Concurrent_To="<r1>")
    one += _record("response", "r1", HTTP) + _record("metadata", "m1", b"a: b", WARC_Concurrent_To="<r1>")
    two = _record("response", "r2", HTTP, WARC_Concurrent_To="<q2>") + _record("request", "q2", b"GET /2")
    two += _record("request", "lost", b"GET /3", WARC_Concurrent_To="<nowhere>")
    (tmp_path / "one.warc").write_bytes(one)
    half = two.index(b"WARC/1.1", 10)
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(two[:half]) + gzip.compress(two[half:]))
    out = {r["record_id"]: r for r in warc.transactions(warc.read_records(spark, f"file://{tmp_path}")).collect()}
    assert set(out) == {"<r1>", "<r2>"}
    assert [x["record_id"] for x in out["<r1>"]["requests"]] == ["<q1>"]
    assert [x["fields"] for x in out["<r1>"]["metadata"]] == ["a: b"]
    assert [x["record_id"] for x in out["<r2>"]["requests"]] == ["<q2>"] and out["<r2>"]["metadata"] == []
    assert bytes(out["<r1>"]["payload"]) == b"hi" and out["<r1>"]["http_status"] == "HTTP/1.1 200 OK"


@pytest.mark.parametrize("cut", [lambda d: d[:-3], lambda d: d[5:], lambda d: gzip.compress(d)[:-9]])
def test_damaged_archives_raise(cut):
    data = _record("response", "r", HTTP)
    assert len(list(warc.parse(data))) == 1
    with pytest.raises(ValueError):
        list(warc.parse(cut(data)))
