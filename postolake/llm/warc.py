"""WARC archives: write captures, read records, assemble transactions.

``write_archives`` turns each capture into request, response (or revisit) and
metadata records and stores them with Spark's text writer, so files appear by
Spark's commit protocol and a lost executor leaves no partial archive. The
record separator of two CRLF is the writer's line separator. Archives are gzip
files. Captures are written by classes of payload size, each class with so many
records a file that its payloads stay within ``ARCHIVE_BYTES``; a larger payload
has an archive of its own. That bounds what a reading task holds.

``read_records`` parses archives by Content-Length; ``transactions`` joins
request and metadata records to their response or revisit through
WARC-Concurrent-To, in whichever direction the header points, and emits one
nested row per capture.

Among captures with equal payloads of at least ``min_bytes`` bytes the one with
the smallest id is a response, the others are revisits that refer to it; rows
that repeat that smallest id with the same payload are responses too. A null
payload is empty. A null id never is the smallest; if a payload only has null
ids, each is a response. A null url writes no WARC-Target-URI. Line breaks in
a url are percent-encoded. Equal payloads are recognised by SHA-1 and length.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_work_dir
from .scratch import written

ARCHIVE_BYTES = 64 << 20
RECORDS_PER_FILE = 6000
_RECORDS_A_CAPTURE = 3
_CLASS = 8
_CRLF = "\r\n"
_END = b"\r\n\r\n"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexadecimal: Column) -> Column:
    """Base32 of a 160-bit hexadecimal string: each group of 5 hex digits is 4 characters."""
    number = lambda k: F.conv(F.substring(hexadecimal, 5 * (k // 4) + 1, 5), 16, 10).cast("int")
    char = lambda k: F.substr(
        F.lit(_ALPHABET), F.shiftright(number(k), 15 - 5 * (k % 4)).bitwiseAND(31) + 1, F.lit(1)
    )
    return F.concat(*(char(k) for k in range(32)))


def _record_id(kind: str) -> Column:
    key = F.concat_ws("|", F.lit(kind), F.coalesce(F.col("capture_id").cast("string"), F.lit("null")), F.col("sha1"))
    return _urn(F.md5(key))


def _urn(md5: Column) -> Column:
    parts = [F.substring(md5, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _headers(*lines) -> Column:
    """Header block; a null line is left out."""
    return F.concat(F.concat_ws(_CRLF, F.lit("WARC/1.1"), *lines), F.lit(_CRLF * 2))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def classify(captures: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add sha1, bytes and first_id (the response's id, for revisits only) to (capture_id, url, payload binary)."""
    sized = captures.withColumn("sha1", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    narrow = sized.select("capture_id", "sha1", "bytes")
    groups = (
        narrow.where(F.col("bytes") >= min_bytes)
        .groupBy("sha1", "bytes")
        .agg(F.min("capture_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null")
        .drop("n")
    )
    revisits = (
        narrow.join(groups, ["sha1", "bytes"])
        .where("capture_id is null or capture_id <> first_id")
        .select(F.col("capture_id").alias("_id"), F.col("sha1").alias("_sha1"), "first_id")
        .distinct()
    )
    return sized.join(revisits, F.col("capture_id").eqNullSafe(F.col("_id")) & (F.col("sha1") == F.col("_sha1")), "left").drop(
        "_id", "_sha1"
    )


def _records(classified: DataFrame, date: str) -> DataFrame:
    """One row per record: its bytes up to, not including, the closing two CRLF."""
    revisit = F.col("first_id").isNotNull()
    first_key = F.concat_ws("|", F.lit("response"), F.col("first_id").cast("string"), F.col("sha1"))
    own = F.when(revisit, _record_id("revisit")).otherwise(_record_id("response"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    target = _line("WARC-Target-URI", url)
    when = F.lit(f"WARC-Date: {date}")
    digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1"))))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(_CRLF * 2),
    )
    response = F.concat(
        _headers(
            F.when(revisit, "WARC-Type: revisit").otherwise("WARC-Type: response"),
            _line("WARC-Record-ID", own),
            when,
            target,
            digest,
            F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            F.when(revisit, _line("WARC-Refers-To", _urn(F.md5(first_key)))),
            F.lit("Content-Type: application/http;msgtype=response"),
            _line("Content-Length", (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string")),
        ),
        http,
        F.when(revisit, "").otherwise(F.col("payload").cast("string")),
    )
    ask = F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(f" HTTP/1.1{_CRLF * 2}"))
    request = F.concat(
        _headers(
            F.lit("WARC-Type: request"),
            _line("WARC-Record-ID", _record_id("request")),
            when,
            target,
            _line("WARC-Concurrent-To", own),
            F.lit("Content-Type: application/http;msgtype=request"),
            _line("Content-Length", F.octet_length(ask).cast("string")),
        ),
        ask,
    )
    fields = F.concat_ws(_CRLF, F.lit("via: corpus"), _line("capture-id", F.col("capture_id").cast("string")), F.lit(""))
    metadata = F.concat(
        _headers(
            F.lit("WARC-Type: metadata"),
            _line("WARC-Record-ID", _record_id("metadata")),
            when,
            target,
            _line("WARC-Concurrent-To", own),
            F.lit("Content-Type: application/warc-fields"),
            _line("Content-Length", F.octet_length(fields).cast("string")),
        ),
        fields,
    )
    return classified.select(F.explode(F.array(request, response, metadata)).alias("value"))


def write_archives(
    captures: DataFrame,
    path: str,
    min_bytes: int = 0,
    date: str = "2020-01-01T00:00:00Z",
    records_per_file: int = RECORDS_PER_FILE,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write (capture_id, url, payload) as gzip WARC files under ``path``; payload is binary or string.

    The first class holds payloads of which ``records_per_file`` records fit into
    ``archive_bytes``, each further one payloads up to ``_CLASS`` times as long,
    down to one capture a file. Only classes that occur are written.
    """
    plain = captures.select(
        "capture_id", "url", F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload")
    )
    counts = [max(1, records_per_file // _RECORDS_A_CAPTURE)]
    while counts[-1] > 1:
        counts.append(max(1, counts[-1] // _CLASS))
    size = F.octet_length("payload")
    number = F.lit(len(counts) - 1)
    for k in reversed(range(len(counts) - 1)):
        number = F.when(size <= archive_bytes // counts[k], F.lit(k)).otherwise(number)
    # one row a class; an empty table still gets a folder
    occurring = sorted(r["k"] for r in plain.select(number.alias("k")).distinct().collect()) or [0]
    records = classify(plain, min_bytes)
    for k in occurring:
        mode = "error" if k == occurring[0] else "append"
        _records(records.where(number == k) if len(occurring) > 1 else records, date).write.mode(mode).options(
            lineSep=_CRLF * 2, compression="gzip", maxRecordsPerFile=_RECORDS_A_CAPTURE * counts[k]
        ).text(path)


_RECORD = (
    "archive string, record_id string, type string, date string, target_uri string, refers_to string, "
    "concurrent_to array<string>, content_type string, http_status string, fields string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def _inflate(raw: bytes) -> bytes:
    if raw[:2] != b"\x1f\x8b":
        return raw
    out = []
    while raw:
        member = zlib.decompressobj(31)
        out.append(member.decompress(raw))
        if not member.eof:
            raise ValueError("archive ends inside a gzip member")
        raw = member.unused_data
    return b"".join(out)


def _named(block: bytes) -> list[tuple[str, str]]:
    lines = block.decode("utf-8", "replace").split(_CRLF)
    return [(k.strip().lower(), v.strip()) for k, s, v in (x.partition(":") for x in lines) if s]


def parse(raw: bytes, with_payload: bool = True):
    """Records of one archive, by Content-Length; raises on anything that is not a record."""
    data = _inflate(raw)
    at = 0
    while at < len(data):
        stop = data.find(_END, at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        headers = _named(data[at:stop])
        one = dict(headers)
        start = stop + 4
        end = start + int(one["content-length"])
        if data[end : end + 4] != _END:
            raise ValueError(f"record at byte {at} does not end after its Content-Length")
        kind, content = one.get("warc-type"), data[start:end]
        row = {
            "record_id": one.get("warc-record-id"),
            "type": kind,
            "date": one.get("warc-date"),
            "target_uri": one.get("warc-target-uri"),
            "refers_to": one.get("warc-refers-to"),
            "concurrent_to": [v for k, v in headers if k == "warc-concurrent-to"],
            "content_type": one.get("content-type"),
            "http_status": None,
            "fields": None,
            "payload_bytes": None,
            "payload_digest": one.get("warc-payload-digest", "").rpartition(":")[2] or None,
            "payload": None,
        }
        if kind in ("response", "revisit"):
            head, _, body = content.partition(_END)
            row["http_status"] = head.partition(b"\r\n")[0].decode("latin-1")
            if kind == "response":
                row["payload_bytes"] = len(body)
                row["payload_digest"] = base64.b32encode(hashlib.sha1(body).digest()).decode()
                row["payload"] = body if with_payload else None
            else:
                row["payload_bytes"] = int(dict(_named(head)).get("content-length", 0))
        else:
            row["fields"] = content.decode("utf-8", "replace")
        yield row
        at = end + 4


def _parse_files(batches, with_payload: bool):
    schema = pa.schema(
        [("archive", pa.string()), *((n, pa.string()) for n in ("record_id", "type", "date", "target_uri", "refers_to"))]
        + [("concurrent_to", pa.list_(pa.string()))]
        + [(n, pa.string()) for n in ("content_type", "http_status", "fields")]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    )
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows, size = [], 0
            for row in parse(content.as_buffer().to_pybytes(), with_payload):
                rows.append({"archive": path} | row)
                size += len(row["payload"] or b"") + 500
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives under ``path``; payload is null unless ``with_payload``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(lambda it: _parse_files(it, with_payload), _RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One row per response or revisit: its fields, and ``requests`` and ``metadata`` as arrays of structs.

    A request or metadata record belongs to the captures it names in
    WARC-Concurrent-To and to those that name it. Records that lead to no
    capture are left out; a capture stored n times under one record id comes
    out n times, with each attached record once.
    """
    primary = F.col("type").isin("response", "revisit")
    columns = [c for c in records.columns if c != "concurrent_to"]
    whole = F.struct(*columns)
    captures = records.where(primary)
    others = records.where(F.col("type").isin("request", "metadata"))
    named = others.select(F.explode("concurrent_to").alias("capture"), whole.alias("other"))
    naming = captures.select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("named"))
    turned = others.join(naming, F.col("record_id") == F.col("named")).select("capture", whole.alias("other"))
    empty = F.lit(None).cast(captures.select(whole.alias("s")).schema["s"].dataType)
    together = captures.select(F.col("record_id").alias("capture"), whole.alias("own"), empty.alias("other")).unionByName(
        named.unionByName(turned).select("capture", empty.alias("own"), "other")
    )
    attached = lambda kind: F.array_sort(F.collect_set(F.when(F.col("other.type") == kind, F.col("other"))))
    grouped = together.groupBy("capture").agg(
        F.first("own", ignorenulls=True).alias("own"),
        F.count("own").alias("n"),
        attached("request").alias("requests"),
        attached("metadata").alias("metadata"),
    )
    return (
        grouped.where("n > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select("own.*", "requests", "metadata")
    )


def page_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write (page_id, url, html) to archives in the shared folder, read them back, one row per page."""
    spark = pages.sparkSession
    path = shared_work_dir(spark, f"warc-{uuid.uuid4().hex}")
    write_archives(pages.select(F.col("page_id").alias("capture_id"), "url", F.col("html").alias("payload")), path, min_bytes)
    records = written(read_records(spark, path, with_payload=False), "warc-records")
    captures = transactions(records).select(
        "record_id",
        F.regexp_extract(F.col("metadata")[0]["fields"], r"(?m)^capture-id: (-?\d+)\r?$", 1).alias("page"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").alias("target"),
    )
    page_id = F.when(F.col("page") != "", F.col("page")).cast("long")
    own = captures.withColumn("page_id", page_id).drop("page")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = own.where("record_type = 'response'")
    referred = responses.select(F.col("record_id").alias("target"), F.col("page_id").alias("refers_to")).distinct()
    # responses refer to nothing: joined too, all would meet in the task of the null target
    revisits = own.where("record_type = 'revisit'").join(referred, "target", "left")
    return revisits.select(columns).unionByName(responses.withColumn("refers_to", F.lit(None).cast("long")).select(columns))


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS payload_bytes, upper(sha1(body)) AS x FROM p),
g AS (SELECT *, min(page_id) OVER (PARTITION BY x, payload_bytes) AS first_id FROM h),
b AS (SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(x, 5 * i + 1, 5))::INT) AS q FROM g)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32),
         lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((q[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31) + 1, 1)), 'string_agg', '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM b
"""
