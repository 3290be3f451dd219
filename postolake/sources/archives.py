"""Archive expansion: zip files -> text lines, distributed by archive.

``binaryFile`` gives one row per archive and ``mapInArrow`` opens it in its
task. Every member is read through once first, which checks its CRC and whether
it is valid UTF-8; only when all members are sound are lines emitted, decoded as
UTF-8 or else latin-1, in bounded batches. A damaged, encrypted or unsupported
archive yields one row with its error and no lines.

A zip is not splittable, so one archive is one task, and the archive's bytes
are one ``binaryFile`` cell (at most 2 GB; a larger file fails the read with
Spark's own error). Everything after expansion is partitioned Spark work.
"""

from __future__ import annotations

import codecs
import io
import zipfile
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postolake.session import ship_package
from postolake.sources.bronze_lines import parse_lines

LINES_SCHEMA = "archive string, member string, line_no long, line string, error string"
_COLUMNS = ["archive", "member", "line_no", "line", "error"]
_BATCH = 50_000
_DAMAGE = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, OSError, RuntimeError, ValueError)


def _charset(zf: zipfile.ZipFile, name: str) -> str:
    """Reads a whole member (checking its CRC); its charset."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    valid = True
    with zf.open(name) as fh:
        for chunk in iter(lambda: fh.read(1 << 20), b""):
            if valid:
                try:
                    decoder.decode(chunk)
                except UnicodeDecodeError:
                    valid = False
    if valid:
        try:
            decoder.decode(b"", final=True)
        except UnicodeDecodeError:
            valid = False
    return "utf-8-sig" if valid else "latin-1"


def _rows(path: str, member: str | None, first: int | None, lines: list, error: str | None = None) -> pa.RecordBatch:
    """Lines of one member that follow each other from number ``first``."""
    n = len(lines)
    columns = [
        pa.array([path] * n, pa.string()),
        pa.array([member] * n, pa.string()),
        pa.nulls(n, pa.int64()) if first is None else pa.array(range(first, first + n), pa.int64()),
        pa.array(lines, pa.string()),
        pa.array([error] * n, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_COLUMNS)


def _archive_rows(path: str, content: bytes) -> Iterator[pa.RecordBatch]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as zf:
            members = {m: _charset(zf, m) for m in zf.namelist() if not m.endswith("/")}
    except _DAMAGE as problem:
        yield _rows(path, None, None, [None], f"{type(problem).__name__}: {problem}")
        return
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        for name, charset in members.items():
            with zf.open(name) as fh, io.TextIOWrapper(fh, encoding=charset, newline=None) as text:
                first = 0
                while lines := [line.rstrip("\n") for line in islice(text, _BATCH)]:
                    yield _rows(path, name, first, lines)
                    first += len(lines)


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            yield from _archive_rows(path.as_py(), content.as_py())


def expand_content(zips: DataFrame) -> DataFrame:
    """(path, content) of archives -> (archive, member, line_no, line, error)."""
    ship_package(zips.sparkSession)
    return zips.select("path", "content").mapInArrow(_expand, LINES_SCHEMA)


def expand_archives(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """(archive, member, line_no, line, error): every line of sound archives, one error row of others."""
    zips = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
    )
    return expand_content(zips)  # unlike _metadata.file_path, this path is not URI-encoded


def rejected_archives(expanded: DataFrame) -> DataFrame:
    """(archive, error) of the archives that could not be read whole."""
    return expanded.where("error is not null").select("archive", "error")


def archive_members_to_bronze(expanded: DataFrame, members_glob: str = "*.csv", rejects: str = "raise") -> DataFrame:
    """Parse member lines as survey CSV rows, each member under its own header.

    ``filename`` is ``archive!member``. Quoted fields spanning lines are not
    supported on this path. ``rejects`` is that of ``parse_lines``.
    """
    like = members_glob.replace("*", "%")
    lines = expanded.where(F.col("error").isNull() & F.lower("member").like(like.lower())).select(
        F.replace(F.concat_ws("!", "archive", "member"), F.lit("%"), F.lit("%25")).alias("filename"),
        F.lit(0).cast("long").alias("block"),
        F.col("line_no").alias("pos"),
        F.col("line").alias("value"),
    )
    return parse_lines(lines, rejects=rejects)
