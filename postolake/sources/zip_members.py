"""Zip archives read member by member: a Python data source (``zip_members``).

A zip keeps the places of its members in a directory at its end. Planning reads
just these directories, and members (not archives) are dealt to tasks, so an
archive of any size is read by many tasks and never held in memory: a task seeks
to its members and streams them. Each member is read through once first, which
checks its CRC and finds its charset; only then are its lines given, so a damaged
member yields one row with its error and no line, and the other members of its
archive are read. An archive without a readable directory yields one error row.

Archives must lie on a file system that Arrow reads with seeks (a mounted folder,
HDFS, S3, GCS); ``archives.expand_archives`` reads through Spark's own file reader
instead, an archive a task.
"""

from __future__ import annotations

import fnmatch
import io
import re
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from postolake.session import ship_package
from postolake.sources.archives import LINES_SCHEMA, _DAMAGE, _charset

TASK_BYTES = 64 << 20
BATCH_LINES = 20_000
_PLANNERS = 32
_TYPES = pa.schema(
    [("archive", pa.string()), ("member", pa.string()), ("line_no", pa.int64()), ("line", pa.string()), ("error", pa.string())]
)


@dataclass
class Members(InputPartition):
    """Some members of one archive; ``error`` is set if its directory cannot be read."""

    archive: str
    names: tuple[str, ...]
    error: str | None = None


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    local = re.sub(r"^file:/+", "/", path)
    if "://" not in local:
        return fs.LocalFileSystem(), unquote(local) if local != path else local
    return fs.FileSystem.from_uri(path)


class _Archive:
    """An Arrow file whose seeks out of range are ``OSError``, which zipfile expects."""

    def __init__(self, file: pa.NativeFile):
        self._file = file
        self.read, self.tell, self.seekable = file.read, file.tell, file.seekable

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            return self._file.seek(offset, whence)
        except ValueError as problem:
            raise OSError(str(problem)) from problem


def _told(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


def _rows(archive: str, member: str | None, first: int, lines: list[str] | None, error: str | None) -> pa.RecordBatch:
    n = 1 if lines is None else len(lines)
    columns = [
        pa.array([archive] * n),
        pa.array([member] * n, pa.string()),
        pa.array(range(first, first + n) if lines is not None else [None], pa.int64()),
        pa.array(lines if lines is not None else [None], pa.string()),
        pa.array([error] * n, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_TYPES)


class MemberReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.glob = options.get("pathGlobFilter", "*.zip")
        self.task_bytes = int(options.get("taskBytes", TASK_BYTES))

    def partitions(self) -> list[Members]:
        store, base = file_system(self.path)
        found = store.get_file_info(base)
        if found.type == fs.FileType.File:
            archives = [base]
        else:
            listed = store.get_file_info(fs.FileSelector(base, recursive=True))
            archives = sorted(f.path for f in listed if f.is_file and fnmatch.fnmatchcase(f.base_name, self.glob))
        with ThreadPoolExecutor(_PLANNERS) as pool:
            planned = pool.map(lambda archive: self._plan(store, archive), archives)
            return [part for parts in planned for part in parts]

    def _plan(self, store: fs.FileSystem, archive: str) -> list[Members]:
        """The archive's members, neighbours together up to ``task_bytes`` of compressed data."""
        try:
            with store.open_input_file(archive) as file, zipfile.ZipFile(_Archive(file)) as directory:
                members = [m for m in directory.infolist() if not m.is_dir()]
        except _DAMAGE as problem:
            return [Members(archive, (), _told(problem))]
        parts, names, size = [], [], 0
        for m in members:
            if names and size + m.compress_size > self.task_bytes:
                parts.append(Members(archive, tuple(names)))
                names, size = [], 0
            names.append(m.filename)
            size += m.compress_size
        return parts + ([Members(archive, tuple(names))] if names else [])

    def read(self, partition: Members | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for when there is nothing to read
            return
        if partition.error is not None:
            yield _rows(partition.archive, None, 0, None, partition.error)
            return
        store, _ = file_system(self.path)
        with store.open_input_file(partition.archive) as file, zipfile.ZipFile(_Archive(file)) as archive:
            for name in partition.names:
                try:
                    charset = _charset(archive, name)
                except _DAMAGE as problem:
                    yield _rows(partition.archive, name, 0, None, _told(problem))
                    continue
                yield from _lines(archive, partition.archive, name, charset)


def _lines(archive: zipfile.ZipFile, path: str, name: str, charset: str) -> Iterator[pa.RecordBatch]:
    with archive.open(name) as raw, io.TextIOWrapper(raw, encoding=charset, newline=None) as text:
        held, first = [], 0
        for line in text:
            held.append(line.rstrip("\n"))
            if len(held) == BATCH_LINES:
                yield _rows(path, name, first, held, None)
                held, first = [], first + len(held)
        if held:
            yield _rows(path, name, first, held, None)


class ZipMembers(DataSource):
    """``spark.read.format("zip_members").load(path)``; options pathGlobFilter, taskBytes."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return LINES_SCHEMA

    def reader(self, schema) -> MemberReader:
        return MemberReader(self.options)


def read_members(spark: SparkSession, root: str, glob: str = "*.zip", task_bytes: int = TASK_BYTES) -> DataFrame:
    """(archive, member, line_no, line, error) of all archives under ``root``, dealt to tasks by member."""
    ship_package(spark)
    spark.dataSource.register(ZipMembers)
    reader = spark.read.format("zip_members").option("pathGlobFilter", glob).option("taskBytes", str(task_bytes))
    return reader.load(root)


def rejected_members(lines: DataFrame) -> DataFrame:
    """(archive, member, error); ``member`` is null where the whole archive cannot be read."""
    return lines.where("error is not null").select("archive", "member", "error")
