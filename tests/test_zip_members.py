"""Archives by member."""

from __future__ import annotations

import io
import os
import zipfile

from postolake.constants import BRONZE_HEADERS
from postolake.sources.archives import archive_members_to_bronze, expand_archives
from postolake.sources.zip_members import read_members, rejected_members

HEADER = ";".join(BRONZE_HEADERS)


def archive(path, members, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as zf:
        for name, data in members.items():
            zf.writestr(name, data)


def spoil(path, member):
    """Change a byte inside a member's compressed data."""
    with zipfile.ZipFile(path) as zf:
        info = zf.getinfo(member)
    with open(path, "r+b") as f:
        at = info.header_offset + 30 + len(info.filename.encode()) + info.compress_size // 2
        f.seek(at)
        byte = f.read(1)[0]
        f.seek(at)
        f.write(bytes([byte ^ 255]))


def test_equals_reading_whole_archives(spark, tmp_dir):
    lines = [HEADER] + [f"N;AM;Manaus {k};á" + ";" * 12 for k in range(50)]
    text = "\n".join(lines) + "\n"
    archive(f"{tmp_dir}/a b%1.zip", {"u.csv": text, "dir/l 1.csv": text.encode("latin-1"), "empty.csv": "", "dir/": ""})
    os.makedirs(f"{tmp_dir}/sub")
    archive(f"{tmp_dir}/sub/c.zip", {"w.csv": text.replace("\n", "\r\n")}, zipfile.ZIP_STORED)
    by_member, whole = read_members(spark, tmp_dir), expand_archives(spark, tmp_dir)
    names = ["member", "line_no", "line", "error"]
    assert sorted(map(tuple, by_member.select(names).collect())) == sorted(map(tuple, whole.select(names).collect()))
    cells = lambda df: sorted(str(r[:16]) for r in archive_members_to_bronze(df).collect())
    assert cells(by_member) == cells(whole) and len(cells(whole)) == 150


def test_thousand_members_are_dealt_to_many_tasks(spark, tmp_dir):
    archive(f"{tmp_dir}/many.zip", {f"m{k}.csv": f"{k}\nx{k}\n" for k in range(1000)})
    lines = read_members(spark, tmp_dir, task_bytes=100)
    assert lines.rdd.getNumPartitions() > 50
    assert lines.count() == 2000 and rejected_members(lines).count() == 0


def test_damaged_member_is_told_and_its_neighbours_are_read(spark, tmp_dir):
    path = f"{tmp_dir}/d.zip"
    body = "\n".join(f"line {k} {k * 7919 % 1000}" for k in range(5000))
    archive(path, {"good.csv": body, "bad.csv": body, "last.csv": body})
    spoil(path, "bad.csv")
    with open(f"{tmp_dir}/not.zip", "wb") as f:
        f.write(b"PK\x03\x04 no directory")
    lines = read_members(spark, tmp_dir)
    bad = {(os.path.basename(r["archive"]), r["member"]): r["error"] for r in rejected_members(lines).collect()}
    assert set(bad) == {("d.zip", "bad.csv"), ("not.zip", None)} and all(bad.values())
    told = {r["member"]: r["n"] for r in lines.where("error is null").groupBy("member").count().withColumnRenamed("count", "n").collect()}
    assert told == {"good.csv": 5000, "last.csv": 5000}


def test_folder_without_archives_is_empty(spark, tmp_dir):
    assert read_members(spark, tmp_dir).count() == 0
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w"):
        pass
    with open(f"{tmp_dir}/none.zip", "wb") as f:
        f.write(buf.getvalue())
    assert read_members(spark, tmp_dir).collect() == []
