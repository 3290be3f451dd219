import io
import os
import zipfile

import pytest

from postolake.constants import BRONZE_HEADERS
from postolake.sources.archives import archive_members_to_bronze, expand_archives, rejected_archives
from postolake.sources.bronze_csv import bronze_rejects, detect_encodings, read_bronze, write_bronze_csv
from postolake.sources.bronze_lines import RejectedFilesError

HEADER = ";".join(BRONZE_HEADERS)


def row(city="São Paulo", **kw):
    vals = ["SE", "SP", city, "Posto", "12.345.678/0001-90", "Rua", "1", "", "Centro", "01310-100",
            "GASOLINA", "05/03/2020", "5,29", "4,10", "R$ / litro", "RAIZEN"]
    return ";".join(vals)


def write(path, text, encoding="utf-8", bom=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = text.encode(encoding)
    if bom:
        data = b"\xef\xbb\xbf" + data
    with open(path, "wb") as f:
        f.write(data)


def test_mixed_encodings_nested_bom(spark, tmp_dir):
    write(f"{tmp_dir}/a_utf8.csv", HEADER + "\n" + row() + "\n")
    write(f"{tmp_dir}/b_bom.csv", HEADER + "\n" + row() + "\n", bom=True)
    write(f"{tmp_dir}/sub/deeper/c_latin1.csv", HEADER + "\n" + row() + "\n", encoding="latin-1")
    write(f"{tmp_dir}/notes.txt", "ignored")
    enc = {os.path.basename(r["filename"]): r["encoding"] for r in detect_encodings(spark, tmp_dir).collect()}
    assert enc == {"a_utf8.csv": "UTF-8", "b_bom.csv": "UTF-8", "c_latin1.csv": "ISO-8859-1"}
    df = read_bronze(spark, tmp_dir)
    rows = df.collect()
    assert len(rows) == 3
    assert {r["Municipio"] for r in rows} == {"São Paulo"}
    assert {r["Regiao - Sigla"] for r in rows} == {"SE"}  # BOM not glued to the first field


def test_ragged_quoted_and_empty_fields(spark, tmp_dir):
    lines = [
        HEADER,
        "N;AM;Manaus",  # short row: padded with NULL
        row() + ";extra;fields",  # long row: first 16 kept
        '"S";"PR";"Curitiba ""Centro""";"";;x;1;;b;1;GNV;01/01/2020;1;2;R$ / m³;""',
    ]
    write(f"{tmp_dir}/r.csv", "\n".join(lines) + "\n")
    rows = {r["Municipio"]: r for r in read_bronze(spark, tmp_dir).collect()}
    short = rows["Manaus"]
    assert short["Revenda"] is None and short["Bandeira"] is None
    assert rows["São Paulo"]["Bandeira"] == "RAIZEN"
    quoted = rows['Curitiba "Centro"']
    assert quoted["Revenda"] is None and quoted["CNPJ da Revenda"] is None  # "" and empty -> NULL
    assert quoted["Bandeira"] is None
    dropped = read_bronze(spark, tmp_dir, drop_long_rows=True).count()
    assert dropped == 2


def test_empty_file_and_no_csv(spark, tmp_dir):
    write(f"{tmp_dir}/empty.csv", "")
    write(f"{tmp_dir}/ok.csv", HEADER + "\n" + row() + "\n")
    assert read_bronze(spark, tmp_dir).count() == 1
    other = tmp_dir + "/nocsv"
    write(f"{other}/readme.txt", "x")
    with pytest.raises(Exception):
        read_bronze(spark, other).count()


def test_zip_two_members_and_broken_zip(spark, tmp_dir):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("m1.csv", HEADER + "\n" + row() + "\n")
        zf.writestr("dir/m2.csv", (HEADER + "\n" + row(city="Belém") + "\n" + row() + "\n").encode("latin-1"))
    with open(f"{tmp_dir}/good.zip", "wb") as f:
        f.write(buf.getvalue())
    with open(f"{tmp_dir}/bad.zip", "wb") as f:
        f.write(b"PK\x03\x04 not really a zip")
    lines = expand_archives(spark, tmp_dir)
    assert lines.where("error is null").count() == 5  # 2 headers + 3 rows, nothing from the broken archive
    bad = rejected_archives(lines).collect()
    assert len(bad) == 1 and bad[0]["archive"].endswith("bad.zip") and "BadZipFile" in bad[0]["error"]
    bronze = archive_members_to_bronze(lines)
    rows = bronze.collect()
    assert len(rows) == 3
    assert sorted(r["Municipio"] for r in rows) == ["Belém", "São Paulo", "São Paulo"]
    assert all(r["filename"].endswith(("m1.csv", "m2.csv")) for r in rows)


def test_quoted_line_break_with_multiline(spark, tmp_dir):
    text = HEADER + "\n" + row().replace("Posto", '"Posto\nCentral"') + "\n" + row(city="Natal") + "\n"
    write(f"{tmp_dir}/m.csv", text)
    rows = read_bronze(spark, tmp_dir, multiline=True).collect()
    assert len(rows) == 2
    assert {r["Revenda"] for r in rows} == {"Posto\nCentral", "Posto"}


def test_known_charset_skips_detection(spark, tmp_dir):
    write(f"{tmp_dir}/l.csv", HEADER + "\n" + row() + "\n", encoding="latin-1")
    rows = read_bronze(spark, tmp_dir, encoding="ISO-8859-1").collect()
    assert [r["Municipio"] for r in rows] == ["São Paulo"]


def test_columns_taken_by_header_name(spark, tmp_dir):
    swapped = list(BRONZE_HEADERS)
    i, j = swapped.index("Municipio"), swapped.index("Bairro")
    swapped[i], swapped[j] = swapped[j], swapped[i]
    fields = row().split(";")
    fields[i], fields[j] = fields[j], fields[i]
    write(f"{tmp_dir}/std.csv", HEADER + "\n" + row() + "\n")
    write(f"{tmp_dir}/sub/swapped.csv", ";".join(swapped) + "\n" + ";".join(fields) + "\n", encoding="latin-1")
    write(f"{tmp_dir}/short_header.csv", ";".join(BRONZE_HEADERS[:3]) + "\nS;PR;Curitiba\n")
    rows = read_bronze(spark, tmp_dir).collect()
    assert sorted(r["Municipio"] for r in rows) == ["Curitiba", "São Paulo", "São Paulo"]
    assert sorted(r["Bairro"] or "-" for r in rows) == ["-", "Centro", "Centro"]
    by_file = {r["filename"].split("/")[-1]: r for r in rows}
    assert by_file["short_header.csv"]["Produto"] is None


def test_header_with_trailing_separator_and_blank_names(spark, tmp_dir):
    header = ";".join(BRONZE_HEADERS[:2]) + ";;Municipio;Municipio;"
    write(f"{tmp_dir}/odd.csv", header + "\nS;PR;x;Curitiba;dup;\n")
    rows = read_bronze(spark, tmp_dir).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["Regiao - Sigla"], r["Estado - Sigla"], r["Municipio"], r["Produto"]) == ("S", "PR", "Curitiba", None)


def test_line_parser_matches_file_reader(spark, tmp_dir):
    from postolake.sources.bronze_lines import parse_lines, positioned_lines

    write(f"{tmp_dir}/a.csv", HEADER + "\n" + row() + "\n" + row(city="Belém") + "\n", bom=True)
    swapped = list(BRONZE_HEADERS)
    swapped[2], swapped[8] = swapped[8], swapped[2]
    fields = row(city="Recife").split(";")
    fields[2], fields[8] = fields[8], fields[2]
    write(f"{tmp_dir}/x/b.csv", ";".join(swapped) + "\n" + ";".join(fields) + "\n\n", encoding="latin-1")
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(tmp_dir)
    got = parse_lines(positioned_lines(text))
    ref = read_bronze(spark, tmp_dir)
    cols = list(BRONZE_HEADERS) + ["filename"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, ref.select(*cols).collect()))


def test_file_names_with_special_characters(spark, tmp_dir):
    names = ["precos semestrais.csv", "a[1].csv", "100%.csv", "x{y}.csv", "a+b.csv", "c%20d.csv"]
    for k, name in enumerate(names):
        write(f"{tmp_dir}/{name}", HEADER + "\n" + row(city=f"c{k}") + "\n", encoding="latin-1" if k % 2 else "utf-8")
    rows = read_bronze(spark, tmp_dir).collect()
    assert {os.path.basename(r["filename"]): r["Municipio"] for r in rows} == {n: f"c{k}" for k, n in enumerate(names)}


def test_blank_lines_before_the_header(spark, tmp_dir):
    write(f"{tmp_dir}/blank.csv", "\n;;;\n  \n" + HEADER + "\n" + row(city="Olinda") + "\n")
    write(f"{tmp_dir}/plain.csv", HEADER + "\n" + row(city="Natal") + "\n")
    assert sorted(r["Municipio"] for r in read_bronze(spark, tmp_dir).collect()) == ["Natal", "Olinda"]


def test_file_without_the_expected_header_is_loud(spark, tmp_dir):
    write(f"{tmp_dir}/nohead.csv", "\n".join(row(city=f"c{k}") for k in range(3)) + "\n")
    write(f"{tmp_dir}/ok.csv", HEADER + "\n" + row() + "\n")
    with pytest.raises(RejectedFilesError, match="nohead.csv .3 lines"):
        read_bronze(spark, tmp_dir)
    assert read_bronze(spark, tmp_dir, rejects="skip").count() == 1
    refused = bronze_rejects(spark, tmp_dir).collect()
    assert [(os.path.basename(r["filename"]), r["lines"]) for r in refused] == [("nohead.csv", 3)]


def test_column_far_to_the_right_and_long_rows(spark, tmp_dir):
    wide = ";".join([f"x{k}" for k in range(90)] + list(BRONZE_HEADERS))
    write(f"{tmp_dir}/wide.csv", wide + "\n" + ";".join(["-"] * 90) + ";" + row(city="Belém") + "\n")
    swapped = ";".join(reversed(BRONZE_HEADERS))
    write(f"{tmp_dir}/swapped.csv", swapped + "\n" + ";".join(reversed(row(city="Natal").split(";"))) + ";more\n")
    assert sorted(r["Municipio"] for r in read_bronze(spark, tmp_dir).collect()) == ["Belém", "Natal"]
    assert [r["Municipio"] for r in read_bronze(spark, tmp_dir, drop_long_rows=True).collect()] == ["Belém"]


def test_unknown_charset_is_an_error(spark, tmp_dir):
    from pyspark.sql import functions as F

    write(f"{tmp_dir}/in/a.csv", HEADER + "\n" + row() + "\n")
    bronze = read_bronze(spark, f"{tmp_dir}/in").withColumn("filename", F.lit("a"))
    for charset in (F.lit("CP1252"), F.lit(None).cast("string")):
        with pytest.raises(Exception, match="unknown charset"):
            write_bronze_csv(bronze, f"{tmp_dir}/out", encoding_by_file=charset)


def _zip_bytes(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, text in members.items():
            zf.writestr(name, text)
    return buf.getvalue()


def test_archives_by_header_name_and_whole_or_not_at_all(spark, tmp_dir):
    swapped = list(BRONZE_HEADERS)
    swapped[2], swapped[8] = swapped[8], swapped[2]
    fields = row(city="Recife").split(";")
    fields[2], fields[8] = fields[8], fields[2]
    good = _zip_bytes({"s w.csv": ";".join(swapped) + "\n" + ";".join(fields) + "\n", "a%2.csv": HEADER + "\n" + row(city="Natal")})
    many = _zip_bytes({"big.csv": (HEADER + "\n" + (row() + "\n") * 60_000).encode("latin-1")})
    at = many.index(b"big.csv") + 5000
    os.makedirs(tmp_dir, exist_ok=True)
    for name, data in {"good.zip": good, "flipped.zip": many[:at] + bytes([many[at] ^ 255]) + many[at + 1 :], "cut.zip": good[:-30]}.items():
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(data)
    expanded = expand_archives(spark, tmp_dir).cache()
    assert sorted(os.path.basename(r["archive"]) for r in rejected_archives(expanded).collect()) == ["cut.zip", "flipped.zip"]
    rows = archive_members_to_bronze(expanded).collect()
    assert {r["filename"].rsplit("!", 1)[1]: r["Municipio"] for r in rows} == {"s w.csv": "Recife", "a%2.csv": "Natal"}
    expanded.unpersist()


def test_zip_frame_bounds_its_archives_and_damages_a_set(spark):
    from pyspark.sql import functions as F

    from postolake.plans.files import ARCHIVE_ROWS, dealt, zip_frame, zip_set
    from postolake.sources.archives import expand_content

    n = 5 * ARCHIVE_ROWS
    bronze = spark.range(0, n, 1, 1).select(
        *[F.col("id").cast("string").alias(h) if h == "Cep" else F.lit("x").alias(h) for h in BRONZE_HEADERS]
    )
    damaged = bronze.where(dealt(4) == 3).count()
    expanded = expand_content(zip_frame(bronze, 4)).cache()
    lines = {r["archive"]: r["n"] for r in expanded.where("line_no > 0").groupBy("archive").agg(F.count("*").alias("n")).collect()}
    assert max(lines.values()) <= ARCHIVE_ROWS and len(lines) == 6
    assert [r["s"] for r in rejected_archives(expanded).select(zip_set("archive").alias("s")).distinct().collect()] == ["z3.zip"]
    assert archive_members_to_bronze(expanded).count() == n - damaged and damaged > n // 5


def test_archive_lines_come_in_arrow_batches_numbered_through():
    import pyarrow as pa

    from postolake.sources import archives

    n = archives._BATCH + 7
    data = _zip_bytes({"a.csv": "h\r\n" + "é\n" * (n - 2) + "last", "none.csv": ""})
    zips = pa.RecordBatch.from_pydict({"path": ["x.zip", "bad.zip"], "content": [data, data[:-30]]})
    got = list(archives._expand(iter([zips])))
    assert [len(b) for b in got] == [archives._BATCH, 7, 1]
    rows = pa.Table.from_batches(got).to_pylist()
    assert [r["line_no"] for r in rows[:n]] == list(range(n)) and rows[0]["line"] == "h" and rows[n - 1]["line"] == "last"
    assert {(r["archive"], r["member"], r["error"]) for r in rows[:n]} == {("x.zip", "a.csv", None)}
    assert rows[n]["archive"] == "bad.zip" and rows[n]["line"] is rows[n]["line_no"] is None and "BadZipFile" in rows[n]["error"]
