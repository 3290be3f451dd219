import io
import os
import zipfile

from test_sources import HEADER, row, write

from postolake.operators import analytics as A
from postolake.plans.batch import run_lake


def test_run_lake_end_to_end(spark, tmp_dir):
    bronze, out = f"{tmp_dir}/bronze", f"{tmp_dir}/lake"
    write(f"{bronze}/dsan/2020/a.csv", HEADER + "\n" + row() + "\n" + row(city="Belém") + "\n")
    write(f"{bronze}/dsan/2021/b.csv", (HEADER + "\n" + row(city=" belém ") + "\n").encode("utf-8").decode("utf-8"),
          encoding="latin-1")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("c.csv", HEADER + "\n" + row(city="Recife") + "\n")
    os.makedirs(bronze, exist_ok=True)
    with open(f"{bronze}/c.zip", "wb") as f:
        f.write(buf.getvalue())
    with open(f"{bronze}/damaged.zip", "wb") as f:
        f.write(buf.getvalue()[:-25])
    result = run_lake(spark, bronze, out, sample="all")  # archives are read by default
    assert [os.path.basename(r["filename"]) for r in result.rejects.collect()] == ["damaged.zip"]
    assert {r["success"] for r in result.quality.collect()} == {True}
    rep = result.load_report.first()
    assert rep["silver_rows"] == 3 and rep["fact_rows"] == 3 and rep["unexplained_rows"] == 0
    assert set(result.seconds) == {"bronze", "quality", "silver", "gold", "report"}
    cities = {r["municipios"] for r in A.kpi_cities(result.gold).collect()}
    assert cities == {3}
    assert os.path.isdir(f"{out}/silver/combustiveis/ano=2020")
    assert os.path.isdir(f"{out}/gold/fact_precos_combustivel/ano=2020")


def test_quality_checks_first_file_only(spark, tmp_dir):
    bronze, out = f"{tmp_dir}/bronze", f"{tmp_dir}/lake"
    write(f"{bronze}/a.csv", HEADER + "\n" + row() + "\n")
    write(f"{bronze}/b.csv", HEADER + "\n" + row(city="Natal") + "\n" + row(city="Recife") + "\n")
    write(f"{bronze}/0/nested.csv", HEADER + "\n" + row(city="Natal") + "\n" * 3)  # not the sample: not at the top
    result = run_lake(spark, bronze, out, sample="first")
    counts = {r["element_count"] for r in result.quality.collect()}
    assert counts == {1}
    assert result.load_report.first()["silver_rows"] == 3


def test_first_file_checked_under_its_own_header(spark, tmp_dir):
    from postolake.constants import BRONZE_HEADERS
    from postolake.operators.quality import default_suite

    bronze, out = f"{tmp_dir}/bronze", f"{tmp_dir}/lake"
    headers = [h for h in BRONZE_HEADERS if h != "CNPJ da Revenda"] + ["Extra"]
    write(f"{bronze}/a.csv", ";".join(headers) + "\n" + row() + "\n")
    write(f"{bronze}/b.csv", HEADER + "\n" + row(city="Natal") + "\n")
    suite = default_suite(include_columns=True)
    result = run_lake(spark, bronze, out, sample="first", suite=suite)
    res = {r["ordinal"]: r for r in result.quality.collect()}
    assert res[6]["success"] is False  # CNPJ column missing from the first file
    assert res[8]["success"] is False  # ordered column list differs
    assert res[1]["success"] is True
