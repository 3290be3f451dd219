import datetime as dt

from conftest import bronze_rows

from postolake.operators.silver import build_silver, dedup_counts

BASE = {
    "regiao_sigla": "SE", "estado_sigla": "SP", "municipio": "São Paulo", "revenda": "Posto A",
    "cnpj_revenda": "12.345.678/0001-90", "nome_rua": "Rua X", "numero_rua": "10", "complemento": None,
    "bairro": "Centro", "cep": "01310-100", "produto": "GASOLINA", "data_coleta": "05/03/2020",
    "valor_venda": "5,29", "valor_compra": "4,10", "unidade_medida": "R$ / litro", "bandeira": "RAIZEN",
}


def test_duplicates_collapse_to_lowest_filename(spark):
    rows = [
        dict(BASE, filename="b.csv"),
        dict(BASE, municipio="  são paulo ", estado_sigla="sp", filename="a.csv"),  # other case/padding
        dict(BASE, data_coleta="2020-03-05", filename="c.csv"),  # other date format
        dict(BASE, complemento="   ", filename="0.csv"),  # '' vs NULL: same key
    ]
    out = build_silver(bronze_rows(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert r["filename"] == "0.csv"
    assert r["municipio"] == "SÃO PAULO" and r["cnpj_revenda"] == "12345678000190"
    assert r["data_coleta"] == dt.date(2020, 3, 5) and r["ano"] == 2020 and r["mes"] == 3
    assert r["valor_venda"] == 5.29 and r["complemento"] == ""


def test_survivor_prefers_null_over_empty_in_same_file(spark):
    rows = [dict(BASE, complemento="  "), dict(BASE, complemento=None)]
    out = build_silver(bronze_rows(spark, rows)).collect()
    assert len(out) == 1 and out[0]["complemento"] is None


def test_blank_rows_dropped(spark):
    blank = {k: None for k in BASE}
    spaces = {k: "   " for k in BASE}
    rows = [BASE, blank, spaces, dict(blank, filename="z.csv")]
    df = bronze_rows(spark, rows)
    out = build_silver(df).collect()
    assert len(out) == 1
    c = dedup_counts(df).first()
    assert (c["input_rows"], c["blank_rows"], c["duplicate_rows"], c["silver_rows"]) == (4, 3, 0, 1)


def test_distinct_rows_kept_and_bad_values_null(spark):
    rows = [
        BASE,
        dict(BASE, valor_venda="n/d", data_coleta="31/02/2020"),
        dict(BASE, valor_venda="1.234,56", valor_compra=None),
    ]
    out = {(r["valor_venda"], r["data_coleta"]) for r in build_silver(bronze_rows(spark, rows)).collect()}
    assert out == {(5.29, dt.date(2020, 3, 5)), (None, None), (1234.56, dt.date(2020, 3, 5))}


def test_silver_schema(spark):
    s = build_silver(bronze_rows(spark, [BASE]))
    types = dict(s.dtypes)
    assert s.columns[:2] == ["filename", "row_hash"]
    assert types["data_coleta"] == "date" and types["valor_venda"] == "double"
    assert types["ano"] == "int" and types["mes"] == "int"


def test_optional_text_repair(spark):
    rows = [dict(BASE, municipio="SÃ£o Paulo")]
    plain = build_silver(bronze_rows(spark, rows)).first()["municipio"]
    fixed = build_silver(bronze_rows(spark, rows), repair_text=True).first()["municipio"]
    assert plain == "SÃ£O PAULO" and fixed == "SÃO PAULO"


def test_hot_key_collapses_to_one_survivor(spark):
    hot = [dict(BASE, municipio=" são paulo " if i % 2 else "SÃO PAULO", filename=f"f{i % 50:02d}.csv")
           for i in range(3000)]
    others = [dict(BASE, valor_venda=f"{i},00", filename="z.csv") for i in range(10, 6010)]
    df = bronze_rows(spark, hot + others).repartition(16)
    out = build_silver(df)
    assert out.count() == 1 + 6000
    hot_rows = out.filter("valor_venda = 5.29").collect()
    assert len(hot_rows) == 1 and hot_rows[0]["filename"] == "f00.csv"
