import datetime as dt

from conftest import bronze_rows
from test_silver import BASE

from postolake.operators import analytics as A
from postolake.operators.checks import key_checks, load_report
from postolake.operators.gold import build_gold, gold_input
from postolake.operators.scd2 import build_fact_asof, station_history
from postolake.operators.silver import build_silver


def lake(spark, rows):
    silver = build_silver(bronze_rows(spark, rows)).checkpoint(eager=True)
    return silver, build_gold(silver)


def station(date, brand, price="5,00", **kw):
    return dict(BASE, data_coleta=date, bandeira=brand, valor_venda=price, **kw)


def test_dimensions_ids_and_fact(spark):
    rows = [
        station("01/01/2020", "A"),
        station("02/01/2020", "B"),  # same CNPJ, second brand -> second station version
        dict(BASE, produto="ETANOL", data_coleta="03/01/2020"),
        dict(BASE, municipio=None, data_coleta="04/01/2020"),  # NULL key: leaves the fact
        dict(BASE, data_coleta="", valor_venda="6,00"),  # NULL date: leaves the fact
    ]
    silver, gold = lake(spark, rows)
    assert [r["data_id"] for r in gold.dim_data.orderBy("data").collect()] == [1, 2, 3, 4]
    assert gold.dim_data.filter("data = date'2020-01-03'").first()["trimestre"] == 1
    postos = gold.dim_posto.orderBy("posto_id").collect()
    assert [p["bandeira"] for p in postos] == ["A", "B", "RAIZEN"]
    assert all(p["ativo"] and p["data_inicio"] is None for p in postos)
    assert gold.posto_lookup.collect()[0]["posto_id"] == 1  # lowest id per CNPJ
    fact = gold.fact.collect()
    assert len(fact) == 3 and sorted(r["fato_id"] for r in fact) == [1, 2, 3]
    assert {r["posto_id"] for r in fact} == {1}
    rep = load_report(gold_input(silver), gold.fact).first()
    lost = load_report(gold_input(silver), gold.fact.where("fato_id > 1")).first()
    assert (rep["unexplained_rows"], lost["fact_rows"], lost["unexplained_rows"]) == (0, 2, 1)
    assert (rep["silver_rows"], rep["fact_rows"], rep["missing_data"], rep["missing_localidade"]) == (5, 3, 1, 1)
    assert all(r["violations"] == 0 for r in key_checks(gold).collect())


def test_scd2_a_b_a(spark):
    rows = [
        station("01/01/2020", "A"), station("05/01/2020", "A"),
        station("10/01/2020", "B"), station("20/01/2020", "A"),
    ]
    silver, gold = lake(spark, rows)
    hist = station_history(gold_input(silver)).orderBy("posto_id").collect()
    assert [(h["bandeira"], h["data_inicio"], h["data_fim"], h["ativo"]) for h in hist] == [
        ("A", dt.date(2020, 1, 1), dt.date(2020, 1, 9), False),
        ("B", dt.date(2020, 1, 10), dt.date(2020, 1, 19), False),
        ("A", dt.date(2020, 1, 20), None, True),
    ]
    g = gold_input(silver)
    asof = build_fact_asof(g, gold.dim_data, gold.dim_produto, gold.dim_localidade,
                           station_history(g)).join(gold.dim_data, "data_id")
    by_day = {r["data"]: r["posto_id"] for r in asof.collect()}
    assert by_day == {dt.date(2020, 1, 1): 1, dt.date(2020, 1, 5): 1, dt.date(2020, 1, 10): 2, dt.date(2020, 1, 20): 3}


def test_scd2_two_brands_on_one_day(spark):
    rows = [
        station("01/01/2020", "A"), station("02/01/2020", "B"), station("02/01/2020", "A"),
        station("03/01/2020", "B"), station("03/01/2020", None),
    ]
    silver, gold = lake(spark, rows)
    g = gold_input(silver)
    hist = station_history(g).orderBy("versao").collect()
    assert [(h["bandeira"], h["data_inicio"], h["data_fim"]) for h in hist] == [
        ("A", dt.date(2020, 1, 1), dt.date(2020, 1, 2)),
        (None, dt.date(2020, 1, 3), None),
    ]
    asof = build_fact_asof(g, gold.dim_data, gold.dim_produto, gold.dim_localidade, station_history(g))
    assert asof.count() == 5


def test_brand_groups_and_ties(spark):
    rows = [
        station("01/01/2020", None, cnpj_revenda="1"),
        station("01/01/2020", "  ", cnpj_revenda="2"),
        station("01/01/2020", "BRANCA", cnpj_revenda="3"),
        station("02/01/2020", "BRANCA", cnpj_revenda="3"),
        station("01/01/2020", "X", cnpj_revenda="4"),
    ]
    _, gold = lake(spark, rows)
    share = A.dash_brand_share(gold).collect()
    # '' becomes NULL on load, so NULL and 'BRANCA' stay two groups with one label
    assert [(r["bandeira"], r["total_coletas"]) for r in share] == [("BRANCA", 2), ("BRANCA", 2), ("X", 1)]
    top1 = A.dash_brand_share(gold, k=1).collect()
    assert [(r["bandeira"], r["total_coletas"]) for r in top1] == [("BRANCA", 2)]
    dist = A.bi_brand_distribution(gold).collect()
    assert [r["percentual"] for r in dist] == [40.0, 40.0, 20.0]


def test_average_null_group_and_margin(spark):
    rows = [
        dict(BASE, produto="GNV", valor_venda="n/d", valor_compra=None, unidade_medida="R$ / m³"),
        dict(BASE, valor_venda="5,00", valor_compra="4,00"),
        dict(BASE, valor_venda="6,00", valor_compra="4,50", data_coleta="06/03/2020"),
    ]
    _, gold = lake(spark, rows)
    d2 = {r["produto"]: r["preco_medio"] for r in A.dash_price_by_product(gold).collect()}
    assert d2 == {"GASOLINA": 5.5}  # GNV has no positive price
    b1 = {r["produto"]: r["preco_medio_venda"] for r in A.bi_monthly_prices(gold).collect()}
    assert b1 == {"GASOLINA": 5.5, "GNV": None}  # group whose average is NULL
    d7 = A.dash_product_summary(gold).first()
    assert (d7["margem_media"], d7["total_registros"]) == (1.25, 2)


def test_dashboard_default_range():
    assert A.dashboard_range(1, dt.date(2024, 2, 29)) == (dt.date(2023, 2, 28), dt.date(2024, 2, 29))
    assert A.dashboard_range(20, dt.date(2024, 2, 29)) == (dt.date(2004, 2, 29), dt.date(2024, 2, 29))
    assert A.dashboard_range(1, dt.date(2026, 12, 2)) == (dt.date(2025, 12, 2), dt.date(2026, 12, 2))


def test_gold_reload_replaces_all_years_silver_keeps_others(spark, tmp_dir):
    import os

    from postolake.sinks.parquet import read_gold, write_gold, write_silver

    first = build_silver(bronze_rows(spark, [station("01/01/2019", "A"), station("01/01/2020", "A")]))
    write_silver(first, f"{tmp_dir}/silver")
    write_gold(build_gold(first.checkpoint(eager=True), keep_year=True), f"{tmp_dir}/gold")
    second = build_silver(bronze_rows(spark, [station("02/01/2020", "B")])).checkpoint(eager=True)
    write_silver(second, f"{tmp_dir}/silver")
    write_gold(build_gold(second, keep_year=True), f"{tmp_dir}/gold")
    assert os.path.isdir(f"{tmp_dir}/silver/ano=2019")  # silver: other years kept
    assert not os.path.isdir(f"{tmp_dir}/gold/fact_precos_combustivel/ano=2019")  # gold: full reload
    assert read_gold(spark, f"{tmp_dir}/gold").fact.count() == 1
