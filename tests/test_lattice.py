import dataclasses
import os

import pytest
from conftest import bronze_rows
from pyspark.sql import functions as F
from test_silver import BASE

from postolake.operators import analytics as A
from postolake.operators import lattice as L
from postolake.operators.gold import build_gold
from postolake.operators.silver import build_silver

PAIRS = [
    (A.dash_monthly_price, L.dash_monthly_price),
    (A.dash_price_by_product, L.dash_price_by_product),
    (A.dash_rows_per_year, L.dash_rows_per_year),
    (A.dash_margin_by_region, L.dash_margin_by_region),
    (A.dash_brand_share, L.dash_brand_share),
    (A.dash_quarterly_price, L.dash_quarterly_price),
    (A.dash_product_summary, L.dash_product_summary),
    (A.kpi_total_rows, L.kpi_total_rows),
    (A.kpi_products, L.kpi_products),
    (A.kpi_cities, L.kpi_cities),
    (A.kpi_stations, L.kpi_stations),
    (A.bi_monthly_prices, L.bi_monthly_prices),
    (A.bi_price_by_state, L.bi_price_by_state),
    (lambda g: A.bi_top_cities(g, "GASOLINA", 2, 4), lambda x: L.bi_top_cities(x, "GASOLINA", 2, 4)),
    (A.bi_margin_by_region, L.bi_margin_by_region),
    (A.bi_brand_distribution, L.bi_brand_distribution),
    (A.bi_quarterly_price, L.bi_quarterly_price),
]


@pytest.fixture(scope="module")
def gold(spark):
    prices = ["5,29", "0", "-1,5", None, "inf", "4,995", "5,001"]
    rows = [
        dict(
            BASE,
            data_coleta=f"{1 + k % 28:02d}/{1 + k % 12:02d}/{2018 + k % 3}",
            produto=["GASOLINA", "ETANOL", "DIESEL"][k % 3],
            valor_venda=prices[k % 7],
            valor_compra=prices[(k // 7) % 7],
            municipio=f"cidade {k % 5}",
            bandeira=[None, "X", "BRANCA"][k % 4 % 3],
            cnpj_revenda=f"{k % 4}",
        )
        for k in range(200)
    ]
    gold = build_gold(build_silver(bronze_rows(spark, rows)).checkpoint())
    return dataclasses.replace(gold, fact=gold.fact.checkpoint())


def _part(gold, condition):
    return dataclasses.replace(gold, fact=gold.fact.where(condition))


def _equal(gold, lattice, pairs=PAIRS):
    for plain, rolled in pairs:
        assert rolled(lattice).columns == plain(gold).columns
        assert rolled(lattice).collect() == plain(gold).collect(), plain


def _files(frame):
    return {f.split(":", 1)[1] for f in frame.inputFiles()}


def test_panels_from_loads_and_after_compaction(spark, gold, tmp_dir):
    x = L.Lattice(spark, f"{tmp_dir}/lattice")
    with pytest.raises(ValueError):
        x.level("cell")
    for condition in ("fato_id % 3 = 0", "fato_id % 3 = 1", "false", "fato_id % 3 = 2"):
        x.add(_part(gold, condition))
    assert x.loads() == [(1, 1), (2, 2), (3, 3), (4, 4)]
    _equal(gold, x)
    x.compact()
    assert x.loads() == [(1, 4)]
    _equal(gold, x, PAIRS[:4])
    x.compact()
    assert sorted(n for n in os.listdir(f"{tmp_dir}/lattice") if n.startswith("loads=")) == ["loads=000000001-000000004"]
    x.add(_part(gold, "fato_id = 1"))
    assert x.loads() == [(1, 4), (5, 5)]
    assert L.kpi_total_rows(x).first()[0] == gold.fact.count() + 1
    assert all("/lattice/loads=" in f for f in _files(L.bi_top_cities(x)))


def test_distinct_cities_of_any_range(spark, gold, tmp_dir):
    x = L.Lattice(spark, f"{tmp_dir}/lattice")
    x.add(_part(gold, "fato_id % 2 = 0"))
    x.add(_part(gold, "fato_id % 2 = 1"))
    seen = gold.fact.join(gold.dim_data, "data_id").join(gold.dim_localidade, "localidade_id")
    for start, end in (("2018-02-01", "2018-02-28"), ("2018-03-01", "2019-06-30"), (None, None), ("1990-01-01", "1990-12-31")):
        rows = seen.where(A._between(F.col("data"), start, end))
        assert x.distinct_cities(start, end).first()[0] == rows.select("municipio").distinct().count()
    by_month = {r[0]: r[1] for r in x.cities_by(F.date_trunc("month", "data").cast("date")).collect()}
    month = F.date_trunc("month", "data").cast("date")
    assert by_month == {r[0]: r[1] for r in seen.groupBy(month).agg(F.count_distinct("municipio")).collect()}


def test_smallest_level_answers(spark, gold, tmp_dir):
    x = L.Lattice(spark, f"{tmp_dir}/lattice")
    x.add(gold)
    assert x.route(["ano", "produto"]) == "month" and x.route(["bandeira"]) == "brand"
    assert x.route(["municipio", "produto"]) == "place" and x.route(["ano", "municipio"]) == "cell"
    assert x.route(["bandeira", "ano"]) == "cell"
    with pytest.raises(ValueError):
        x.route(["cep"])
    prices = x.level("brand").agg(F.min("min_venda"), F.max("max_venda")).first()
    assert tuple(prices) == tuple(gold.fact.agg(F.min("valor_venda"), F.max("valor_venda")).first())
