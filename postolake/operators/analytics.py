"""Dashboard panels (D1-D11), analytic questions (B1-B7) and panel reductions.

Every query is fact -> broadcast dimension joins -> partial/final hash
aggregate: the fact is scanned once with only the columns it needs and never
shuffled; the only exchange carries one row per group per task. Filters on
dimensions are applied to the dimension before the join; when the fact is
stored partitioned by year the time-range queries also prune partitions.

Averages are exact means rounded half away from zero (``exact_mean``), so the
result does not depend on the order rows are summed in. PostgreSQL NULL
ordering is kept: ascending puts NULLs last, descending puts them first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postolake.constants import UNBRANDED_LABEL
from postolake.functions import exact_mean, exact_percent, label_or_default, month_start, quarter_start
from postolake.operators.gold import Gold

DateLike = str | dt.date | None


def dashboard_range(years: int = 20, today: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """The dashboards' default time window: now - ``years`` .. now."""
    end = today or dt.date.today()
    try:
        start = end.replace(year=end.year - years)
    except ValueError:  # 29 February
        start = end.replace(year=end.year - years, day=28)
    return start, end


def _date(value: DateLike) -> Column | None:
    if value is None:
        return None
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def _between(c: Column, date_from: DateLike, date_to: DateLike) -> Column:
    cond = F.lit(True)
    if date_from is not None:
        cond = cond & (c >= _date(date_from))
    if date_to is not None:
        cond = cond & (c <= _date(date_to))
    return cond


def _facts(gold: Gold, date_from: DateLike = None, date_to: DateLike = None) -> DataFrame:
    """The fact table, year-pruned when it is stored partitioned by ``ano``.

    The partition column is dropped after pruning so it never clashes with
    ``dim_data.ano``; the date filter itself is applied on ``dim_data``.
    """
    fact = gold.fact
    if "ano" not in fact.columns:
        return fact
    if date_from is not None:
        fact = fact.filter(F.col("ano") >= _year(date_from))
    if date_to is not None:
        fact = fact.filter(F.col("ano") <= _year(date_to))
    return fact.drop("ano")


def _year(value: DateLike) -> int:
    return (value if isinstance(value, dt.date) else dt.date.fromisoformat(value)).year


# ---------------------------------------------------------------- dashboard

def dash_monthly_price(gold: Gold, date_from: DateLike = None, date_to: DateLike = None) -> DataFrame:
    """Monthly average sale price per product (time, metric, value)."""
    days = gold.dim_data.filter(_between(month_start("ano", "mes"), date_from, date_to))
    fact = _facts(gold, date_from, date_to)
    joined = fact.join(gold.dim("dim_data", days.select("data_id", "ano", "mes")), "data_id").join(
        gold.dim("dim_produto", gold.dim_produto.select("produto_id", "produto")), "produto_id"
    )
    agg = joined.groupBy("ano", "mes", "produto").agg(exact_mean("valor_venda").alias("value"))
    return agg.select(
        month_start("ano", "mes").alias("time"), F.col("produto").alias("metric"), "value"
    ).orderBy(F.col("time").asc_nulls_last(), F.col("metric").asc_nulls_last())


def dash_price_by_product(gold: Gold) -> DataFrame:
    """Average sale price by product, positive prices only."""
    joined = _facts(gold).filter(F.col("valor_venda") > 0).join(
        gold.dim("dim_produto", gold.dim_produto.select("produto_id", "produto")), "produto_id"
    )
    agg = joined.groupBy("produto").agg(exact_mean("valor_venda").alias("preco_medio"))
    return agg.orderBy(F.col("preco_medio").desc_nulls_first(), F.col("produto").asc_nulls_last())


def dash_rows_per_year(gold: Gold) -> DataFrame:
    """D3: collected rows per year, year as text."""
    joined = _facts(gold).select("data_id").join(gold.dim("dim_data", gold.dim_data.select("data_id", "ano")), "data_id")
    agg = joined.groupBy("ano").agg(F.count(F.lit(1)).alias("coletas"))
    return agg.orderBy(F.col("ano").asc_nulls_last()).select(
        F.col("ano").cast("string").alias("ano"), "coletas"
    )


def dash_margin_by_region(gold: Gold) -> DataFrame:
    """Average margin (sale - purchase) by region and product."""
    fact = _facts(gold).filter(F.col("valor_compra").isNotNull() & F.col("valor_venda").isNotNull())
    joined = fact.join(gold.dim("dim_localidade", gold.dim_localidade.select("localidade_id", "regiao_sigla")), "localidade_id").join(
        gold.dim("dim_produto", gold.dim_produto.select("produto_id", "produto")), "produto_id"
    )
    agg = joined.groupBy("regiao_sigla", "produto").agg(
        exact_mean(F.col("valor_venda") - F.col("valor_compra")).alias("margem_media")
    )
    return agg.orderBy(F.col("regiao_sigla").asc_nulls_last(), F.col("produto").asc_nulls_last())


def _brand_counts(gold: Gold) -> DataFrame:
    """Rows per raw brand value (NULL, '' and 'BRANCA' stay separate groups)."""
    joined = _facts(gold).select("posto_id").join(gold.dim("dim_posto", gold.dim_posto.select("posto_id", "bandeira")), "posto_id")
    return joined.groupBy("bandeira").agg(F.count(F.lit(1)).alias("total_coletas"))


def _top_brands(counts: DataFrame, k: int) -> DataFrame:
    return counts.orderBy(
        F.col("total_coletas").desc_nulls_first(), F.col("bandeira").asc_nulls_first()
    ).limit(k)


def dash_brand_share(gold: Gold, k: int = 15) -> DataFrame:
    """Rows per brand label, top k."""
    top = _top_brands(_brand_counts(gold), k)
    return top.select(label_or_default("bandeira", UNBRANDED_LABEL).alias("bandeira"), "total_coletas")


def dash_quarterly_price(
    gold: Gold,
    products: tuple[str, ...] = ("GASOLINA", "ETANOL"),
    date_from: DateLike = None,
    date_to: DateLike = None,
) -> DataFrame:
    """Quarterly average sale price of the given products, time range."""
    days = gold.dim_data.filter(_between(quarter_start("ano", "trimestre"), date_from, date_to))
    prods = gold.dim_produto.filter(F.col("produto").isin(list(products)))
    fact = _facts(gold, date_from, date_to)
    joined = fact.join(gold.dim("dim_data", days.select("data_id", "ano", "trimestre")), "data_id").join(
        gold.dim("dim_produto", prods.select("produto_id", "produto")), "produto_id"
    )
    agg = joined.groupBy("ano", "trimestre", "produto").agg(exact_mean("valor_venda").alias("value"))
    return agg.select(
        quarter_start("ano", "trimestre").alias("time"), F.col("produto").alias("metric"), "value"
    ).orderBy(F.col("time").asc_nulls_last(), F.col("metric").asc_nulls_last())


def dash_product_summary(gold: Gold) -> DataFrame:
    """Purchase, sale, margin and row count per product."""
    fact = _facts(gold).filter(
        F.col("valor_compra").isNotNull() & F.col("valor_venda").isNotNull()
        & (F.col("valor_compra") > 0) & (F.col("valor_venda") > 0)
    )
    joined = fact.join(gold.dim("dim_produto", gold.dim_produto.select("produto_id", "produto")), "produto_id")
    agg = joined.groupBy("produto").agg(
        exact_mean("valor_compra").alias("preco_medio_compra"),
        exact_mean("valor_venda").alias("preco_medio_venda"),
        exact_mean(F.col("valor_venda") - F.col("valor_compra")).alias("margem_media"),
        F.count(F.lit(1)).alias("total_registros"),
    )
    return agg.orderBy(F.col("margem_media").desc_nulls_first(), F.col("produto").asc_nulls_last())


def kpi_total_rows(gold: Gold) -> DataFrame:
    """Fact row count."""
    return _facts(gold).agg(F.count(F.lit(1)).alias("total"))


def kpi_products(gold: Gold) -> DataFrame:
    """Product dimension rows."""
    return gold.dim_produto.agg(F.count(F.lit(1)).alias("produtos"))


def kpi_cities(gold: Gold) -> DataFrame:
    """Distinct city names (not city + state)."""
    return gold.dim_localidade.agg(F.count_distinct("municipio").alias("municipios"))


def kpi_stations(gold: Gold) -> DataFrame:
    """Station dimension rows (attribute versions, not CNPJs)."""
    return gold.dim_posto.agg(F.count(F.lit(1)).alias("postos"))


# ------------------------------------------------------------ BI questions

def bi_monthly_prices(gold: Gold) -> DataFrame:
    """B1: monthly sale and purchase averages per product."""
    joined = _facts(gold).join(gold.dim("dim_data", gold.dim_data.select("data_id", "ano", "mes")), "data_id").join(
        gold.dim("dim_produto", gold.dim_produto.select("produto_id", "produto")), "produto_id"
    )
    agg = joined.groupBy("ano", "mes", "produto").agg(
        exact_mean("valor_venda").alias("preco_medio_venda"),
        exact_mean("valor_compra").alias("preco_medio_compra"),
    )
    return agg.orderBy(*[F.col(c).asc_nulls_last() for c in ("ano", "mes", "produto")])


def bi_price_by_state(gold: Gold) -> DataFrame:
    """B2: average sale price and row count by state and product."""
    joined = _facts(gold).join(
        gold.dim("dim_localidade", gold.dim_localidade.select("localidade_id", "estado_sigla")), "localidade_id"
    ).join(gold.dim("dim_produto", gold.dim_produto.select("produto_id", "produto")), "produto_id")
    agg = joined.groupBy("estado_sigla", "produto").agg(
        exact_mean("valor_venda").alias("preco_medio_venda"),
        F.count(F.lit(1)).alias("total_coletas"),
    )
    return agg.orderBy(F.col("estado_sigla").asc_nulls_last(), F.col("produto").asc_nulls_last())


def bi_top_cities(gold: Gold, product: str = "GASOLINA", min_rows: int = 100, k: int = 10) -> DataFrame:
    """The k dearest cities for a product, among cities with >= min_rows."""
    prods = gold.dim_produto.filter(F.col("produto") == product).select("produto_id")
    joined = _facts(gold).join(gold.dim("dim_produto", prods), "produto_id").join(
        gold.dim("dim_localidade", gold.dim_localidade.select("localidade_id", "municipio", "estado_sigla")), "localidade_id"
    )
    agg = joined.groupBy("municipio", "estado_sigla").agg(
        exact_mean("valor_venda").alias("preco_medio"),
        F.count(F.lit(1)).alias("total_coletas"),
    )
    return (
        agg.filter(F.col("total_coletas") >= min_rows)
        .orderBy(
            F.col("preco_medio").desc_nulls_first(),
            F.col("municipio").asc_nulls_last(),
            F.col("estado_sigla").asc_nulls_last(),
        )
        .limit(k)
    )


def bi_margin_by_region(gold: Gold) -> DataFrame:
    """Margin, sale and purchase averages by region and product."""
    fact = _facts(gold).filter(F.col("valor_compra").isNotNull() & F.col("valor_venda").isNotNull())
    joined = fact.join(gold.dim("dim_localidade", gold.dim_localidade.select("localidade_id", "regiao_sigla")), "localidade_id").join(
        gold.dim("dim_produto", gold.dim_produto.select("produto_id", "produto")), "produto_id"
    )
    agg = joined.groupBy("regiao_sigla", "produto").agg(
        exact_mean(F.col("valor_venda") - F.col("valor_compra")).alias("margem_media"),
        exact_mean("valor_venda").alias("preco_venda_medio"),
        exact_mean("valor_compra").alias("preco_compra_medio"),
    )
    return agg.orderBy(F.col("regiao_sigla").asc_nulls_last(), F.col("margem_media").desc_nulls_first())


def bi_brand_distribution(gold: Gold, k: int = 15) -> DataFrame:
    """Brand label, rows and percent of all rows (before the top-k cut)."""
    counts = _brand_counts(gold)
    # One row per brand: the window runs on the aggregated frame only.
    everyone = Window.partitionBy()
    with_pct = counts.withColumn(
        "percentual", exact_percent("total_coletas", F.sum("total_coletas").over(everyone))
    )
    top = with_pct.orderBy(
        F.col("total_coletas").desc_nulls_first(), F.col("bandeira").asc_nulls_first()
    ).limit(k)
    return top.select(
        label_or_default("bandeira", UNBRANDED_LABEL).alias("bandeira"), "total_coletas", "percentual"
    )


def bi_quarterly_price(gold: Gold, products: tuple[str, ...] = ("GASOLINA", "ETANOL")) -> DataFrame:
    """Quarterly average sale price of the given products."""
    prods = gold.dim_produto.filter(F.col("produto").isin(list(products)))
    joined = _facts(gold).join(gold.dim("dim_data", gold.dim_data.select("data_id", "ano", "trimestre")), "data_id").join(
        gold.dim("dim_produto", prods.select("produto_id", "produto")), "produto_id"
    )
    agg = joined.groupBy("ano", "trimestre", "produto").agg(exact_mean("valor_venda").alias("preco_medio"))
    return agg.orderBy(*[F.col(c).asc_nulls_last() for c in ("ano", "trimestre", "produto")])


def priced_facts(gold: Gold) -> DataFrame:
    """(produto, valor_compra, valor_venda) of the facts with two positive prices."""
    fact = _facts(gold).filter(
        F.col("valor_compra").isNotNull() & F.col("valor_venda").isNotNull()
        & (F.col("valor_compra") > 0) & (F.col("valor_venda") > 0)
    )
    joined = fact.join(gold.dim("dim_produto", gold.dim_produto.select("produto_id", "produto")), "produto_id")
    return joined.select("produto", "valor_compra", "valor_venda")


def bi_price_sample(gold: Gold, n: int = 5000, seed: int = 7) -> DataFrame:
    """Random sample of n (purchase, sale) pairs with positive prices.

    ORDER BY random LIMIT n runs as a per-task top-n then a final top-n
    (TakeOrderedAndProject); the fact is never sorted as a whole.
    """
    return priced_facts(gold).orderBy(F.rand(seed)).limit(n)


# ------------------------------------------------------- panel reductions

def legend_calcs(frame: DataFrame, series: str = "metric", value: str = "value") -> DataFrame:
    """Legend mean / max / min per series."""
    return frame.groupBy(series).agg(
        exact_mean(value).alias("mean"), F.max(value).alias("max"), F.min(value).alias("min")
    )


def last_not_null(
    frame: DataFrame, series: str = "metric", value: str = "value", time: str | None = "time", position: str | None = None
) -> DataFrame:
    """Last non-NULL value of each series.

    "Last" is by ``time``, or, for a frame without a time column, by the
    ``position`` column that holds the row's place (``time=None``).
    """
    by = time or position
    if by is None:
        raise ValueError("last_not_null needs a time or a position column")
    out = frame.filter(F.col(value).isNotNull()).groupBy(series).agg(
        F.max_by(value, by).alias("last_value"), F.max(by).alias("last_time")
    )
    return out if time else out.drop("last_time")


def pie_percent(frame: DataFrame, label: str = "bandeira", value: str = "total_coletas") -> DataFrame:
    """Percent of the returned rows' total (the pie legend)."""
    everyone = Window.partitionBy()
    return frame.select(label, value, exact_percent(value, F.sum(value).over(everyone)).alias("percent"))


def rows_to_fields(frame: DataFrame, name: str, value: str, names: list[str] | None = None) -> DataFrame:
    """One column per category (the bar-gauge 'rows to fields')."""
    grouped = frame.groupBy()
    pivoted = grouped.pivot(name, names) if names is not None else grouped.pivot(name)
    return pivoted.agg(F.first(value))
