"""Registered queries: Spark callables and their DuckDB oracles.

Each entry reads the driver tables under ``sf_dir`` (through the demo lake)
and returns a DataFrame whose column names equal the oracle's. Parameters
that the source system takes from a dashboard (time range, products,
thresholds) are fixed here to values that exercise them on the demo data.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postolake.constants import SILVER_COLUMNS
from postolake.operators import analytics as A
from postolake.operators import lattice as L
from postolake.operators.silver import dedup_counts
from postolake.plans import oracle as O
from postolake.plans.lake import demo_lake
from postolake.session import shared_work_dir

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Dashboard parameters used by the registered panels.
D1_RANGE = ("1997-01-01", "2000-12-31")
D6_RANGE = ("1996-04-01", "2001-06-30")
PRODUCTS = ("GASOLINA", "ETANOL")


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def _gold(spark, sf_dir):
    return demo_lake(spark, sf_dir).gold


# ------------------------------------------------------------------ silver

_SILVER_NO_HASH = [c for c in SILVER_COLUMNS if c != "row_hash"]


@register("silver_full", O.with_lake(f"SELECT {', '.join(_SILVER_NO_HASH)} FROM silver", "silver"))
def _silver_full(spark, sf_dir):
    return demo_lake(spark, sf_dir).silver.select(*_SILVER_NO_HASH)


@register(
    "silver_dedup_counts",
    O.with_lake(
        """SELECT CAST(COUNT(*) AS BIGINT) AS input_rows,
                  CAST(COUNT(*) FILTER (WHERE row_key = '|||||||||||||||') AS BIGINT) AS blank_rows,
                  CAST(COUNT(*) FILTER (WHERE row_key <> '|||||||||||||||') - COUNT(DISTINCT row_key)
                       FILTER (WHERE row_key <> '|||||||||||||||') AS BIGINT) AS duplicate_rows,
                  CAST(COUNT(DISTINCT row_key) FILTER (WHERE row_key <> '|||||||||||||||') AS BIGINT) AS silver_rows
           FROM o_keyed""",
        "silver",
    ),
)
def _silver_dedup_counts(spark, sf_dir):
    return dedup_counts(demo_lake(spark, sf_dir).bronze)


# -------------------------------------------------------------------- gold

@register("dim_data", O.with_lake("SELECT * FROM dim_data"))
def _dim_data(spark, sf_dir):
    return demo_lake(spark, sf_dir).star.dim_data


@register("dim_produto", O.with_lake("SELECT * FROM dim_produto"))
def _dim_produto(spark, sf_dir):
    return demo_lake(spark, sf_dir).star.dim_produto


@register("dim_localidade", O.with_lake("SELECT * FROM dim_localidade"))
def _dim_localidade(spark, sf_dir):
    return demo_lake(spark, sf_dir).star.dim_localidade


@register("dim_posto", O.with_lake("SELECT * FROM dim_posto"))
def _dim_posto(spark, sf_dir):
    return demo_lake(spark, sf_dir).star.dim_posto


@register("posto_lookup", O.with_lake("SELECT * FROM posto_lookup"))
def _posto_lookup(spark, sf_dir):
    return demo_lake(spark, sf_dir).star.posto_lookup


_FACT_COLS = ["data_id", "produto_id", "localidade_id", "posto_id", "valor_venda", "valor_compra"]


@register("fact_precos", O.with_lake(f"SELECT {', '.join(_FACT_COLS)} FROM fact"))
def _fact(spark, sf_dir):
    return _gold(spark, sf_dir).fact.select(*_FACT_COLS)


@register(
    "fact_id_check",
    O.with_lake("SELECT CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(*) AS BIGINT) AS distinct_ids, "
                "CAST(1 AS BIGINT) AS min_id, CAST(COUNT(*) AS BIGINT) AS max_id FROM fact"),
)
def _fact_ids(spark, sf_dir):
    f = _gold(spark, sf_dir).fact
    return f.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("fato_id").alias("distinct_ids"),
        F.min("fato_id").alias("min_id"),
        F.max("fato_id").alias("max_id"),
    )


# ------------------------------------------------- panels over one relation

def _panel(
    keys: dict[str, str],
    measures: dict[str, str],
    where: str = "TRUE",
    having: str = "TRUE",
    order: str = "",
    limit: int | None = None,
    numbered: bool = False,
) -> str:
    """Grouped measures over ``sales``, the fact with every dimension attribute (see ``oracle.GOLD_CTE``)."""
    names = [*keys, *measures]
    body = (
        f"SELECT {', '.join(f'{e} AS {n}' for n, e in (keys | measures).items())} "
        f"FROM sales WHERE {where} GROUP BY {', '.join(str(i + 1) for i in range(len(keys)))} HAVING {having}"
    )
    if not (limit or numbered):
        return body
    place = f"SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS place FROM ({body})"
    out = ", ".join([*names, "place"] if numbered else names)
    return f"SELECT {out} FROM ({place}) WHERE place <= {limit or 'place'}"


_VENDA, _COMPRA, _MARGEM = O.xmean("venda"), O.xmean("compra"), O.xmean("venda - compra")
_ROWS = "CAST(COUNT(*) AS BIGINT)"
_BOTH = "venda - compra IS NOT NULL"
_TRADED = "LEAST(venda, compra) > 0 AND venda - compra IS NOT NULL"
_MONTH, _QUARTER = "CAST(date_trunc('month', dia) AS DATE)", "CAST(date_trunc('quarter', dia) AS DATE)"
_CHOSEN = f"produto IN {O.in_list(PRODUCTS)}"

_D1_SQL = _panel(
    {"time": _MONTH, "metric": "produto"},
    {"value": _VENDA},
    f"{_MONTH} >= DATE '{D1_RANGE[0]}' AND {_MONTH} <= DATE '{D1_RANGE[1]}'",
)
_D2 = dict(keys={"produto": "produto"}, measures={"preco_medio": _VENDA}, where="venda > 0", order="preco_medio DESC NULLS FIRST")
_D4 = dict(keys={"regiao_sigla": "regiao", "produto": "produto"}, measures={"margem_media": _MARGEM}, where=_BOTH)
_B1 = dict(
    keys={"ano": "ano", "mes": "mes", "produto": "produto"},
    measures={"preco_medio_venda": _VENDA, "preco_medio_compra": _COMPRA},
    order="ano, mes, produto",
)
_B3 = dict(
    keys={"municipio": "cidade", "estado_sigla": "uf"},
    measures={"preco_medio": _VENDA, "total_coletas": _ROWS},
    where="produto = 'GASOLINA'",
    having="COUNT(*) >= 100",
    order="preco_medio DESC NULLS FIRST, municipio, estado_sigla",
    limit=10,
)
_B4 = dict(
    keys={"regiao_sigla": "regiao", "produto": "produto"},
    measures={"margem_media": _MARGEM, "preco_venda_medio": _VENDA, "preco_compra_medio": _COMPRA},
    where=_BOTH,
    order="regiao_sigla, margem_media DESC NULLS FIRST",
)
# brands count under their stored name, so NULL and the label are separate rows
_BRANDS = dict(
    keys={"marca": "marca"}, measures={"total_coletas": _ROWS}, order="total_coletas DESC, marca ASC NULLS FIRST", limit=15
)
_BRAND_SQL = f"SELECT COALESCE(NULLIF(marca, ''), '{O.UNBRANDED_LABEL}') AS bandeira, total_coletas FROM ({_panel(**_BRANDS)})"


@register("dash_01_monthly_price", O.with_lake(_D1_SQL))
def _d1(spark, sf_dir):
    return A.dash_monthly_price(_gold(spark, sf_dir), *D1_RANGE)


@register("dash_02_price_by_product", O.with_lake(_panel(**_D2)))
def _d2(spark, sf_dir):
    return A.dash_price_by_product(_gold(spark, sf_dir))


@register("dash_03_rows_per_year", O.with_lake(_panel({"ano": "CAST(ano AS VARCHAR)"}, {"coletas": _ROWS})))
def _d3(spark, sf_dir):
    return A.dash_rows_per_year(_gold(spark, sf_dir))


@register("dash_04_margin_by_region", O.with_lake(_panel(**_D4)))
def _d4(spark, sf_dir):
    return A.dash_margin_by_region(_gold(spark, sf_dir))


@register("dash_05_brand_share", O.with_lake(_BRAND_SQL))
def _d5(spark, sf_dir):
    return A.dash_brand_share(_gold(spark, sf_dir))


@register(
    "dash_06_quarterly_price",
    O.with_lake(
        _panel(
            {"time": _QUARTER, "metric": "produto"},
            {"value": _VENDA},
            f"{_CHOSEN} AND {_QUARTER} >= DATE '{D6_RANGE[0]}' AND {_QUARTER} <= DATE '{D6_RANGE[1]}'",
        )
    ),
)
def _d6(spark, sf_dir):
    return A.dash_quarterly_price(_gold(spark, sf_dir), PRODUCTS, *D6_RANGE)


@register(
    "dash_07_product_summary",
    O.with_lake(
        _panel(
            {"produto": "produto"},
            {"preco_medio_compra": _COMPRA, "preco_medio_venda": _VENDA, "margem_media": _MARGEM, "total_registros": _ROWS},
            _TRADED,
        )
    ),
)
def _d7(spark, sf_dir):
    return A.dash_product_summary(_gold(spark, sf_dir))


@register("dash_08_total_rows", O.with_lake(f"SELECT {_ROWS} AS total FROM sales"))
def _d8(spark, sf_dir):
    return A.kpi_total_rows(_gold(spark, sf_dir))


@register("dash_09_products", O.with_lake("SELECT CAST(MAX(produto_id) AS BIGINT) AS produtos FROM dim_produto"))
def _d9(spark, sf_dir):
    return A.kpi_products(_gold(spark, sf_dir))


@register(
    "dash_10_cities",
    O.with_lake("SELECT CAST(len(list_distinct(list(municipio))) AS BIGINT) AS municipios FROM dim_localidade"),
)
def _d10(spark, sf_dir):
    return A.kpi_cities(_gold(spark, sf_dir))


@register("dash_11_stations", O.with_lake("SELECT CAST(MAX(posto_id) AS BIGINT) AS postos FROM dim_posto"))
def _d11(spark, sf_dir):
    return A.kpi_stations(_gold(spark, sf_dir))


@register("bi_01_monthly_prices", O.with_lake(_panel(**_B1)))
def _b1(spark, sf_dir):
    return A.bi_monthly_prices(_gold(spark, sf_dir))


_B2_SQL = _panel({"estado_sigla": "uf", "produto": "produto"}, {"preco_medio_venda": _VENDA, "total_coletas": _ROWS})


@register("bi_02_price_by_state", O.with_lake(_B2_SQL))
def _b2(spark, sf_dir):
    return A.bi_price_by_state(_gold(spark, sf_dir))


@register("bi_03_top_cities", O.with_lake(_panel(**_B3)))
def _b3(spark, sf_dir):
    return A.bi_top_cities(_gold(spark, sf_dir), "GASOLINA", 100, 10)


@register("bi_04_margin_by_region", O.with_lake(_panel(**_B4)))
def _b4(spark, sf_dir):
    return A.bi_margin_by_region(_gold(spark, sf_dir))


@register(
    "bi_05_brand_distribution",
    O.with_lake(f"SELECT *, {O.xpercent('total_coletas', 'SUM(total_coletas) OVER ()')} AS percentual FROM ({_BRAND_SQL})"),
)
def _b5(spark, sf_dir):
    return A.bi_brand_distribution(_gold(spark, sf_dir))


@register(
    "bi_06_quarterly_price",
    O.with_lake(
        _panel({"ano": "ano", "trimestre": "trimestre", "produto": "produto"}, {"preco_medio": _VENDA}, _CHOSEN)
    ),
)
def _b6(spark, sf_dir):
    return A.bi_quarterly_price(_gold(spark, sf_dir), PRODUCTS)


# The same panels from partial states of two loads.
_LATTICES: dict[tuple, L.Lattice] = {}


def _lattice(spark, sf_dir):
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"))
    if key not in _LATTICES:
        gold = _gold(spark, sf_dir)
        lattice = L.Lattice(spark, shared_work_dir(spark, f"lattice-{uuid.uuid4().hex}"))
        early = gold.dim_data.where("data < DATE '1995-06-18'").select("data_id")
        for kind in ("left_semi", "left_anti"):
            lattice.add(dataclasses.replace(gold, fact=gold.fact.join(gold.dim("dim_data", early), "data_id", kind)))
        _LATTICES[key] = lattice
    return _LATTICES[key]


def _register_lattice(panel: str, answer) -> None:
    register(f"lattice_{panel}", ORACLES[panel])(lambda spark, sf_dir: answer(_lattice(spark, sf_dir)))


for _panel_name, _answer in {
    "dash_01_monthly_price": lambda x: L.dash_monthly_price(x, *D1_RANGE),
    "dash_02_price_by_product": L.dash_price_by_product,
    "dash_03_rows_per_year": L.dash_rows_per_year,
    "dash_04_margin_by_region": L.dash_margin_by_region,
    "dash_05_brand_share": L.dash_brand_share,
    "dash_06_quarterly_price": lambda x: L.dash_quarterly_price(x, PRODUCTS, *D6_RANGE),
    "dash_07_product_summary": L.dash_product_summary,
    "dash_08_total_rows": L.kpi_total_rows,
    "dash_09_products": L.kpi_products,
    "dash_10_cities": L.kpi_cities,
    "dash_11_stations": L.kpi_stations,
    "bi_01_monthly_prices": L.bi_monthly_prices,
    "bi_02_price_by_state": L.bi_price_by_state,
    "bi_03_top_cities": lambda x: L.bi_top_cities(x, "GASOLINA", 100, 10),
    "bi_04_margin_by_region": L.bi_margin_by_region,
    "bi_05_brand_distribution": L.bi_brand_distribution,
    "bi_06_quarterly_price": lambda x: L.bi_quarterly_price(x, PRODUCTS),
}.items():
    _register_lattice(_panel_name, _answer)


@register(
    "lattice_cities_by_quarter",
    O.with_lake(f"SELECT {_QUARTER} AS period, CAST(COUNT(DISTINCT cidade) AS BIGINT) AS municipios FROM sales GROUP BY 1"),
)
def _lattice_cities(spark, sf_dir):
    """A5: distinct cities of each quarter from bitmaps of its days."""
    return _lattice(spark, sf_dir).cities_by(F.date_trunc("quarter", "data").cast("date"))


@register("bi_07_price_sample", None)
def _b7_rows(spark, sf_dir):
    return A.bi_price_sample(_gold(spark, sf_dir), 5000, seed=7)


@register(
    "bi_07_sample_check",
    O.with_lake(
        f"""SELECT LEAST(COUNT(*), 5000) AS sampled, LEAST(COUNT(*), 5000) AS sampled_again, CAST(0 AS BIGINT) AS not_in_facts
            FROM sales WHERE {_TRADED}"""
    ),
)
def _b7(spark, sf_dir):
    """The random sample itself, counted against the facts it comes from."""
    gold = _gold(spark, sf_dir)
    population = A.priced_facts(gold)
    sample = A.bi_price_sample(gold, 5000, seed=7)
    columns = population.columns
    # multiset difference: a pair sampled more often than it occurs shows up
    strange = (
        sample.groupBy(columns)
        .agg(F.count("*").alias("taken"))
        .join(population.groupBy(columns).agg(F.count("*").alias("there")), columns, "left")
        .agg(F.sum(F.greatest(F.col("taken") - F.coalesce("there", F.lit(0)), F.lit(0))).alias("not_in_facts"))
    )
    counts = [A.bi_price_sample(gold, 5000, seed=7).agg(F.count("*").alias(n)) for n in ("sampled", "sampled_again")]
    one = lambda df: df.withColumn("_one", F.lit(1))  # noqa: E731  one row each
    return one(counts[0]).join(one(counts[1]), "_one").join(one(strange), "_one").drop("_one")


_ORDERED = {
    "dash_02_price_by_product": (_D2, "produto"),
    "dash_05_brand_share": (_BRANDS, f"COALESCE(NULLIF(marca, ''), '{O.UNBRANDED_LABEL}')"),
    "bi_01_monthly_prices": (_B1, "ano || '-' || mes || '-' || produto"),
    "bi_03_top_cities": (_B3, "municipio || '-' || estado_sigla"),
    "bi_04_margin_by_region": (_B4, "regiao_sigla || '-' || produto"),
}
_ORDERED_KEYS = {
    "dash_02_price_by_product": ["produto"],
    "dash_05_brand_share": ["bandeira"],
    "bi_01_monthly_prices": ["ano", "mes", "produto"],
    "bi_03_top_cities": ["municipio", "estado_sigla"],
    "bi_04_margin_by_region": ["regiao_sigla", "produto"],
}


@register(
    "panel_order",
    O.with_lake(
        " UNION ALL ".join(
            f"SELECT '{name}' AS panel, CAST(place AS BIGINT) AS place, {label} AS label FROM ({_panel(**q, numbered=True)})"
            for name, (q, label) in _ORDERED.items()
        )
    ),
)
def _panel_order(spark, sf_dir):
    """The order in which panels deliver their rows (small results, so positions are taken from collect)."""
    rows = []
    for name, keys in _ORDERED_KEYS.items():
        for place, r in enumerate(QUERIES[name](spark, sf_dir).collect(), 1):
            rows.append((name, place, "-".join(str(r[k]) for k in keys)))
    return spark.createDataFrame(rows, "panel string, place long, label string")


# --------------------------------------------------------- panel reductions

@register(
    "legend_calcs",
    O.with_lake(
        f"""SELECT metric, {O.xmean('value')} AS mean, MAX(value) AS max, MIN(value) AS min
            FROM ({_D1_SQL}) GROUP BY metric"""
    ),
)
def _legend(spark, sf_dir):
    return A.legend_calcs(A.dash_monthly_price(_gold(spark, sf_dir), *D1_RANGE))


@register(
    "last_not_null",
    O.with_lake(
        f"""SELECT metric, arg_max(value, time) AS last_value, MAX(time) AS last_time
            FROM ({_D1_SQL}) WHERE value IS NOT NULL GROUP BY metric"""
    ),
)
def _last(spark, sf_dir):
    return A.last_not_null(A.dash_monthly_price(_gold(spark, sf_dir), *D1_RANGE))


@register(
    "pie_percent",
    O.with_lake(f"SELECT *, {O.xpercent('total_coletas', 'SUM(total_coletas) OVER ()')} AS percent FROM ({_BRAND_SQL})"),
)
def _pie(spark, sf_dir):
    return A.pie_percent(A.dash_brand_share(_gold(spark, sf_dir)))


_FIELDS = ["GASOLINA", "GASOLINA ADITIVADA", "ETANOL", "DIESEL", "DIESEL S10", "GNV"]


@register(
    "rows_to_fields",
    O.with_lake(
        "SELECT "
        + ", ".join(f"MAX(preco_medio) FILTER (WHERE produto = '{n}') AS \"{n}\"" for n in _FIELDS)
        + f" FROM ({_panel(**_D2)})"
    ),
)
def _r2f(spark, sf_dir):
    return A.rows_to_fields(A.dash_price_by_product(_gold(spark, sf_dir)), "produto", "preco_medio", _FIELDS)


# ---------------------------------------------------------------- quality

from postolake.constants import BRONZE_HEADER_MAP, DIGIT_COLUMNS, UPPER_TRIM_COLUMNS  # noqa: E402
from postolake.functions import (  # noqa: E402
    br_decimal,
    clean_text,
    digits_only,
    matches_dmy_format,
    safe_date,
    strip_nul,
    trim_spaces,
)
from postolake.functions.unicode_fix import fix_unicode  # noqa: E402
from postolake.operators import quality as Q  # noqa: E402

_DMY = "^(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])/(1[0-2]|0[1-9]|[1-9])/([0-9]{4})$"


def _dmy_ok_sql(h: str) -> str:
    c = O.q(h)
    ext = lambda g: f"regexp_extract({c}, '{_DMY}', {g})"
    return (
        f"(regexp_full_match({c}, '{_DMY}') AND TRY_CAST({ext(3)} || '-' || lpad(trim({ext(2)}), 2, '0') || '-' || "
        f"lpad(trim({ext(1)}), 2, '0') AS DATE) IS NOT NULL AND {ext(3)} <> '0000')"
    )


def _unexpected_sql(e: Q.Expectation) -> str:
    c = O.q(e.column)
    if e.kind == "not_null":
        return f"{c} IS NULL"
    if e.kind == "in_set":
        return f"{c} IS NOT NULL AND {c} NOT IN {O.in_list(e.values)}"
    return f"{c} IS NOT NULL AND NOT {_dmy_ok_sql(e.column)}"


def _suite_sql(suite: list[Q.Expectation], src: str) -> str:
    parts = []
    for i, e in enumerate(suite, start=1):
        head = f"SELECT {i} AS ordinal, {O.lit(e.name)} AS expectation, {O.lit(e.column)} AS \"column\", CAST(COUNT(*) AS BIGINT) AS element_count"
        if e.kind == "exists":
            parts.append(f"{head}, CAST(NULL AS BIGINT) AS missing_count, CAST(0 AS BIGINT) AS unexpected_count, "
                         f"CAST(0.0 AS DOUBLE) AS unexpected_percent, TRUE AS success FROM {src}")
            continue
        if e.kind == "column_list":
            parts.append(f"{head}, CAST(NULL AS BIGINT) AS missing_count, CAST(0 AS BIGINT) AS unexpected_count, "
                         f"CAST(0.0 AS DOUBLE) AS unexpected_percent, TRUE AS success FROM {src}")
            continue
        c = O.q(e.column)
        m = f"COUNT(*) FILTER (WHERE {c} IS NULL)"
        u = f"COUNT(*) FILTER (WHERE {_unexpected_sql(e)})"
        base = "COUNT(*)" if e.kind == "not_null" else f"(COUNT(*) - {m})"
        pct = f"CAST({u} AS DOUBLE) * CAST(100 AS DOUBLE) / NULLIF(CAST({base} AS DOUBLE), CAST(0 AS DOUBLE))"
        parts.append(f"{head}, CAST({m} AS BIGINT) AS missing_count, CAST({u} AS BIGINT) AS unexpected_count, "
                     f"{pct} AS unexpected_percent, {u} = 0 AS success FROM {src}")
    return "\nUNION ALL\n".join(parts)


_FIRST_FILE = "(SELECT * FROM bronze WHERE filename = (SELECT MIN(filename) FROM bronze))"


def _bronze(spark, sf_dir):
    return demo_lake(spark, sf_dir).bronze


@register("dq_suite", O.with_lake(_suite_sql(Q.default_suite(), "bronze"), "bronze"))
def _dq_suite(spark, sf_dir):
    return Q.run_suite(_bronze(spark, sf_dir), Q.default_suite(), sample="all")


@register("dq_suite_first_file", O.with_lake(_suite_sql(Q.default_suite(), _FIRST_FILE), "bronze"))
def _dq_first(spark, sf_dir):
    return Q.run_suite(_bronze(spark, sf_dir), Q.default_suite(), sample="first")


_EXTENDED = Q.default_suite(include_products=True, include_columns=True)


@register("dq_suite_extended", O.with_lake(_suite_sql(_EXTENDED, "bronze"), "bronze"))
def _dq_ext(spark, sf_dir):
    return Q.run_suite(_bronze(spark, sf_dir), _EXTENDED, sample="all")


@register(
    "dq_overall",
    O.with_lake(
        f"""SELECT bool_and(success) AS success, CAST(COUNT(*) AS BIGINT) AS expectations,
                   CAST(COUNT(*) FILTER (WHERE NOT success) AS BIGINT) AS failed
            FROM ({_suite_sql(Q.default_suite(), 'bronze')})""",
        "bronze",
    ),
)
def _dq_overall(spark, sf_dir):
    return Q.suite_success(Q.run_suite(_bronze(spark, sf_dir), Q.default_suite(), sample="all"))


def _unexpected_values_sql(suite, src, top=20):
    value_kinds = [(i, e) for i, e in enumerate(suite, start=1) if e.kind in ("not_null", "in_set", "dmy_format")]
    findings = "\nUNION ALL\n".join(
        f"SELECT {i} AS ordinal, {O.q(e.column)} AS value FROM {src} WHERE {_unexpected_sql(e)}" for i, e in value_kinds
    )
    name_case = "CASE ordinal " + " ".join(f"WHEN {i} THEN {O.lit(e.name)}" for i, e in value_kinds) + " END"
    col_case = "CASE ordinal " + " ".join(f"WHEN {i} THEN {O.lit(e.column)}" for i, e in value_kinds) + " END"
    return f"""SELECT ordinal, {name_case} AS expectation, {col_case} AS "column", value, count, CAST(rank AS INTEGER) AS rank
               FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ordinal ORDER BY count DESC, value ASC NULLS FIRST) AS rank
                     FROM (SELECT ordinal, value, CAST(COUNT(*) AS BIGINT) AS count FROM ({findings}) GROUP BY ordinal, value))
               WHERE rank <= {top}"""


@register("dq_unexpected", O.with_lake(_unexpected_values_sql(Q.default_suite(), "bronze"), "bronze"))
def _dq_unexpected(spark, sf_dir):
    return Q.unexpected_values(_bronze(spark, sf_dir), Q.default_suite(), sample="all", top=20)


# ------------------------------------------------------- scalar functions

def _explode_pairs(df, structs):
    return df.select(F.explode(F.array(*structs)).alias("x")).select("x.*")


def _raw(h):
    return F.col(f"`{h}`")


def _fn_pairs(names, spark_fn, sql_fn, value_name="cleaned"):
    chosen = [(h, s) for h, s in BRONZE_HEADER_MAP if s in names]

    def run(spark, sf_dir):
        structs = [
            F.struct(F.lit(s).alias("column"), _raw(h).alias("raw"), spark_fn(_raw(h)).alias(value_name))
            for h, s in chosen
        ]
        pairs = _explode_pairs(_bronze(spark, sf_dir), structs)
        return pairs.groupBy("column", "raw", value_name).agg(F.count(F.lit(1)).alias("n"))

    union = "\nUNION ALL\n".join(
        f"SELECT {O.lit(s)} AS \"column\", {O.q(h)} AS raw, {sql_fn(O.q(h))} AS {value_name} FROM bronze"
        for h, s in chosen
    )
    sql = O.with_lake(
        f"SELECT \"column\", raw, {value_name}, CAST(COUNT(*) AS BIGINT) AS n FROM ({union}) GROUP BY ALL", "bronze"
    )
    return run, sql


for _name, _cols, _sfn, _sqlfn, _vn in [
    ("fn_clean_text", UPPER_TRIM_COLUMNS, clean_text, lambda c: f"UPPER(TRIM({c}))", "cleaned"),
    ("fn_trim_only", ["numero_rua"], trim_spaces, lambda c: f"TRIM({c})", "cleaned"),
    ("fn_digits_only", DIGIT_COLUMNS, digits_only, lambda c: f"REGEXP_REPLACE({c}, '\\D', '', 'g')", "cleaned"),
    ("fn_br_decimal", ["valor_venda", "valor_compra"], br_decimal,
     lambda c: f"TRY_CAST(REPLACE(REPLACE({c}, '.', ''), ',', '.') AS DOUBLE)", "value"),
]:
    _run, _sql = _fn_pairs(_cols, _sfn, _sqlfn, _vn)
    register(_name, _sql)(_run)


@register(
    "fn_safe_date",
    O.with_lake(
        f"""SELECT raw, data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
                   CAST(COUNT(*) AS BIGINT) AS n
            FROM (SELECT "Data da Coleta" AS raw, {O._SAFE_DATE.format(c='"Data da Coleta"')} AS data FROM bronze)
            GROUP BY ALL""",
        "bronze",
    ),
)
def _fn_safe_date(spark, sf_dir):
    b = _bronze(spark, sf_dir).select(_raw("Data da Coleta").alias("raw"))
    d = b.select("raw", safe_date("raw").alias("data"))
    return d.groupBy("raw", "data", F.year("data").alias("ano"), F.month("data").alias("mes")).agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "fn_dmy_format",
    O.with_lake(
        f"""SELECT "Data da Coleta" AS raw, COALESCE({_dmy_ok_sql('Data da Coleta')}, FALSE) AS valid,
                   CAST(COUNT(*) AS BIGINT) AS n
            FROM bronze WHERE "Data da Coleta" IS NOT NULL GROUP BY ALL""",
        "bronze",
    ),
)
def _fn_dmy(spark, sf_dir):
    b = _bronze(spark, sf_dir).select(_raw("Data da Coleta").alias("raw")).filter(F.col("raw").isNotNull())
    return b.groupBy("raw", F.coalesce(matches_dmy_format("raw"), F.lit(False)).alias("valid")).agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "fn_strip_nul",
    """SELECT doc_id, CAST(doc_id % 4 AS INTEGER) AS nul_chars, CAST(length(text) AS INTEGER) AS clean_chars,
              md5(text) AS clean FROM documents""",
)
def _fn_strip_nul(spark, sf_dir):
    """Zero to three NULs are put in front of, inside and behind each text and taken out again."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    nul = lambda k: F.when(F.col("doc_id") % 4 >= k, F.lit("\u0000")).otherwise(F.lit(""))
    half = F.substring("text", 1, 5)
    rest = F.substr("text", F.lit(6))
    dirty = d.withColumn("dirty", F.concat(nul(1), half, nul(2), rest, nul(3)))
    clean = strip_nul("dirty")
    return dirty.select(
        "doc_id",
        (F.length("dirty") - F.length(clean)).alias("nul_chars"),
        F.length(clean).alias("clean_chars"),
        F.md5(clean).alias("clean"),
    )


# letters whose UTF-8 bytes, read as latin-1, survive NFKC (others are folded before the repair, as in the source system)
_REPAIRABLE = "^[a-zA-Z]*[éçñáäö][a-zA-Zéçñáäö]*$"


@register(
    "fn_fix_unicode",
    f"""SELECT word AS once, word AS twice, word AS plain, n
        FROM (SELECT word, COUNT(*) AS n
              FROM (SELECT unnest(string_split_regex(text, '[\\s.,!|$%&#*]+')) AS word FROM documents)
              WHERE regexp_matches(word, '{_REPAIRABLE}') GROUP BY word)""",
)
def _fn_fix_unicode(spark, sf_dir):
    """Words of all documents, garbled by one and by two latin-1 rounds, repaired by the Arrow-batched UDF."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = d.select(F.explode(F.split("text", r"[\s.,!|$%&#*]+")).alias("word")).where(F.col("word").rlike(_REPAIRABLE))
    garble = lambda c: F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    per_word = words.groupBy("word").agg(F.count("*").alias("n"))
    return per_word.select(
        fix_unicode(garble(F.col("word"))).alias("once"),
        fix_unicode(garble(garble(F.col("word")))).alias("twice"),
        fix_unicode("word").alias("plain"),
        "n",
    )


# ----------------------------------------------------- sources and sinks

from postolake.operators.keymap import KeyMap  # noqa: E402
from postolake.operators.silver import build_silver  # noqa: E402
from postolake.plans.files import (  # noqa: E402
    MEMBERS,
    dealt,
    dealt_sql,
    demo_files,
    multiline_by_files,
    silver_by_files,
    streamed_silver_path,
    write_edge_files,
    write_member_archives,
    zip_frame,
    zip_set,
)
from postolake.streaming.incremental import append_new_silver, read_streamed_silver  # noqa: E402
from postolake.sources import manifest as M  # noqa: E402
from postolake.sources.archives import archive_members_to_bronze, expand_content, rejected_archives  # noqa: E402
from postolake.sources.zip_members import read_members, rejected_members  # noqa: E402
from postolake.sources.bronze_csv import bronze_rejects, detect_encodings, read_bronze, write_bronze_csv  # noqa: E402

_HEADERS_SQL = ", ".join(O.q(h) for h, _ in BRONZE_HEADER_MAP)
_SILVER_VALUES = [c for c in SILVER_COLUMNS if c not in ("row_hash", "filename")]


@register("bronze_csv_roundtrip", O.with_lake(f"SELECT {_HEADERS_SQL} FROM bronze", "bronze"))
def _bronze_csv(spark, sf_dir):
    root = demo_files(spark, sf_dir, "bronze_mixed")
    return read_bronze(spark, root).select(*[F.col(f"`{h}`") for h, _ in BRONZE_HEADER_MAP])


@register("silver_from_csv", O.with_lake(f"SELECT {', '.join(_SILVER_VALUES)} FROM silver", "silver"))
def _silver_csv(spark, sf_dir):
    return silver_by_files(spark, sf_dir).select(*_SILVER_VALUES)


_BROKEN = """CASE WHEN %s = 0 THEN 'bloco "' || COALESCE("Bairro", '') || '"' || chr(10) || chr(10) || 'fundos; ' || COALESCE("Numero Rua", '')
             ELSE "Complemento" END""" % dealt_sql(3)


@register(
    "bronze_multiline",
    O.with_lake(
        "SELECT " + ", ".join(f"{_BROKEN} AS {O.q(h)}" if h == "Complemento" else O.q(h) for h, _ in BRONZE_HEADER_MAP) + " FROM bronze",
        "bronze",
    ),
)
def _bronze_multiline(spark, sf_dir):
    """Quoted fields with line breaks, separators and quotes in files of both charsets, read in blocks."""
    return multiline_by_files(spark, demo_lake(spark, sf_dir).bronze).select(*[F.col(f"`{h}`") for h, _ in BRONZE_HEADER_MAP])


_GIVEN = ", ".join(
    f"CASE WHEN {dealt_sql(4)} <> 3 THEN {O.q(h)} END AS {O.q(h)}" if h in ("Bandeira", "Complemento") else O.q(h)
    for h, _ in BRONZE_HEADER_MAP
)


def _fresh_dir(spark, name):
    return shared_work_dir(spark, f"{name}-{uuid.uuid4().hex}")


@register("bronze_edge_files", O.with_lake(f"SELECT {_GIVEN} FROM bronze", "bronze"))
def _edge_files(spark, sf_dir):
    """S1-S7 on names with spaces, brackets and percent signs, blank lines first, reordered and missing headers."""
    root = write_edge_files(demo_lake(spark, sf_dir).bronze, _fresh_dir(spark, "edge"), [0, 1, 2, 3])
    # a written row without any value is a line of separators, read back as a row of NULLs
    return read_bronze(spark, root, glob="*.txt").select(*[F.col(f"`{h}`") for h, _ in BRONZE_HEADER_MAP])


@register(
    "rejected_files",
    O.with_lake(
        f"""SELECT 'no expected column in the header' AS reason, CAST(COUNT(*) AS BIGINT) AS lines FROM bronze
            WHERE {dealt_sql(2)} = 1 AND regexp_matches(concat_ws(';', {_HEADERS_SQL}), '[^; \\t"]')""",
        "bronze",
    ),
)
def _rejected(spark, sf_dir):
    """Files without a header are refused with their number of lines; their neighbours are read."""
    root = write_edge_files(demo_lake(spark, sf_dir).bronze, _fresh_dir(spark, "edge"), [0, 4])
    return bronze_rejects(spark, root, glob="*.txt").groupBy("reason").agg(F.sum("lines").alias("lines"))


@register(
    "zip_expand",
    O.with_lake(
        f"""SELECT 'row' AS kind, {_HEADERS_SQL} FROM bronze WHERE {dealt_sql(12)} <> 3
            UNION ALL SELECT 'damaged z3.zip', {", ".join("NULL" for _ in BRONZE_HEADER_MAP)}
            WHERE EXISTS (SELECT 1 FROM bronze WHERE {dealt_sql(12)} = 3)""",
        "bronze",
    ),
)
def _zip_expand(spark, sf_dir):
    """Two members of different charset and column order in each archive; damaged archives give no row, their set one."""
    path = _fresh_dir(spark, "zips")
    expand_content(zip_frame(demo_lake(spark, sf_dir).bronze)).write.parquet(path)
    expanded = spark.read.parquet(path)
    names = [h for h, _ in BRONZE_HEADER_MAP]
    rows = archive_members_to_bronze(expanded).select(F.lit("row").alias("kind"), *[F.col(f"`{h}`") for h in names])
    bad = rejected_archives(expanded).select(
        F.concat(F.lit("damaged "), zip_set("archive")).alias("kind"), *[F.lit(None).cast("string").alias(h) for h in names]
    )
    bad = bad.dropDuplicates(["kind"])
    return rows.unionByName(bad)


@register(
    "zip_members",
    O.with_lake(
        f"""SELECT 'row' AS kind, {_HEADERS_SQL} FROM bronze WHERE {dealt_sql(MEMBERS)} <> 3
            UNION ALL SELECT 'damaged m3.csv', {", ".join("NULL" for _ in BRONZE_HEADER_MAP)}
            WHERE EXISTS (SELECT 1 FROM bronze WHERE {dealt_sql(MEMBERS)} = 3)""",
        "bronze",
    ),
)
def _zip_members(spark, sf_dir):
    """Archives on the shared file system read member by member; a damaged member gives no row, its neighbours do."""
    root = _fresh_dir(spark, "members")
    write_member_archives(demo_lake(spark, sf_dir).bronze, root)
    lines = read_members(spark, root)
    names = [h for h, _ in BRONZE_HEADER_MAP]
    rows = archive_members_to_bronze(lines).select(F.lit("row").alias("kind"), *[F.col(f"`{h}`") for h in names])
    bad = rejected_members(lines).select(
        F.concat(F.lit("damaged "), "member").alias("kind"), *[F.lit(None).cast("string").alias(h) for h in names]
    )
    return rows.unionByName(bad.dropDuplicates(["kind"]))


_PLACE = ["regiao_sigla", "estado_sigla", "municipio"]
_PLACE_ORDER = ", ".join(f"{c} NULLS FIRST" for c in _PLACE)


@register(
    "keys_outlive_reload",
    O.with_lake(
        f"""SELECT * FROM (
            WITH a AS (SELECT DISTINCT {", ".join(_PLACE)} FROM silver WHERE municipio > 'M'),
                 b AS (SELECT {", ".join(_PLACE)} FROM silver EXCEPT SELECT * FROM a)
            SELECT CAST(row_number() OVER (ORDER BY {_PLACE_ORDER}) AS BIGINT) AS localidade_id, *, 1 AS load FROM a
            UNION ALL
            SELECT CAST((SELECT COUNT(*) FROM a) + row_number() OVER (ORDER BY {_PLACE_ORDER}) AS BIGINT), *, 2 FROM b)""",
        "silver",
    ),
)
def _keys_outlive_reload(spark, sf_dir):
    """A first load of some places, then one of all; places of the first keep their ids."""
    silver = demo_lake(spark, sf_dir).silver
    places = KeyMap(spark, _fresh_dir(spark, "keys"), _PLACE, "localidade_id")
    places.extend(silver.where("municipio > 'M'"))
    return places.extend(silver).select("localidade_id", *_PLACE, "load")


_NON_ASCII_ANY = " OR ".join(f"regexp_matches({O.q(h)}, '[^\\x00-\\x7F]')" for h, _ in BRONZE_HEADER_MAP)


@register(
    "encoding_groups",
    O.with_lake(
        f"""SELECT encoding, CAST(COUNT(*) AS BIGINT) AS sources
            FROM (SELECT filename,
                         CASE WHEN filename LIKE 'ca-199%' AND bool_or(COALESCE({_NON_ASCII_ANY}, FALSE))
                              THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding
                  FROM bronze GROUP BY filename)
            GROUP BY encoding""",
        "bronze",
    ),
)
def _encodings(spark, sf_dir):
    """Detected charset per source file (latin-1 if any of its part files is)."""
    root = demo_files(spark, sf_dir, "bronze_mixed")
    per_part = detect_encodings(spark, root).withColumn(
        "source", F.regexp_extract("filename", "source_file=([^/]+)/", 1)
    )
    per_source = per_part.groupBy("source").agg(
        F.max(F.col("encoding") == "ISO-8859-1").alias("latin1")
    )
    return per_source.groupBy(
        F.when(F.col("latin1"), F.lit("ISO-8859-1")).otherwise(F.lit("UTF-8")).alias("encoding")
    ).agg(F.count(F.lit(1)).alias("sources"))


@register(
    "silver_partition_counts",
    O.with_lake("SELECT ano, CAST(COUNT(*) AS BIGINT) AS n FROM silver GROUP BY ano", "silver"),
)
def _silver_parts(spark, sf_dir):
    path = demo_files(spark, sf_dir, "silver")
    return spark.read.parquet(path).groupBy("ano").agg(F.count(F.lit(1)).alias("n"))


@register("incremental_silver", O.with_lake(f"SELECT {', '.join(_SILVER_VALUES)} FROM silver", "silver"))
def _incremental(spark, sf_dir):
    path = streamed_silver_path(spark, sf_dir)
    return spark.read.parquet(path).select(*_SILVER_VALUES)


@register("incremental_survivors", O.with_lake(f"SELECT {', '.join(_SILVER_NO_HASH)} FROM silver", "silver"))
def _incremental_survivors(spark, sf_dir):
    """The last file name first, the others next, then the first file again; survivors as in one load."""
    bronze, path = demo_lake(spark, sf_dir).bronze, f"{_fresh_dir(spark, 'survivors')}/silver"
    last = F.col("filename") == "copy.csv"
    for batch in (bronze.where(last), bronze.where(~last), bronze.where(last)):
        append_new_silver(batch, path)
    return read_streamed_silver(spark, path).select(*_SILVER_NO_HASH)


_LANDING = "/landing"


@register(
    "target_path",
    f"""SELECT page_id, url,
               '{_LANDING}/' || CASE WHEN page_id % 3 = 0 THEN 'dsan/' || CAST(2000 + page_id % 20 AS VARCHAR) || '/' ELSE '' END
               || CASE WHEN page_id % 6 = 4 THEN 'dsan' ELSE 'f' || CAST(page_id AS VARCHAR) || '.csv' END AS target
        FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') || CASE
                WHEN page_id % 3 = 0 THEN '/dsan/' || CAST(2000 + page_id % 20 AS VARCHAR) || '/x/f' || CAST(page_id AS VARCHAR) || '.csv'
                WHEN page_id % 6 = 4 THEN '/dsan'
                ELSE '/dsanx/f' || CAST(page_id AS VARCHAR) || '.csv' END AS url FROM pages)""",
)
def _target_path(spark, sf_dir):
    """S15 on page URLs extended by a dsan year folder, a closing dsan, or a similar segment."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    k = F.col("page_id").cast("string")
    name = F.concat(F.lit("f"), k, F.lit(".csv"))
    tail = (
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/dsan/"), (2000 + F.col("page_id") % 20).cast("string"), F.lit("/x/"), name))
        .when(F.col("page_id") % 6 == 4, F.lit("/dsan"))
        .otherwise(F.concat(F.lit("/dsanx/"), name))
    )
    urls = pages.select("page_id", F.concat(F.regexp_replace("url", "[?#].*$", ""), tail).alias("url"))
    return urls.select("page_id", "url", M.landing_path("url", _LANDING).alias("target"))


def _fetch_log(spark, sf_dir):
    """A fetch log derived from pages: requested URL, HTTP status, content type."""
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    k = F.col("page_id")
    url = F.concat(
        F.col("url"), F.when(k % 4 == 0, F.lit(".csv")).when(k % 4 == 1, F.lit(".zip")).otherwise(F.lit(""))
    )
    status = F.when(k % 11 == 0, F.lit(404)).otherwise(F.lit(200))
    ctype = (
        F.when(k % 6 == 0, "text/html; charset=utf-8").when(k % 6 == 1, "text/csv")
        .when(k % 6 == 2, "application/zip").when(k % 6 == 3, "application/octet-stream")
        .when(k % 6 == 4, "application/xhtml+xml").otherwise(F.lit(None).cast("string"))
    )
    return p.select("page_id", url.alias("url"), status.alias("status"), ctype.alias("content_type"))


@register(
    "payload_accept",
    """SELECT page_id, url, status, content_type,
              (status = 200 AND lower(coalesce(content_type, '')) NOT LIKE '%text/html%'
               AND ((url LIKE '%.csv' AND lower(coalesce(content_type, '')) LIKE '%csv%')
                    OR (url LIKE '%.zip' AND (lower(coalesce(content_type, '')) LIKE '%zip%'
                                              OR lower(coalesce(content_type, '')) LIKE '%octet-stream%'))
                    OR lower(coalesce(content_type, '')) NOT LIKE '%html%')) AS accepted
       FROM (SELECT page_id,
                    url || CASE page_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.zip' ELSE '' END AS url,
                    CAST(CASE WHEN page_id % 11 = 0 THEN 404 ELSE 200 END AS INTEGER) AS status,
                    CASE page_id % 6 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'text/csv'
                         WHEN 2 THEN 'application/zip' WHEN 3 THEN 'application/octet-stream'
                         WHEN 4 THEN 'application/xhtml+xml' ELSE NULL END AS content_type
             FROM pages)""",
)
def _payload(spark, sf_dir):
    log = _fetch_log(spark, sf_dir)
    return log.withColumn("accepted", M.accept_payload("url", "status", "content_type"))


def _manifest(spark, sf_dir):
    """URL manifest from pages without query and fragment; every fifth entry is listed again further down."""
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    once = p.select(F.regexp_replace("url", "[?#].*$", "").alias("url"), F.col("page_id").alias("pos"))
    return once.unionByName(once.where("pos % 5 = 2").withColumn("pos", F.col("pos") + 1_000_000))


_MANIFEST_SQL = """SELECT url, pos FROM (SELECT regexp_replace(url, '[?#].*$', '') AS url, page_id AS pos, page_id FROM pages)
                   UNION ALL SELECT regexp_replace(url, '[?#].*$', ''), page_id + 1000000 FROM pages WHERE page_id % 5 = 2"""


@register(
    "manifest_duplicates",
    f"""SELECT url, CAST(len(places) AS BIGINT) AS occurrences, list_min(places) AS first_pos
        FROM (SELECT url, list(pos) AS places FROM ({_MANIFEST_SQL}) GROUP BY url) WHERE len(places) > 1""",
)
def _manifest_dups(spark, sf_dir):
    return M.check_manifest(_manifest(spark, sf_dir))


@register(
    "manifest_dedup",
    f"SELECT url, pos FROM ({_MANIFEST_SQL}) QUALIFY ROW_NUMBER() OVER (PARTITION BY url ORDER BY pos) = 1",
)
def _manifest_dedup(spark, sf_dir):
    return M.dedup_manifest(_manifest(spark, sf_dir))


@register(
    "manifest_reconcile",
    f"""SELECT 'missing' AS side, url FROM ({_MANIFEST_SQL}) WHERE pos % 7 = 0
        UNION ALL SELECT 'extra', regexp_replace(url, '[?#].*$', '') || '.new' FROM pages WHERE page_id % 11 = 3""",
)
def _reconcile(spark, sf_dir):
    """The manifest against what landed: every seventh entry is absent, some files are not in the list."""
    expected = _manifest(spark, sf_dir)
    landed = expected.where("pos % 7 <> 0").select("url")
    unknown = expected.where("pos < 1000000 and pos % 11 = 3").select(F.concat("url", F.lit(".new")).alias("url"))
    missing, extra = M.reconcile(expected.select("url"), landed.unionByName(unknown))
    return missing.select(F.lit("missing").alias("side"), "url").unionByName(extra.select(F.lit("extra").alias("side"), "url"))


@register(
    "pending_files",
    """SELECT page_id, 'hdfs://lake:8020/bronze/' || page_id || '.csv' AS target FROM pages
       WHERE page_id % 4 = 1 OR page_id % 9 = 0""",
)
def _pending(spark, sf_dir):
    """Listed files under another scheme and authority; a quarter never landed, every ninth is empty."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id")
    place = F.concat(F.lit("/bronze/"), F.col("page_id").cast("string"), F.lit(".csv"))
    manifest = pages.select("page_id", F.concat(F.lit("hdfs://lake:8020"), place).alias("target"))
    listing = pages.where("page_id % 4 <> 1").select(
        F.concat(F.when(F.col("page_id") % 2 == 0, "file:").otherwise("hdfs://other"), place).alias("path"),
        F.when(F.col("page_id") % 9 == 0, 0).otherwise(10).alias("length"),
    )
    return M.pending_files(manifest, listing)


# ------------------------------------------ station history, checks, report

from postolake.operators import checks as C  # noqa: E402
from postolake.operators import scd2 as H  # noqa: E402
from postolake.operators.gold import gold_input  # noqa: E402

_HIST_COLS = ["posto_id", "cnpj_revenda", *H.VERSION_ATTRIBUTES, "data_inicio", "data_fim", "ativo", "versao"]


def _history_input(spark, sf_dir):
    """Silver rows plus a second brand on the same day for the stations of March (NULL where the brand was known)."""
    g = gold_input(demo_lake(spark, sf_dir).silver)
    other = F.when(F.col("bandeira").isNull(), F.lit("AAA")).otherwise(F.lit(None).cast("string"))
    return g.unionByName(g.where("mes = 3").withColumn("bandeira", other))


@register("dim_posto_scd2", O.with_lake(f"SELECT {', '.join(_HIST_COLS)} FROM history", "history"))
def _scd2(spark, sf_dir):
    return H.station_history(_history_input(spark, sf_dir)).select(*_HIST_COLS)


@register(
    "scd2_ranges",
    O.with_lake(
        """SELECT COUNT(DISTINCT (cnpj_revenda, versao)) AS versions, CAST(0 AS BIGINT) AS inverted, CAST(0 AS BIGINT) AS overlapping,
                  COUNT(DISTINCT cnpj_revenda) AS open_versions FROM history""",
        "history",
    ),
)
def _scd2_ranges(spark, sf_dir):
    """No version ends before it starts, none overlaps the next, one is open per station."""
    h = H.station_history(_history_input(spark, sf_dir))
    following = h.select("cnpj_revenda", (F.col("versao") - 1).alias("versao"), F.col("data_inicio").alias("next_start"))
    return h.join(following, ["cnpj_revenda", "versao"], "left").agg(
        F.count("*").alias("versions"),
        F.count_if(F.col("data_fim") < F.col("data_inicio")).alias("inverted"),
        F.count_if(F.coalesce("data_fim", F.lit("9999-12-31").cast("date")) >= F.col("next_start")).alias("overlapping"),
        F.count_if("ativo").alias("open_versions"),
    )


@register(
    "fact_asof_posto",
    O.with_lake(
        """SELECT data_id, produto_id, localidade_id, posto_id, valor_venda, valor_compra
           FROM (SELECT r.*, h.posto_id, ROW_NUMBER() OVER (PARTITION BY r.rid ORDER BY h.data_inicio DESC) AS latest
                 FROM (SELECT *, ROW_NUMBER() OVER () AS rid FROM gh) r
                 JOIN history h ON h.cnpj_revenda = r.cnpj_revenda AND h.data_inicio <= r.data_coleta)
           JOIN (SELECT data AS data_coleta, data_id FROM dim_data) USING (data_coleta)
           JOIN dim_produto USING (produto, unidade_medida)
           JOIN dim_localidade USING (regiao_sigla, estado_sigla, municipio)
           WHERE latest = 1""",
        "history",
    ),
)
def _asof(spark, sf_dir):
    gd = demo_lake(spark, sf_dir).star
    g = _history_input(spark, sf_dir)
    fact = H.build_fact_asof(g, gd.dim_data, gd.dim_produto, gd.dim_localidade, H.station_history(g))
    return fact.select(*_FACT_COLS)


@register(
    "load_report",
    O.with_lake(
        """SELECT n AS silver_rows, stored AS fact_rows, n - stored AS rejected_rows, CAST(0 AS BIGINT) AS unexplained_rows,
                  no_day AS missing_data, no_product AS missing_produto, no_place AS missing_localidade, no_station AS missing_posto
           FROM (SELECT COUNT(*) AS n, SUM(CAST(data_coleta IS NULL AS BIGINT))::BIGINT AS no_day,
                        SUM(CAST(produto || unidade_medida IS NULL AS BIGINT))::BIGINT AS no_product,
                        SUM(CAST(regiao_sigla || estado_sigla || municipio IS NULL AS BIGINT))::BIGINT AS no_place,
                        SUM(CAST(cnpj_revenda IS NULL AS BIGINT))::BIGINT AS no_station FROM g),
                (SELECT COUNT(*) AS stored FROM sales)"""
    ),
)
def _load_report(spark, sf_dir):
    lake = demo_lake(spark, sf_dir)
    return C.load_report(gold_input(lake.silver), lake.gold.fact)


def _repeats(table: str, columns: str) -> str:
    return f"SELECT COUNT(*) - COUNT(DISTINCT ({columns})) AS violations FROM {table}"


_KEYS = {
    "dim_data": ("data_id", "data"),
    "dim_produto": ("produto_id", "produto, unidade_medida"),
    "dim_localidade": ("localidade_id", "regiao_sigla, estado_sigla, municipio"),
    "dim_posto": ("posto_id", "cnpj_revenda, revenda, bandeira, nome_rua, numero_rua, complemento, bairro, cep"),
}


def _key_check_sql(tables: dict[str, str]) -> str:
    """Violations counted in the oracle's own tables; ``tables`` maps a name to the relation to check."""
    parts = []
    for name, (key, natural) in _KEYS.items():
        parts.append(("primary_key_unique", name, _repeats(tables[name], key)))
        parts.append(("natural_key_unique", name, _repeats(tables[name], natural)))
        parts.append(
            ("foreign_key_exists", name, f"SELECT COUNT(*) AS violations FROM {tables['fact']} WHERE {key} NOT IN (SELECT {key} FROM {tables[name]})")
        )
    parts.append(("primary_key_unique", "fact_precos_combustivel", _repeats(tables["fact"], "fato_id")))
    return " UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", CAST(violations AS BIGINT) AS violations FROM ({sql})"
        for check, table, sql in parts
    )


_NUMBERED_FACT = "(SELECT *, ROW_NUMBER() OVER () AS fato_id FROM fact)"


@register("key_checks", O.with_lake(_key_check_sql({n: n for n in _KEYS} | {"fact": _NUMBERED_FACT})))
def _key_checks(spark, sf_dir):
    return C.key_checks(_gold(spark, sf_dir))


@register(
    "key_checks_broken",
    O.with_lake(
        _key_check_sql(
            {
                "dim_data": "(SELECT * FROM dim_data WHERE mes <> 2)",
                "dim_produto": "(SELECT * FROM dim_produto UNION ALL SELECT * FROM dim_produto WHERE produto = 'GNV')",
                "dim_localidade": "(SELECT localidade_id + 1000000 AS localidade_id, regiao_sigla, estado_sigla, municipio "
                "FROM dim_localidade WHERE estado_sigla = 'SP' UNION ALL SELECT * FROM dim_localidade)",
                "dim_posto": "(SELECT * FROM dim_posto WHERE posto_id % 3 <> 0)",
                "fact": "(SELECT *, ROW_NUMBER() OVER () AS fato_id FROM fact UNION ALL "
                "SELECT *, -1 FROM fact WHERE data_id <= 5 UNION ALL SELECT *, -1 FROM fact WHERE data_id <= 5)",
            }
        )
    ),
)
def _key_checks_broken(spark, sf_dir):
    """G9 on a gold with lost days and stations, a doubled product, a doubled place name and
    the facts of the first five days twice more under one id."""
    gd = _gold(spark, sf_dir)
    sp = gd.dim_localidade.where("estado_sigla = 'SP'").withColumn("localidade_id", F.col("localidade_id") + 1_000_000)
    days = gd.dim_data.where("mes <> 2")
    again = gd.fact.where("data_id <= 5").withColumn("fato_id", F.lit(-1).cast("long"))
    broken = dataclasses.replace(
        gd,
        dim_data=days,
        dim_produto=gd.dim_produto.unionByName(gd.dim_produto.where("produto = 'GNV'")),
        dim_localidade=gd.dim_localidade.unionByName(sp),
        dim_posto=gd.dim_posto.where("posto_id % 3 <> 0"),
        fact=gd.fact.unionByName(again).unionByName(again),
    )
    return C.key_checks(broken)


# ---------------------------------------------------------------- SQL API

from postolake.plans.sql_api import register_gold_views, register_sql_functions  # noqa: E402


@register("sql_bi_02_price_by_state", O.with_lake(_B2_SQL))
def _sql_b2(spark, sf_dir):
    """B2 written in Spark SQL against the gold views."""
    register_gold_views(spark, _gold(spark, sf_dir), prefix="pl_")
    return spark.sql(
        """SELECT l.estado_sigla, p.produto,
                  CAST(round(sum(CAST(f.valor_venda AS DECIMAL(24,6)))::DECIMAL(24,6)
                             / count(f.valor_venda)::DECIMAL(14,0), 3) AS DOUBLE) AS preco_medio_venda,
                  count(*) AS total_coletas
           FROM pl_fact_precos_combustivel f
           JOIN pl_dim_localidade l ON f.localidade_id = l.localidade_id
           JOIN pl_dim_produto p ON f.produto_id = p.produto_id
           GROUP BY l.estado_sigla, p.produto
           ORDER BY l.estado_sigla, p.produto"""
    )


@register(
    "sql_clean_functions",
    O.with_lake(
        f"""SELECT "Municipio" AS raw_city, UPPER(TRIM("Municipio")) AS city,
                   REGEXP_REPLACE("CNPJ da Revenda", '\\D', '', 'g') AS cnpj,
                   TRY_CAST(REPLACE(REPLACE("Valor de Venda", '.', ''), ',', '.') AS DOUBLE) AS venda,
                   {O._SAFE_DATE.format(c='"Data da Coleta"')} AS data,
                   CAST(COUNT(*) AS BIGINT) AS n
            FROM bronze GROUP BY ALL""",
        "bronze",
    ),
)
def _sql_clean(spark, sf_dir):
    """The cleaning rules as SQL functions over a bronze view."""
    register_sql_functions(spark)
    _bronze(spark, sf_dir).createOrReplaceTempView("pl_bronze")
    return spark.sql(
        """SELECT `Municipio` AS raw_city, clean_text(`Municipio`) AS city,
                  digits_only(`CNPJ da Revenda`) AS cnpj, br_decimal(`Valor de Venda`) AS venda,
                  safe_date(`Data da Coleta`) AS data, count(*) AS n
           FROM pl_bronze GROUP BY ALL"""
    )


@register(
    "fact_chunks",
    O.with_lake(
        """SELECT CAST(c AS BIGINT) AS chunk, CAST(c * 700 + 1 AS BIGINT) AS first_id,
                  LEAST(CAST((c + 1) * 700 AS BIGINT), n) AS last_id, LEAST(CAST((c + 1) * 700 AS BIGINT), n) - CAST(c * 700 AS BIGINT) AS n
           FROM (SELECT unnest(range(CAST(CEIL(n / 700.0) AS BIGINT))) AS c, n FROM (SELECT COUNT(*) AS n FROM fact))"""
    ),
)
def _fact_chunks(spark, sf_dir):
    """K7: the load's id chunks as a parameterised SQL report (700 ids a chunk, so there are many)."""
    fact = _gold(spark, sf_dir).fact
    return spark.sql(
        """SELECT CAST((fato_id - 1) DIV :chunk AS BIGINT) AS chunk, min(fato_id) AS first_id,
                  max(fato_id) AS last_id, count(*) AS n
           FROM {fact} GROUP BY 1""",
        args={"chunk": 700},
        fact=fact,
    )


@register(
    "fact_id_range",
    O.with_lake("SELECT CAST(701 + k AS BIGINT) AS fato_id FROM (SELECT unnest(range(700)) AS k) WHERE 701 + k <= (SELECT COUNT(*) FROM fact)"),
)
def _fact_range(spark, sf_dir):
    """F8: one chunk of the load, selected by a BETWEEN with bound ids."""
    return spark.sql(
        "SELECT fato_id FROM {fact} WHERE fato_id BETWEEN :first AND :last",
        args={"first": 701, "last": 1400},
        fact=_gold(spark, sf_dir).fact,
    )
