"""Bronze-like survey rows derived from the TPC-H-style driver tables.

Every line item becomes one raw price observation with 16 dirty text fields
(case, padding, NBSP, mixed date formats, Brazilian numbers, blanks, values
outside the quality domains, brand changes over time). Line items with
``l_linenumber = 1`` are emitted a second time with other case/padding from a
file called ``copy.csv`` (duplicates), and the five ``region`` rows give
all-blank rows. The frame has the raw CSV header names plus ``filename``,
exactly as the CSV source returns it.

The same rules are written in DuckDB SQL in ``postolake.plans.oracle``; they
use integer arithmetic and zero-padded text only, so both engines print the
same strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postolake.constants import BRONZE_HEADERS, VALID_STATES
from postolake.operators.broadcast import checked_broadcast

NBSP = "\u00a0"


def _s(c: Column) -> Column:
    return c.cast("string")


def money_text(cents: Column) -> Column:
    """Integer cents -> '1.234,56' (thousands dot, decimal comma)."""
    units = F.floor(cents / 100).cast("bigint")
    frac = F.lpad(_s(cents % 100), 2, "0")
    int_text = F.when(
        units >= 1000,
        F.concat(_s(F.floor(units / 1000).cast("bigint")), F.lit("."), F.lpad(_s(units % 1000), 3, "0")),
    ).otherwise(_s(units))
    return F.concat(int_text, F.lit(","), frac)


def _dirty_columns(v: Column) -> dict[str, Column]:
    """The 16 raw fields; ``v`` is the variant selector (case/padding only)."""
    sk = F.col("l_suppkey")
    ok = F.col("l_orderkey")
    ship = F.col("l_shipdate").cast("date")
    yr, mo, dy = F.year(ship), F.month(ship), F.dayofmonth(ship)

    region_code = (
        F.when(F.col("r_regionkey") == 0, "N")
        .when(F.col("r_regionkey") == 1, "NE")
        .when(F.col("r_regionkey") == 2, "CO")
        .when(F.col("r_regionkey") == 3, "SE")
        .otherwise("S")
    )
    regiao = (
        F.when(sk % 17 == 3, F.col("r_name"))
        .when(v % 3 == 0, F.concat(F.lit(" "), F.lower(region_code), F.lit("  ")))
        .otherwise(region_code)
    )

    uf = F.element_at(F.array(*[F.lit(s) for s in VALID_STATES]), (F.col("n_nationkey") + 1).cast("int"))
    estado = (
        F.when(ok % 211 == 0, F.lit(None).cast("string"))
        .when(sk % 19 == 7, F.lit("XX"))
        .when(v % 4 == 1, F.lower(uf))
        .otherwise(uf)
    )

    city = F.concat(F.lit("cidade "), F.lower(F.col("n_name")), F.lit("-"), _s(sk % 7))
    municipio = (
        F.when(v % 5 == 2, F.concat(F.lit("  "), city, F.lit(" ")))
        .when(v % 5 == 4, F.concat(F.lit(NBSP), F.upper(city)))
        .otherwise(city)
    )

    revenda = F.when(v % 2 == 0, F.concat(F.lower(F.col("s_name")), F.lit(" "))).otherwise(F.col("s_name"))

    cnpj_digits = F.lpad(_s(sk * 7919 + 11), 14, "0")
    cnpj = F.when(ok % 223 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(
            F.substring(cnpj_digits, 1, 2), F.lit("."), F.substring(cnpj_digits, 3, 3), F.lit("."),
            F.substring(cnpj_digits, 6, 3), F.lit("/"), F.substring(cnpj_digits, 9, 4), F.lit("-"),
            F.substring(cnpj_digits, 13, 2),
        )
    )

    street = F.concat(F.lit("rua "), _s(sk % 50))
    nome_rua = F.when(v % 2 == 1, F.upper(street)).otherwise(street)
    number = _s(sk * 13 % 2000)
    numero_rua = F.when(v % 2 == 1, F.concat(F.lit(" "), number, F.lit(" "))).otherwise(number)
    complemento = (
        F.when(sk % 5 == 0, F.lit(None).cast("string"))
        .when(sk % 5 == 1, F.lit("   "))
        .otherwise(F.concat(F.lit("loja "), _s(sk % 3)))
    )
    bairro = F.concat(F.lit("bairro "), _s(sk % 11))
    cep_digits = F.lpad(_s(sk * 104729 % 100000000), 8, "0")
    cep = F.concat(F.substring(cep_digits, 1, 5), F.lit("-"), F.substring(cep_digits, 6, 3))

    ptype = F.col("p_type")
    product = (
        F.when(ptype == "ECONOMY", "GASOLINA")
        .when(ptype == "STANDARD", "ETANOL")
        .when(ptype == "LARGE", "DIESEL")
        .when(ptype == "MEDIUM", "DIESEL S10")
        .when(ptype == "SMALL", "GNV")
        .when(sk % 23 == 0, "QUEROSENE")
        .otherwise("GASOLINA ADITIVADA")
    )
    produto = F.when(v % 3 == 1, F.concat(F.lower(product), F.lit(" "))).otherwise(product)

    unidade = (
        F.when(ok % 151 == 0, F.lit("R$ / galao"))
        .when((product == "GNV") & (ok % 2 == 0), F.lit("R$ / m³"))
        .when(product == "GNV", F.lit("R$ / m3"))
        .otherwise(F.lit("R$ / litro"))
    )

    d2, m2 = F.lpad(_s(dy), 2, "0"), F.lpad(_s(mo), 2, "0")
    y4 = F.lpad(_s(yr), 4, "0")
    data = (
        F.when(ok % 97 == 0, F.lit(None).cast("string"))
        .when(ok % 101 == 0, F.lit("31/02/2000"))
        .when(ok % 103 == 0, F.lit("  "))
        .when(v % 2 == 0, F.concat_ws("-", y4, m2, d2))
        .when(v % 3 == 0, F.concat_ws("/", _s(dy), _s(mo), y4))
        .when(v % 5 == 1, F.concat(F.lit(" "), F.concat_ws("/", d2, m2, y4), F.lit(" ")))
        .otherwise(F.concat_ws("/", d2, m2, y4))
    )

    total_cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    sale_cents = F.floor(total_cents / F.col("l_quantity").cast("bigint")).cast("bigint")
    sale_plain = F.concat(_s(F.floor(sale_cents / 100).cast("bigint")), F.lit("."), F.lpad(_s(sale_cents % 100), 2, "0"))
    venda = (
        F.when(ok % 89 == 0, F.lit("n/d"))
        .when(ok % 113 == 0, sale_plain)
        .otherwise(money_text(sale_cents))
    )
    buy_cents = F.floor(F.round(F.col("p_retailprice") * 100).cast("bigint") * 9 / 10).cast("bigint")
    compra = F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string")).otherwise(money_text(buy_cents))

    brand_base = (
        F.when(sk % 6 == 0, "ipiranga")
        .when(sk % 6 == 1, "RAIZEN")
        .when(sk % 6 == 2, "vibra energia")
        .when(sk % 6 == 3, "BRANCA")
        .when(sk % 6 == 4, F.lit(None).cast("string"))
        .otherwise(F.lit("  "))
    )
    brand = (
        F.when((sk % 8 == 0) & yr.isin(1998, 1999), F.lit("shell"))
        .when((sk % 4 == 1) & (yr >= 2000), F.lit("ALESAT"))
        .otherwise(brand_base)
    )
    bandeira = F.when(v % 2 == 1, F.upper(brand)).otherwise(brand)

    return {
        "Regiao - Sigla": regiao,
        "Estado - Sigla": estado,
        "Municipio": municipio,
        "Revenda": revenda,
        "CNPJ da Revenda": cnpj,
        "Nome da Rua": nome_rua,
        "Numero Rua": numero_rua,
        "Complemento": complemento,
        "Bairro": bairro,
        "Cep": cep,
        "Produto": produto,
        "Data da Coleta": data,
        "Valor de Venda": venda,
        "Valor de Compra": compra,
        "Unidade de Medida": unidade,
        "Bandeira": bandeira,
    }


def _file_name() -> Column:
    ship = F.col("l_shipdate").cast("date")
    semester = F.when(F.month(ship) <= 6, F.lit("1")).otherwise(F.lit("2"))
    return F.concat(F.lit("ca-"), _s(F.year(ship)), F.lit("-0"), semester, F.lit(".csv"))


def demo_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw survey frame (16 header-named text columns + filename)."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    li = read("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate",
    )
    # A small line-item file can arrive as a single split; spread it over the
    # cores so everything downstream runs in parallel. Large inputs already
    # have enough splits and are left alone (no extra shuffle).
    cores = spark.sparkContext.defaultParallelism
    if li.rdd.getNumPartitions() < cores:
        li = li.repartition(cores)
    # Dimension-sized tables: part and supplier grow with the scale factor but
    # stay far below the line items; AQE decides broadcast from runtime size.
    part = read("part").select("p_partkey", "p_type", "p_retailprice")
    supplier = read("supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read("nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read("region").select("r_regionkey", "r_name")

    rows = (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(supplier, li.l_suppkey == supplier.s_suppkey)
        .join(checked_broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(checked_broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    )

    # One pass: every line item once, and line 1 a second time as a copy.
    copies = F.when(F.col("l_linenumber") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    tagged = rows.withColumn("_copy", F.explode(copies))
    cols = _dirty_columns(F.col("l_linenumber") + F.col("_copy"))
    filename = F.when(F.col("_copy") == 1, F.lit("copy.csv")).otherwise(_file_name())
    observed = tagged.select(*[cols[h].alias(h) for h in BRONZE_HEADERS], filename.alias("filename"))
    blanks = region.select(
        *[
            F.when(F.col("r_regionkey") == 0, F.lit("  ")).otherwise(F.lit(None).cast("string")).alias(h)
            for h in BRONZE_HEADERS
        ],
        F.lit("blank.csv").alias("filename"),
    )
    return observed.unionByName(blanks)
