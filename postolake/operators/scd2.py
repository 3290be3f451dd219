"""Type-2 history of stations, and the as-of fact that uses it.

The source system declares ``data_inicio``, ``data_fim`` and ``ativo`` on
the station dimension but never fills them; this completes it.

1. Pre-aggregate: one row per (CNPJ, day). A day has one version: of several
   attribute sets on the same day the smallest counts (attribute by attribute,
   NULLs first), so no version can end before it starts. However many rows a
   station has, this is bounded by calendar days and combined map-side — a
   station holding a third of all rows still reaches the window below as a few
   thousand rows.
2. Per CNPJ, ordered by day: a change flag where any attribute differs
   (NULL-safe) from the previous day; a running sum numbers versions.
3. One row per version: first day = ``data_inicio``; the next version's first
   day minus one = ``data_fim``; the open version is ``ativo``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postolake.operators.broadcast import checked_broadcast
from postolake.operators.gold import FACT_KEYS
from postolake.operators.surrogate import dense_ids, rank_ids
from postolake.session import ensure_checkpoint_dir

VERSION_ATTRIBUTES = ["revenda", "bandeira", "nome_rua", "numero_rua", "complemento", "bairro", "cep"]
SLICE_ROWS = 1_000_000


def station_history(g: DataFrame) -> DataFrame:
    daily = (
        g.filter(F.col("cnpj_revenda").isNotNull() & F.col("data_coleta").isNotNull())
        .groupBy("cnpj_revenda", "data_coleta")
        .agg(F.min(F.struct(*VERSION_ATTRIBUTES)).alias("a"))
        .select("cnpj_revenda", "data_coleta", "a.*")
    )
    w = Window.partitionBy("cnpj_revenda").orderBy("data_coleta")
    differs = reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.lag(c).over(w)) for c in VERSION_ATTRIBUTES]
    )
    flagged = daily.withColumn(
        "_change", F.when((F.row_number().over(w) == 1) | differs, 1).otherwise(0)
    ).withColumn("version", F.sum("_change").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    versions = flagged.groupBy("cnpj_revenda", "version", *VERSION_ATTRIBUTES).agg(
        F.min("data_coleta").alias("data_inicio")
    )
    nxt = Window.partitionBy("cnpj_revenda").orderBy("version")
    ensure_checkpoint_dir(g.sparkSession)
    # the ranking reads its input twice: ranges, then rows
    dated = versions.withColumn("data_fim", F.date_sub(F.lead("data_inicio").over(nxt), 1)).checkpoint()
    ided = rank_ids(
        dated,
        [F.col("cnpj_revenda").asc(), F.col("data_inicio").asc(), F.col("version").asc()],
        "posto_id",
    )
    return ided.select(
        F.col("posto_id").cast("int"),
        "cnpj_revenda",
        *VERSION_ATTRIBUTES,
        "data_inicio",
        "data_fim",
        F.col("data_fim").isNull().alias("ativo"),
        F.col("version").cast("int").alias("versao"),
    )


def carry_versions(
    facts: DataFrame, history: DataFrame, slice_rows: int = SLICE_ROWS, stations: DataFrame | None = None
) -> DataFrame:
    """As-of join by one sorted scan: each fact gets the ``posto_id`` valid on its ``data_coleta``.

    Facts and versions are put together, sorted by station and day, and the last
    version seen is carried forward, so the rows in between are facts + versions
    however many versions a station has. A station of more than ``slice_rows``
    facts is cut into slices by a hash of the fact, each of which gets the
    station's versions; that also cuts a station whose facts lie on one day. Facts
    before a station's first version, or of a station without any, are left out.
    ``stations`` gives the station of each fact where that is read more cheaply
    than from ``facts``, for the count that finds the stations to cut.
    """
    counts = (facts if stations is None else stations).groupBy("cnpj_revenda").agg(F.count(F.lit(1)).alias("n"))
    cut = F.ceil(F.col("n") / slice_rows).cast("int")
    ensure_checkpoint_dir(facts.sparkSession)
    # one row for each slice_rows facts at most
    hot = counts.where(F.col("n") > slice_rows).select("cnpj_revenda", cut.alias("_slices")).checkpoint()
    hot = checked_broadcast(hot)
    slices = F.coalesce("_slices", F.lit(1))
    rows = facts.join(hot, "cnpj_revenda", "left")
    rows = rows.select(
        "cnpj_revenda",
        F.pmod(F.xxhash64("fato_id"), slices).cast("int").alias("_slice"),
        F.col("data_coleta").alias("_day"),
        F.lit(True).alias("_is_fact"),
        F.struct(*[c for c in facts.columns if c != "cnpj_revenda"]).alias("_fact"),
        F.lit(None).cast("int").alias("_version"),
    )
    versions = history.where("cnpj_revenda is not null").join(hot, "cnpj_revenda", "left").select(
        "cnpj_revenda",
        F.explode(F.sequence(F.lit(0), slices - 1)).alias("_slice"),
        F.col("data_inicio").alias("_day"),
        F.lit(False).alias("_is_fact"),
        F.lit(None).cast(rows.schema["_fact"].dataType).alias("_fact"),
        F.col("posto_id").cast("int").alias("_version"),
    )
    scan = Window.partitionBy("cnpj_revenda", "_slice").orderBy("_day", "_is_fact")
    scan = scan.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = rows.unionByName(versions).withColumn("posto_id", F.last("_version", ignorenulls=True).over(scan))
    return carried.where("_is_fact and posto_id is not null").select("cnpj_revenda", "_fact.*", "posto_id")


def build_fact_asof(
    g: DataFrame,
    dim_data: DataFrame,
    dim_produto: DataFrame,
    dim_localidade: DataFrame,
    history: DataFrame,
) -> DataFrame:
    """Fact whose station id is the version valid on the collection day."""
    matched = g.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in FACT_KEYS]))
    ided = dense_ids(matched.select(*FACT_KEYS, "valor_venda", "valor_compra"), "fato_id")
    joined = (
        ided.join(checked_broadcast(dim_data.select(F.col("data").alias("data_coleta"), "data_id")), "data_coleta")
        .join(checked_broadcast(dim_produto), ["produto", "unidade_medida"])
        .join(checked_broadcast(dim_localidade), ["regiao_sigla", "estado_sigla", "municipio"])
    )
    narrow = joined.select(
        "cnpj_revenda", "data_coleta", "fato_id", "data_id", "produto_id", "localidade_id", "valor_venda", "valor_compra"
    )
    # the dimensions hold every key, so a station has as many facts as rows before the joins
    carried = carry_versions(narrow, history, stations=matched.select("cnpj_revenda"))
    return carried.select(
        "fato_id", "data_id", "produto_id", "localidade_id", "posto_id", "valor_venda", "valor_compra"
    )
