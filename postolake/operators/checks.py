"""G8 load report and G9 key constraints, as DataFrames.

Parquet tables do not enforce keys, so the constraints of the star schema
are checked by queries; each check is one scan with broadcast joins against
dimensions (behind a size check) and map-side combined counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postolake.operators.broadcast import checked_broadcast
from postolake.operators.gold import FACT_KEYS, Gold

_DIM_KEYS = {
    "dim_data": ("data_id", ["data"]),
    "dim_produto": ("produto_id", ["produto", "unidade_medida"]),
    "dim_localidade": ("localidade_id", ["regiao_sigla", "estado_sigla", "municipio"]),
    "dim_posto": ("posto_id", ["cnpj_revenda", "revenda", "bandeira", "nome_rua", "numero_rua",
                               "complemento", "bairro", "cep"]),
}


def load_report(g: DataFrame, fact: DataFrame) -> DataFrame:
    """Silver rows, rows of the written fact, and losses per dimension.

    ``fact`` is the stored fact table; its rows are counted, not inferred.
    ``rejected_rows`` are silver rows without a full set of keys, so
    ``unexplained_rows`` (silver - fact - rejected) is 0 unless the load lost
    or repeated rows.
    """
    def null_any(cols):
        return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])

    all_keys = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in FACT_KEYS])
    silver = g.agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.count_if(~all_keys).alias("rejected_rows"),
        F.count_if(F.col("data_coleta").isNull()).alias("missing_data"),
        F.count_if(null_any(["produto", "unidade_medida"])).alias("missing_produto"),
        F.count_if(null_any(["regiao_sigla", "estado_sigla", "municipio"])).alias("missing_localidade"),
        F.count_if(F.col("cnpj_revenda").isNull()).alias("missing_posto"),
    )
    stored = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
    both = silver.withColumn("_one", F.lit(1)).join(stored.withColumn("_one", F.lit(1)), "_one")  # one row each
    return both.select(
        "silver_rows",
        "fact_rows",
        "rejected_rows",
        (F.col("silver_rows") - F.col("fact_rows") - F.col("rejected_rows")).alias("unexplained_rows"),
        "missing_data",
        "missing_produto",
        "missing_localidade",
        "missing_posto",
    )


def _dim_checks(name: str, dim: DataFrame) -> DataFrame:
    key, natural = _DIM_KEYS[name]
    per_natural = dim.groupBy(*natural).agg(F.count(F.lit(1)).alias("n"))
    per_key = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    dup_natural = per_natural.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("v"))
    dup_key = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("v"))
    return dup_key.select(F.lit("primary_key_unique").alias("check"), F.lit(name).alias("table"), F.col("v").alias("violations")).unionByName(
        dup_natural.select(F.lit("natural_key_unique").alias("check"), F.lit(name).alias("table"), F.col("v").alias("violations"))
    )


def key_checks(gold: Gold) -> DataFrame:
    """Duplicate ids / natural keys per dimension; fact orphans per FK."""
    frames = [_dim_checks(n, getattr(gold, n)) for n in _DIM_KEYS]
    fact = gold.fact.select("fato_id", "data_id", "produto_id", "localidade_id", "posto_id")
    probes = fact
    for name, (key, _) in _DIM_KEYS.items():
        # distinct: a doubled dimension id must not multiply fact rows
        present = getattr(gold, name).select(F.col(key).alias(f"_{key}"), F.lit(True).alias(f"_in_{name}")).distinct()
        probes = probes.join(checked_broadcast(present), F.col(key) == F.col(f"_{key}"), "left")
    orphans = probes.agg(
        *[F.count_if(F.col(f"_in_{n}").isNull()).cast("bigint").alias(n) for n in _DIM_KEYS],
        (F.count(F.lit(1)) - F.count_distinct("fato_id")).cast("bigint").alias("fact_pk"),
    )
    fk_rows = orphans.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit("foreign_key_exists").alias("check"), F.lit(n).alias("table"), F.col(n).alias("violations"))
                    for n in _DIM_KEYS
                ],
                F.struct(F.lit("primary_key_unique").alias("check"), F.lit("fact_precos_combustivel").alias("table"),
                         F.col("fact_pk").alias("violations")),
            )
        )
    )
    return reduce(DataFrame.unionByName, frames + [fk_rows])
