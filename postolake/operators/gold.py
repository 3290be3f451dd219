"""Silver -> gold star schema: four dimensions and the price fact.

* Gold text is ``nullif(x, '')`` with NUL characters removed, as the source
  system's bulk load produces.
* Dimensions are ``distinct`` projections of silver; ids are the rank of the
  natural key (NULLs first), computed distributed (``rank_ids``).
* Stations collapse to one id per CNPJ: the lowest ``posto_id``.
* The fact keeps every silver row whose seven join keys are non-NULL — exactly
  the rows an inner star join keeps, since each dimension holds every non-NULL
  key. Ids are assigned on that filtered scan before the joins, then the
  dimensions are joined: broadcast when their row count is under a checked
  bound, shuffle join (with AQE skew splitting) otherwise.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postolake.constants import POSTO_ATTRIBUTES, SILVER_TEXT_COLUMNS
from postolake.functions import blank_to_null, strip_nul
from postolake.operators.broadcast import BROADCAST_ROW_LIMIT, checked_broadcast
from postolake.operators.surrogate import dense_ids, rank_ids

__all__ = [
    "BROADCAST_ROW_LIMIT", "FACT_KEYS", "Gold", "build_dim_data", "build_dim_localidade",
    "build_dim_posto", "build_dim_produto", "build_fact", "build_gold", "build_posto_lookup",
    "checked_broadcast", "gold_input",
]


FACT_KEYS = [
    "data_coleta", "produto", "unidade_medida", "regiao_sigla", "estado_sigla",
    "municipio", "cnpj_revenda",
]


@dataclass
class Gold:
    dim_data: DataFrame
    dim_produto: DataFrame
    dim_localidade: DataFrame
    dim_posto: DataFrame
    posto_lookup: DataFrame
    fact: DataFrame | None
    _rows: dict = field(default_factory=dict, repr=False)

    def rows(self, name: str) -> int:
        """Row count of a dimension, counted once per Gold object."""
        if name not in self._rows:
            self._rows[name] = getattr(self, name).count()
        return self._rows[name]

    def dim(self, name: str, subset: DataFrame | None = None) -> DataFrame:
        """A dimension (or a filter/projection of it) ready to join.

        Broadcast only behind a size check: the base dimension's row count
        must be within BROADCAST_ROW_LIMIT; otherwise a shuffle join is used.
        """
        df = getattr(self, name) if subset is None else subset
        return F.broadcast(df) if self.rows(name) <= BROADCAST_ROW_LIMIT else df


def gold_input(silver: DataFrame) -> DataFrame:
    """Silver as the load sees it: '' -> NULL and NUL removed in text."""
    exprs = []
    for c in silver.columns:
        if c in SILVER_TEXT_COLUMNS:
            exprs.append(blank_to_null(strip_nul(c)).alias(c))
        else:
            exprs.append(F.col(c))
    return silver.select(*exprs)


def _asc(cols: list[str]):
    return [F.col(c).asc_nulls_first() for c in cols]


def build_dim_data(g: DataFrame) -> DataFrame:
    """G1: dim_data(data_id, data, ano, mes, trimestre); NULL dates excluded."""
    days = (
        g.filter(F.col("data_coleta").isNotNull())
        .select(F.col("data_coleta").alias("data"))
        .distinct()
        .select(
            "data",
            F.year("data").alias("ano"),
            F.month("data").alias("mes"),
            F.quarter("data").alias("trimestre"),
        )
    )
    out = rank_ids(days, _asc(["data"]), "data_id")
    return out.select(F.col("data_id").cast("int"), "data", "ano", "mes", "trimestre")


def build_dim_produto(g: DataFrame) -> DataFrame:
    """dim_produto(produto_id, produto, unidade_medida)."""
    pairs = g.select("produto", "unidade_medida").distinct()
    out = rank_ids(pairs, _asc(["produto", "unidade_medida"]), "produto_id")
    return out.select(F.col("produto_id").cast("int"), "produto", "unidade_medida")


def build_dim_localidade(g: DataFrame) -> DataFrame:
    """dim_localidade(localidade_id, regiao_sigla, estado_sigla, municipio)."""
    keys = ["regiao_sigla", "estado_sigla", "municipio"]
    places = g.select(*keys).distinct()
    out = rank_ids(places, _asc(keys), "localidade_id")
    return out.select(F.col("localidade_id").cast("int"), *keys)


def build_dim_posto(g: DataFrame) -> DataFrame:
    """dim_posto: distinct station attributes; validity left open, ativo."""
    versions = g.select(*POSTO_ATTRIBUTES).distinct()
    out = rank_ids(versions, _asc(POSTO_ATTRIBUTES), "posto_id")
    return out.select(
        F.col("posto_id").cast("int"),
        *POSTO_ATTRIBUTES,
        F.lit(None).cast("date").alias("data_inicio"),
        F.lit(None).cast("date").alias("data_fim"),
        F.lit(True).alias("ativo"),
    )


def build_posto_lookup(dim_posto: DataFrame) -> DataFrame:
    """One station id per CNPJ — the lowest (DISTINCT ON ... ORDER BY id).

    Like DISTINCT ON, NULL CNPJs form one group; its row never joins.
    """
    return dim_posto.groupBy("cnpj_revenda").agg(F.min("posto_id").alias("posto_id"))


def build_fact(g: DataFrame, gold: Gold, keep_year: bool = False) -> DataFrame:
    """fact_precos_combustivel.

    ``g`` must be a deterministic scan (written silver or a checkpoint) so the
    dense ``fato_id`` pass is repeatable. Dimensions come from ``gold`` and are
    broadcast behind its row-count check. ``keep_year`` keeps ``ano`` for a
    year-partitioned write.
    """
    matched = g.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in FACT_KEYS]))
    ided = dense_ids(
        matched.select(*FACT_KEYS, "valor_venda", "valor_compra", "ano"), "fato_id"
    )
    dd = gold.dim("dim_data", gold.dim_data.select(F.col("data").alias("data_coleta"), "data_id"))
    dp = gold.dim("dim_produto")
    dl = gold.dim("dim_localidade")
    po = gold.dim("dim_posto", gold.posto_lookup)
    joined = (
        ided.join(dd, "data_coleta")
        .join(dp, ["produto", "unidade_medida"])
        .join(dl, ["regiao_sigla", "estado_sigla", "municipio"])
        .join(po, "cnpj_revenda")
    )
    cols = [
        F.col("fato_id"), F.col("data_id"), F.col("produto_id"), F.col("localidade_id"),
        F.col("posto_id"), F.col("valor_venda"), F.col("valor_compra"),
    ]
    if keep_year:
        cols.append(F.col("ano"))
    return joined.select(*cols)


def build_gold(silver: DataFrame, keep_year: bool = False) -> Gold:
    """Whole gold build from a deterministic silver scan."""
    g = gold_input(silver)
    # The four dimensions are independent: their (small) jobs are submitted
    # from separate threads so the scheduler runs them side by side.
    builders = [build_dim_data, build_dim_produto, build_dim_localidade, build_dim_posto]
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        dim_data, dim_produto, dim_localidade, dim_posto = pool.map(lambda build: build(g), builders)
    gold = Gold(dim_data, dim_produto, dim_localidade, dim_posto, build_posto_lookup(dim_posto), fact=None)
    gold.fact = build_fact(g, gold, keep_year=keep_year)
    return gold
