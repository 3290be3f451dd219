"""Panels from mergeable partial states instead of the fact.

A ``Lattice`` is a folder of loads. A load holds, for the facts it was given,
exact partial states (decimal sums, counts, extremes) at the finest grain the
panels need and at three coarser levels rolled up from that grain, and bitmaps
of the cities seen on each day and of the members of the dimensions. States of
several loads add up and bitmaps are OR-ed, so a batch of new facts costs a scan
of that batch alone; the history's facts are not read again. A panel is answered
by the level with the fewest rows that holds its columns.

A load is written aside and moved to its place in one step, all levels at once.
``compact`` merges all loads into one whose name says what it covers; covered
loads are ignored from then on and removed by the next ``compact``. Loads must
hold different facts: the same facts added twice count twice.

Distinct counts do not add up, so they are kept as bitmaps over ids that outlive
reloads (``keymap``): the cities of any range of days are the set bits of the OR
of its days, one bit a city and day, and no fact is read.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postolake.constants import POSTO_ATTRIBUTES, UNBRANDED_LABEL
from postolake.functions import exact_percent, label_or_default, month_start, quarter_start
from postolake.operators.analytics import DateLike, _between
from postolake.operators.gold import Gold
from postolake.operators.keymap import KeyMap

_TIME, _PLACE = ["ano", "mes", "trimestre"], ["regiao_sigla", "estado_sigla", "municipio"]
LEVELS: dict[str, list[str]] = {
    "cell": [*_TIME, "produto", *_PLACE, "bandeira"],
    "month": [*_TIME, "produto"],
    "place": ["produto", *_PLACE],
    "brand": ["bandeira"],
}

# Which rows count, and the values summed over them.
_STATES = {
    "all": ["venda", "compra"],
    "positive": ["venda"],
    "both": ["venda", "compra", "margem"],
    "traded": ["venda", "compra", "margem"],
}
_SUM = "decimal(34,6)"


def _conditions() -> dict[str, Column]:
    sale, purchase = F.col("valor_venda"), F.col("valor_compra")
    both = sale.isNotNull() & purchase.isNotNull()
    return {"all": F.lit(True), "positive": sale > 0, "both": both, "traded": both & (sale > 0) & (purchase > 0)}


def _first_states() -> list[Column]:
    """Aggregates over facts."""
    sale, purchase = F.col("valor_venda"), F.col("valor_compra")
    values = {"venda": sale, "compra": purchase, "margem": sale - purchase}
    out = []
    for name, rows in _conditions().items():
        out.append(F.count_if(rows).alias(f"rows_{name}"))
        for v in _STATES[name]:
            exact = F.when(rows, values[v].cast("decimal(24,6)"))
            out += [F.sum(exact).cast(_SUM).alias(f"sum_{name}_{v}"), F.count(exact).alias(f"n_{name}_{v}")]
    return [*out, F.min("valor_venda").alias("min_venda"), F.max("valor_venda").alias("max_venda")]


def _merged_states() -> list[Column]:
    """The same aggregates over states."""
    out = []
    for name, values in _STATES.items():
        out.append(F.sum(f"rows_{name}").alias(f"rows_{name}"))
        for v in values:
            out.append(F.sum(f"sum_{name}_{v}").cast(_SUM).alias(f"sum_{name}_{v}"))
            out.append(F.sum(f"n_{name}_{v}").alias(f"n_{name}_{v}"))
    return [*out, F.min("min_venda").alias("min_venda"), F.max("max_venda").alias("max_venda")]


def _mean(value: str, rows: str = "all", digits: int = 3) -> Column:
    """``functions.exact_mean`` from its state."""
    total = F.col(f"sum_{rows}_{value}").cast("decimal(24,6)")
    count = F.col(f"n_{rows}_{value}").cast("decimal(14,0)")
    return F.round(total / F.nullif(count, F.lit(0).cast("decimal(14,0)")), digits).cast("double")


def _bitmaps(frame: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of ``member_id`` by ``by`` and bucket of 32,768 ids."""
    placed = frame.select(
        *by,
        F.bitmap_bucket_number("member_id").alias("bucket"),
        F.bitmap_bit_position("member_id").alias("position"),
    )
    return placed.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("position").alias("bits"))


def _set_bits(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Number of set bits by ``by`` of the OR of ``bitmaps``."""
    united = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


class Lattice:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._members = KeyMap(spark, f"{self.root}/members", ["kind", "member"], "member_id")
        self._rows: dict[tuple, int] = {}

    # ------------------------------------------------------------ loads

    def _all_loads(self) -> list[tuple[int, int]]:
        if not self._fs.exists(self._path(self.root)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.root))]
        return [tuple(int(x) for x in n[6:].split("-")) for n in names if n.startswith("loads=")]

    def loads(self) -> list[tuple[int, int]]:
        """(first, last) of the loads that count, ascending: none is covered by another."""
        counting: list[tuple[int, int]] = []
        for first, last in sorted(self._all_loads(), key=lambda r: (-r[1], r[0])):
            if not counting or last < counting[-1][0]:
                counting.append((first, last))
        return counting[::-1]

    def _folder(self, load: tuple[int, int]) -> str:
        return f"{self.root}/loads={load[0]:09d}-{load[1]:09d}"

    def _read(self, table: str) -> DataFrame:
        loads = self.loads()
        if not loads:
            raise ValueError(f"{self.root} has no load")
        return self.spark.read.parquet(*[f"{self._folder(r)}/{table}" for r in loads])

    def _commit(self, side: str, load: tuple[int, int]) -> None:
        target = self._path(self._folder(load))
        if self._fs.exists(target) or not self._fs.rename(self._path(side), target):
            self._fs.delete(self._path(side), True)
            raise RuntimeError(f"load {load[0]}-{load[1]} of {self.root} was committed by another writer")

    def _side(self) -> str:
        return f"{self.root}/_writing-{uuid.uuid4().hex}"

    def add(self, gold: Gold) -> None:
        """Add the facts of ``gold`` as a load; its dimensions must hold their members."""
        side = self._side()
        facts = gold.fact.drop("ano")
        days = gold.dim("dim_data", gold.dim_data.select("data_id", *_TIME))
        products = gold.dim("dim_produto", gold.dim_produto.select("produto_id", "produto"))
        places = gold.dim("dim_localidade", gold.dim_localidade.select("localidade_id", *_PLACE))
        stations = gold.dim("dim_posto", gold.dim_posto.select("posto_id", "bandeira"))
        whole = (
            facts.join(days, "data_id").join(products, "produto_id").join(places, "localidade_id").join(stations, "posto_id")
        )
        whole.groupBy(*LEVELS["cell"]).agg(*_first_states()).write.parquet(f"{side}/cell")
        cells = self.spark.read.parquet(f"{side}/cell")
        for level, columns in LEVELS.items():
            if level != "cell":
                cells.groupBy(*columns).agg(*_merged_states()).write.parquet(f"{side}/{level}")
        self._write_bitmaps(gold, facts, side)
        self._commit(side, (n := max([last for _, last in self._all_loads()], default=0) + 1, n))

    def _write_bitmaps(self, gold: Gold, facts: DataFrame, side: str) -> None:
        city = gold.dim_localidade.where("municipio is not null")
        members = reduce(
            DataFrame.unionByName,
            [
                frame.select(F.lit(kind).alias("kind"), member.alias("member"))
                for kind, frame, member in (
                    ("produto", gold.dim_produto, F.to_json(F.struct("produto", "unidade_medida"))),
                    ("municipio", city, F.col("municipio")),
                    ("posto", gold.dim_posto, F.to_json(F.struct(*POSTO_ATTRIBUTES))),
                )
            ],
        )
        known = self._members.extend(members)
        ids = known.select("kind", "member", "member_id")
        _bitmaps(ids.join(members.distinct(), ["kind", "member"]), ["kind"]).write.parquet(f"{side}/member_bits")
        named = ids.where("kind = 'municipio'").select(F.col("member").alias("municipio"), "member_id")
        seen = facts.select("data_id", "localidade_id").distinct()
        by_day = (
            seen.join(gold.dim("dim_data", gold.dim_data.select("data_id", "data")), "data_id")
            .join(gold.dim("dim_localidade", city.select("localidade_id", "municipio").join(named, "municipio")), "localidade_id")
            .select("data", "member_id")
        )
        _bitmaps(by_day, ["data"]).write.parquet(f"{side}/city_bits")

    def compact(self) -> None:
        """Merge all loads into one; what an earlier ``compact`` covered is removed."""
        loads = self.loads()
        for covered in set(self._all_loads()) - set(loads):
            self._fs.delete(self._path(self._folder(covered)), True)
        if len(loads) < 2:
            return
        side = self._side()
        for level in LEVELS:
            self.level(level).write.parquet(f"{side}/{level}")
        for table, by in (("member_bits", "kind"), ("city_bits", "data")):
            self._read(table).groupBy(by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits")).write.parquet(f"{side}/{table}")
        self._commit(side, (loads[0][0], loads[-1][1]))

    # ----------------------------------------------------------- reading

    def level(self, name: str) -> DataFrame:
        """One row of states for each group of a level, over all loads."""
        return self._read(name).groupBy(*LEVELS[name]).agg(*_merged_states())

    def route(self, columns: list[str]) -> str:
        """The level with the fewest stored rows that holds ``columns``."""
        key = tuple(self.loads())
        fitting = [n for n, held in LEVELS.items() if set(columns) <= set(held)]
        if not fitting:
            raise ValueError(f"no level holds {columns}")
        for n in fitting:
            if (n, key) not in self._rows:
                self._rows[n, key] = self._read(n).count()  # from the footers
        return min(fitting, key=lambda n: (self._rows[n, key], len(LEVELS[n])))

    def rollup(self, by: list[str], rows: str = "all", where: Column | None = None, columns: list[str] | None = None) -> DataFrame:
        """States by ``by`` of the groups that have ``rows``; ``columns`` are those ``where`` reads besides."""
        states = self._read(self.route([*by, *(columns or [])]))
        if where is not None:
            states = states.where(where)
        return states.groupBy(*by).agg(*_merged_states()).where(F.col(f"rows_{rows}") > 0)

    def distinct_cities(self, date_from: DateLike = None, date_to: DateLike = None) -> DataFrame:
        """(municipios): cities with a fact in a range of days, from bitmaps."""
        return _set_bits(self._read("city_bits").where(_between(F.col("data"), date_from, date_to))).select(
            F.col("n").alias("municipios")
        )

    def cities_by(self, period: Column) -> DataFrame:
        """(period, municipios): cities with a fact in each period, a function of ``data``."""
        return _set_bits(self._read("city_bits").withColumn("period", period), "period").withColumnRenamed("n", "municipios")

    def members(self, kind: str) -> DataFrame:
        return _set_bits(self._read("member_bits").where(F.col("kind") == kind))


# ------------------------------------------------------------------- panels

def _last(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def dash_monthly_price(lattice: Lattice, date_from: DateLike = None, date_to: DateLike = None) -> DataFrame:
    """D1."""
    out = lattice.rollup(["ano", "mes", "produto"], where=_between(month_start("ano", "mes"), date_from, date_to))
    return out.select(
        month_start("ano", "mes").alias("time"), F.col("produto").alias("metric"), _mean("venda").alias("value")
    ).orderBy(*_last("time", "metric"))


def dash_price_by_product(lattice: Lattice) -> DataFrame:
    """D2."""
    out = lattice.rollup(["produto"], "positive").select("produto", _mean("venda", "positive").alias("preco_medio"))
    return out.orderBy(F.col("preco_medio").desc_nulls_first(), *_last("produto"))


def dash_rows_per_year(lattice: Lattice) -> DataFrame:
    """D3."""
    out = lattice.rollup(["ano"]).orderBy(*_last("ano"))
    return out.select(F.col("ano").cast("string").alias("ano"), F.col("rows_all").alias("coletas"))


def dash_margin_by_region(lattice: Lattice) -> DataFrame:
    """D4."""
    out = lattice.rollup(["regiao_sigla", "produto"], "both")
    return out.select("regiao_sigla", "produto", _mean("margem", "both").alias("margem_media")).orderBy(
        *_last("regiao_sigla", "produto")
    )


def _top_brands(lattice: Lattice, k: int, *more: Column) -> DataFrame:
    counts = lattice.rollup(["bandeira"]).select("bandeira", F.col("rows_all").alias("total_coletas")).select("*", *more)
    return (
        counts.orderBy(F.col("total_coletas").desc_nulls_first(), F.col("bandeira").asc_nulls_first())
        .limit(k)
        .withColumn("bandeira", label_or_default("bandeira", UNBRANDED_LABEL))
    )


def dash_brand_share(lattice: Lattice, k: int = 15) -> DataFrame:
    """D5."""
    return _top_brands(lattice, k)


def _quarters(lattice: Lattice, products, where: Column | None = None) -> DataFrame:
    chosen = F.col("produto").isin(list(products))
    return lattice.rollup(["ano", "trimestre", "produto"], where=chosen if where is None else chosen & where)


def dash_quarterly_price(
    lattice: Lattice, products=("GASOLINA", "ETANOL"), date_from: DateLike = None, date_to: DateLike = None
) -> DataFrame:
    """D6."""
    out = _quarters(lattice, products, _between(quarter_start("ano", "trimestre"), date_from, date_to))
    return out.select(
        quarter_start("ano", "trimestre").alias("time"), F.col("produto").alias("metric"), _mean("venda").alias("value")
    ).orderBy(*_last("time", "metric"))


def dash_product_summary(lattice: Lattice) -> DataFrame:
    """D7."""
    out = lattice.rollup(["produto"], "traded").select(
        "produto",
        _mean("compra", "traded").alias("preco_medio_compra"),
        _mean("venda", "traded").alias("preco_medio_venda"),
        _mean("margem", "traded").alias("margem_media"),
        F.col("rows_traded").alias("total_registros"),
    )
    return out.orderBy(F.col("margem_media").desc_nulls_first(), *_last("produto"))


def kpi_total_rows(lattice: Lattice) -> DataFrame:
    """0 where there is no fact."""
    return lattice._read(lattice.route([])).agg(F.coalesce(F.sum("rows_all"), F.lit(0)).alias("total"))


def kpi_products(lattice: Lattice) -> DataFrame:
    """D9."""
    return lattice.members("produto").select(F.col("n").alias("produtos"))


def kpi_cities(lattice: Lattice) -> DataFrame:
    """D10."""
    return lattice.members("municipio").select(F.col("n").alias("municipios"))


def kpi_stations(lattice: Lattice) -> DataFrame:
    """D11."""
    return lattice.members("posto").select(F.col("n").alias("postos"))


def bi_monthly_prices(lattice: Lattice) -> DataFrame:
    """B1."""
    out = lattice.rollup(["ano", "mes", "produto"])
    means = [_mean("venda").alias("preco_medio_venda"), _mean("compra").alias("preco_medio_compra")]
    return out.select("ano", "mes", "produto", *means).orderBy(*_last("ano", "mes", "produto"))


def bi_price_by_state(lattice: Lattice) -> DataFrame:
    """B2."""
    out = lattice.rollup(["estado_sigla", "produto"]).select(
        "estado_sigla", "produto", _mean("venda").alias("preco_medio_venda"), F.col("rows_all").alias("total_coletas")
    )
    return out.orderBy(*_last("estado_sigla", "produto"))


def bi_top_cities(lattice: Lattice, product: str = "GASOLINA", min_rows: int = 100, k: int = 10) -> DataFrame:
    """B3."""
    out = lattice.rollup(["municipio", "estado_sigla"], where=F.col("produto") == product, columns=["produto"])
    dear = out.where(F.col("rows_all") >= min_rows).select(
        "municipio", "estado_sigla", _mean("venda").alias("preco_medio"), F.col("rows_all").alias("total_coletas")
    )
    return dear.orderBy(F.col("preco_medio").desc_nulls_first(), *_last("municipio", "estado_sigla")).limit(k)


def bi_margin_by_region(lattice: Lattice) -> DataFrame:
    """B4."""
    out = lattice.rollup(["regiao_sigla", "produto"], "both").select(
        "regiao_sigla",
        "produto",
        _mean("margem", "both").alias("margem_media"),
        _mean("venda", "both").alias("preco_venda_medio"),
        _mean("compra", "both").alias("preco_compra_medio"),
    )
    return out.orderBy(*_last("regiao_sigla"), F.col("margem_media").desc_nulls_first())


def bi_brand_distribution(lattice: Lattice, k: int = 15) -> DataFrame:
    """B5; the window runs over one row a brand."""
    share = exact_percent("total_coletas", F.sum("total_coletas").over(Window.partitionBy()))
    return _top_brands(lattice, k, share.alias("percentual"))


def bi_quarterly_price(lattice: Lattice, products=("GASOLINA", "ETANOL")) -> DataFrame:
    """B6."""
    out = _quarters(lattice, products).select("ano", "trimestre", "produto", _mean("venda").alias("preco_medio"))
    return out.orderBy(*_last("ano", "trimestre", "produto"))
