"""Nearest neighbours by inner product with collision-counting hashing.

Rows are dealt into shards by ranges of norm (``BANDS`` for each doubling), so
one long vector is in a range of its own. In a shard, vectors are lifted by one
coordinate, sqrt(M*M - |x|*|x|) with M the largest norm of the shard, and
queries are scaled to norm M, which turns the largest inner product into the
smallest distance. A shard projects its vectors on ``PROJECTIONS`` random lines
and sorts each projection; every sorted array is cut into 256 base buckets of
equal size. A query opens a window centred on its own projection in every array;
as long as fewer than ``SPARE`` * k + 1 + a share of the shard's vectors collide with it in at
least ``COLLISIONS`` of the arrays, the windows widen by ``WIDEN`` (virtual
rehashing: neighbouring base buckets merge). All vectors above the threshold are
then scored exactly in double precision, and the best k of all shards are kept.

How many arrays and which share a shard needs depends on its vectors: clustered
ones give up their neighbours early, unclustered wide ones hardly differ in
distance. So up to ``TRIALS`` of its queries are first answered exactly, and of
``PLANS`` (cheapest first) a binary search takes the first that finds ``RECALL``
of their neighbours; it serves all queries. tests/llm/test_ann.py measures recall against brute force.

Vectors that are null, all zero, or hold a null, NaN or infinite component take
no part, nor do rows without id. Rows with equal id are one vector (the largest
array in Spark's order). Vectors of another length than the query's are not
candidates. Ties in score go to the smaller id; a query with fewer than k
candidates returns all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .setjoin import group_offsets, group_runs

PROJECTIONS = 96
COLLISIONS = 0.75
#: (share of the lines, share of the vectors)
PLANS = ((0.5, 0.02), (0.5, 0.05), (1.0, 0.05), (1.0, 0.1), (1.0, 0.2), (1.0, 0.4), (1.0, 0.7), (1.0, 0.9))
RECALL = 0.96
TRIALS = 24
WIDEN = 1.1
SHARD_ROWS = 8192
QUERY_ROWS = 4096
SEED = 7
_BUCKETS = 256
_AT_ONCE = 128
BANDS = 2
SPARE = 5
_PILOT = 16


class _Shard:
    """Sorted projections of one shard, as base-bucket numbers."""

    def __init__(self, vectors: np.ndarray, projections: int, seed: int):
        vectors = vectors / np.abs(vectors).max()
        squares = (vectors * vectors).sum(axis=1)
        top = squares.max()
        self.norm = np.sqrt(top)
        lift = np.sqrt(np.maximum(top - squares, 0.0))
        self.lines = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, projections))
        projected = vectors @ self.lines[:-1] + lift[:, None] * self.lines[-1]
        n = len(vectors)
        order = np.argsort(projected, axis=0, kind="stable")
        buckets = min(_BUCKETS, n)
        starts = (np.arange(buckets) * n) // buckets
        self.codes = np.empty((projections, n), dtype=np.uint8)
        number = np.repeat(np.arange(buckets), np.diff(np.append(starts, n))).astype(np.uint8)
        self.edges = np.empty((projections, buckets + 1))
        for i in range(projections):
            self.codes[i, order[:, i]] = number
            column = projected[order[:, i], i]
            self.edges[i, :-1] = column[starts]
            self.edges[i, -1] = column[-1]
        spread = projected.std(axis=0).mean()
        self.base = 0.5 * spread if spread > 0 else 1.0

    def colliding(self, queries: np.ndarray, lines: int, wanted: int, threshold: int, widen: float) -> np.ndarray:
        """Boolean (query, vector): at least ``threshold`` collisions on the first ``lines`` at the query's final radius.

        A pilot on every 16th vector finds the radius at which the windows
        start on the whole shard.
        """
        codes = self.codes[:lines]
        queries = queries / np.abs(queries).max(axis=1, keepdims=True)
        norms = np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        centre = (queries * (self.norm / norms)) @ self.lines[:-1, :lines]
        radius = np.full(len(queries), self.base)
        pilot = codes[:, ::_PILOT]
        if pilot.shape[1] >= 64:
            share = int(wanted * pilot.shape[1] / codes.shape[1])
            radius, _ = self._widened(np.ascontiguousarray(pilot), centre, radius, share, threshold, widen)
            radius /= widen**0.5
        return self._widened(codes, centre, radius, wanted, threshold, widen**0.5)[1]

    def _widened(self, codes, centre, radius, wanted, threshold, widen):
        last = self.edges.shape[1] - 2
        out = np.zeros((len(centre), codes.shape[1]), dtype=bool)
        radius = radius.copy()
        live = np.arange(len(centre))
        while len(live):
            count = np.zeros((len(live), codes.shape[1]), dtype=np.uint8)
            shift = np.empty_like(count)
            hit = np.empty(count.shape, dtype=bool)
            whole = np.ones(len(live), dtype=bool)
            for i in range(len(codes)):
                low = np.searchsorted(self.edges[i], centre[live, i] - radius[live], side="right") - 1
                high = np.searchsorted(self.edges[i], centre[live, i] + radius[live], side="right") - 1
                empty = high < 0
                whole &= (low <= 0) & (high >= last)
                lo, hi = np.clip(low, 0, last), np.clip(high, 0, last)
                np.subtract(codes[i], lo.astype(np.uint8)[:, None], out=shift)
                np.less_equal(shift, (hi - lo).astype(np.uint8)[:, None], out=hit)
                if empty.any():
                    hit[empty] = False
                count += hit.view(np.uint8)
            close = count >= threshold
            enough = (close.sum(axis=1) >= wanted) | whole
            out[live[enough]] = close[enough]
            live = live[~enough]
            radius[live] *= widen
        return radius, out


def _best(ids: np.ndarray, at: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows of ``at`` and their scores, ties to the smaller id."""
    if len(at) > k:
        keep = score >= np.partition(score, len(at) - k)[len(at) - k]
        at, score = at[keep], score[keep]
    order = np.lexsort((ids[at], -score))[:k]
    return at[order], score[order]


def _plan(shard: _Shard, ids, vectors, query_ids, queries, k: int, p: dict) -> tuple[int, int, int]:
    """(lines, wanted, threshold) of the first plan that finds enough neighbours of the trial queries."""
    rows = np.unique(np.linspace(0, len(queries) - 1, min(TRIALS, len(queries))).astype(int))
    exact = []
    for q in rows:
        others = np.flatnonzero(ids != query_ids[q])
        exact.append(_best(ids, others, vectors[others] @ queries[q], k)[0])
    total = sum(len(x) for x in exact)
    low, high = 0, len(PLANS) - 1  # the last plan is taken untried
    while low < high:
        middle = (low + high) // 2
        close = shard.colliding(queries[rows], *_sized(PLANS[middle], len(ids), k, p), p["widen"])
        if sum(close[i][x].sum() for i, x in enumerate(exact)) >= p["recall"] * total:
            high = middle
        else:
            low = middle + 1
    return _sized(PLANS[low], len(ids), k, p)


def _sized(plan: tuple[float, float], n: int, k: int, p: dict) -> tuple[int, int, int]:
    lines = max(1, int(np.ceil(plan[0] * p["projections"])))
    return lines, min(n, int(np.ceil(SPARE * k + 1 + plan[1] * n))), max(1, int(np.ceil(p["collisions"] * lines)))


def _nearest_in(ids, vectors, query_ids, queries, k, p):
    """(query row, id, score) of the best k colliding vectors of a shard for each query."""
    shard = _Shard(vectors, p["projections"], p["seed"])
    plan = _plan(shard, ids, vectors, query_ids, queries, k, p)
    rows, found, scores = [], [], []
    for s in range(0, len(queries), _AT_ONCE):
        block = queries[s : s + _AT_ONCE]
        close = shard.colliding(block, *plan, p["widen"])
        for q in range(len(block)):
            at = np.flatnonzero(close[q] & (ids != query_ids[s + q]))
            at, score = _best(ids, at, vectors[at] @ block[q], k)
            rows.append(np.full(len(at), s + q))
            found.append(ids[at])
            scores.append(score)
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def _search(batches, k: int, p: dict):
    keys = ["shard", "block"]
    for table in group_runs(batches, keys, rows=1 << 14):
        bounds = group_offsets(table, keys)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            part = table.slice(lo, hi - lo)
            column = part.column("v").combine_chunks()
            lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
            is_query = part.column("is_query").to_numpy()
            ids = part.column("id").to_numpy()
            for length in np.unique(lengths):
                same = lengths == length
                data, asks = np.flatnonzero(same & ~is_query), np.flatnonzero(same & is_query)
                if not len(data) or not len(asks):
                    continue
                take = lambda rows: column.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), -1).astype(np.float64)
                row, found, score = _nearest_in(ids[data], take(data), ids[asks], take(asks), k, p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[asks][row]), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"]
                )


def _with_band(rows: DataFrame) -> DataFrame:
    """Add the range of norm of ``v``: its logarithm to base 2 times BANDS, rounded; neither overflows nor underflows."""
    most = rows.withColumn("most", F.array_max(F.transform("v", F.abs)))
    squares = F.aggregate(F.transform("v", lambda x: x / F.col("most")), F.lit(0.0), lambda a, x: a + x * x)
    band = F.floor((F.log2("most") + F.log2(squares) / 2) * BANDS + 0.5).cast("int")
    return most.withColumn("band", band).drop("most")


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    projections: int = PROJECTIONS,
    collisions: float = COLLISIONS,
    recall: float = RECALL,
    widen: float = WIDEN,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for every row that ``queries`` (over id) selects."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    clean = (
        vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull())
        .where(finite & F.exists("v", lambda x: x != 0.0))
        .groupBy("id")
        .agg(F.max("v").alias("v"))
    )
    marked = _with_band(clean.withColumn("is_query", queries))
    # at most BANDS * 2,100 rows, the exponents of a double
    sizes = marked.groupBy("band").agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).orderBy("band").collect()
    ranges, shards = [], 0
    for r in sizes:
        parts = -(-r["n"] // shard_rows)
        ranges.append((r["band"], shards, parts))
        shards += parts
    shards = max(1, shards)
    blocks = max(1, -(-sum(r["q"] for r in sizes) // query_rows))
    ranges = vectors.sparkSession.createDataFrame(ranges, "band int, first int, parts int")
    deal = lambda parts: F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    spread = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    columns = ["shard", "block", "is_query", "id", "v"]
    shard = F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    data = marked.join(F.broadcast(ranges), "band").withColumns({"shard": shard, "is_query": F.lit(False)})
    data = data.withColumn("block", spread(blocks))
    asks = marked.where("is_query").withColumn("block", deal(blocks)).withColumn("shard", spread(shards))
    dealt = data.select(columns).unionByName(asks.select(columns))
    options = {"projections": projections, "collisions": collisions, "recall": recall, "widen": widen, "seed": seed}
    local = (
        dealt.repartition(4 * shards * blocks, "shard", "block")
        .sortWithinPartitions("shard", "block", "is_query", "id")
        .mapInArrow(lambda it: _search(it, k, options), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
