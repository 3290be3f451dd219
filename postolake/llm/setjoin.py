"""Connected components and exact Jaccard checks inside candidate components.

Both similarity joins work in three steps: a cheap filter links candidates,
components of the candidate graph become work units, and each unit compares
whole sets exactly. Only spanning edges, counts and flags leave a task, so the
output stays linear however large a group of near copies is. A component of
more than ``BLOCK_ROWS`` rows or ``BLOCK_VALUES`` set elements is split into
blocks; a task then holds two blocks, never the component.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

BLOCK_ROWS = 256
MAX_BLOCK_ROWS = 4096
SPREAD = 10  # blocks of a component that MAX_BLOCK_ROWS does not force to have more
BLOCK_VALUES = 2_000_000
SMALL_GROUP = 16
EDGES_PER_TASK = 1 << 18
CHUNK_VALUES = 500_000


def _local_stars(batches):
    """Edges (u, v) of a partition replaced by stars: every id to the smallest of its local component."""
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        u, v = table.column("u").to_numpy(), table.column("v").to_numpy()
        names, local = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = merge_labels(len(names), local[: len(u)], local[len(u) :])
        moved = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[root[moved]])], names=["u", "v"])


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, comp) for every id of an edge list; ``comp`` is an id of the component, one per component.

    Each round first contracts the edges inside partitions of about
    ``EDGES_PER_TASK`` edges, then maps every node to its smallest neighbour
    and contracts the graph; at least half of the nodes that still have an edge
    disappear, so the number of rounds is logarithmic. Minima combine on the
    map side and joins are plain equi-joins that adaptive execution splits on
    a hot hub.
    """
    both = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    edges = written(both.distinct(), "cc-edges")
    rounds: list[DataFrame] = []
    while (n := edges.count()) > 0:
        parts = -(-n // EDGES_PER_TASK)
        stars = written(edges.repartition(parts, "u", "v").mapInArrow(_local_stars, "u long, v long"), "cc-stars")
        around = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rounds.append(written(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-map"))
        left = rounds[-1].select(F.col("u"), F.col("m").alias("mu"))
        right = rounds[-1].select(F.col("u").alias("v"), F.col("m").alias("mv"))
        contracted = stars.join(left, "u").join(right, "v").where("mu <> mv")
        edges = written(contracted.select(F.col("mu").alias("u"), F.col("mv").alias("v")).distinct(), "cc-edges")
    if not rounds:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("comp"))
    # later rounds hold fewer nodes, so labels are resolved from the last round back
    labels = rounds[-1].select(F.col("u").alias("id"), F.col("m").alias("comp"))
    for mapping in reversed(rounds[:-1]):
        step = labels.select(F.col("id").alias("m"), "comp")
        labels = mapping.join(step, "m", "left").select(F.col("u").alias("id"), F.coalesce("comp", "m").alias("comp"))
    return labels


def with_blocks(df: DataFrame, member: str, blocks: Column) -> DataFrame:
    """One row per member and block pair (``i <= j``) it takes part in; ``side`` is the block the member is in.

    ``blocks`` is the group's number of blocks, at least 1. A group of one
    block yields each member once.
    """
    return (
        df.withColumn("n_blocks", blocks.cast("int"))
        .withColumn("side", F.pmod(F.xxhash64(F.col(member), F.lit(7)), F.col("n_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumn("i", F.least("side", "other"))
        .withColumn("j", F.greatest("side", "other"))
        .drop("other")
    )


def group_runs(batches, keys: list[str], rows: int = 1 << 16, weigh=None, weight: int = 0) -> Iterator[pa.Table]:
    """Tables holding whole groups only, from batches in which a group's rows are adjacent.

    A table closes at a group boundary once it has ``rows`` rows (or
    ``weight`` of ``weigh(batch)``), so memory is bounded by that plus the
    largest group.
    """
    held: list[pa.RecordBatch] = []
    size = load = 0
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, rows)
            held.append(part)
            size += part.num_rows
            load += weigh(part) if weigh else 0
            start += part.num_rows
            if size >= rows or (weigh and load >= weight):
                table = pa.Table.from_batches(held)
                cut = _last_boundary(table, keys)
                if cut:
                    yield table.slice(0, cut).combine_chunks()
                    rest = table.slice(cut).combine_chunks()
                    held = rest.to_batches()
                    size = rest.num_rows
                    load = sum(weigh(b) for b in held) if weigh else 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
    for key in keys:
        v = table.column(key).to_numpy()
        change |= v[1:] != v[:-1]
    return change


def _last_boundary(table: pa.Table, keys: list[str]) -> int:
    at = np.flatnonzero(_changes(table, keys))
    return int(at[-1]) + 1 if len(at) else 0


def group_offsets(table: pa.Table, keys: list[str]) -> np.ndarray:
    inner = np.flatnonzero(_changes(table, keys)) + 1
    return np.concatenate([[0], inner, [table.num_rows]]).astype(np.int64)


def merge_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row number reachable from each of ``n`` rows through the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
        open_ = label[a] != label[b]
        if not open_.any():
            break
    while (label[label] != label).any():
        label = label[label]
    return label


class Links:
    """Row pairs collapsed to a spanning forest as they come, so memory follows the rows, not the pairs."""

    LIMIT = 1 << 18

    def __init__(self, rows: int):
        self.rows = rows
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.pairs.append((a, b))
        self.waiting += len(a)
        if self.waiting > self.LIMIT:
            root = self.roots()
            moved = np.flatnonzero(root != np.arange(self.rows))
            self.pairs, self.waiting = [(moved, root[moved])], 0

    def roots(self) -> np.ndarray:
        """Smallest row each row is connected to."""
        if not self.pairs:
            return np.arange(self.rows)
        return merge_labels(self.rows, *(np.concatenate(x) for x in zip(*self.pairs)))


def ratio(threshold: float) -> tuple[int, int]:
    """The threshold as a fraction, so that similarities are compared as integers."""
    f = Fraction(str(threshold))
    return f.numerator, f.denominator


def _pairs_of_small(group: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row pairs of the same small group that share a value, with the number of shared values."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    order = np.lexsort((owner, values, group[owner]))
    v, o = values[order], owner[order]
    g = group[o]
    found = []
    for d in range(1, SMALL_GROUP):
        same = np.flatnonzero((v[d:] == v[:-d]) & (g[d:] == g[:-d]))
        if not len(same):
            break
        found.append(o[same] * n + o[same + d])
    if not found:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    key, shared = np.unique(np.concatenate(found), return_counts=True)
    return key // n, key % n, shared


def _links_of_large(offsets, values, left, right, num, den) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked (left row, right row) pairs of two row sets by a blocked product of incidence matrices, in parts."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    vocabulary, column = np.unique(values, return_inverse=True)
    frequent = np.bincount(column, minlength=len(vocabulary)) > 1
    column = np.where(frequent, np.cumsum(frequent) - 1, -1)[column]
    width = int(frequent.sum())
    sizes = np.diff(offsets)
    place_l = np.full(len(sizes), -1)
    place_l[left] = np.arange(len(left))
    place_r = np.full(len(sizes), -1)
    place_r[right] = np.arange(len(right))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    step = 128
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    for c in range(0, width, 4096):
        lo, hi = np.searchsorted(column, [c, c + 4096])
        col, own = column[lo:hi] - c, owner[lo:hi]
        ml = np.zeros((len(left), min(4096, width - c)), dtype=np.float32)
        mr = ml if left is right else np.zeros((len(right), min(4096, width - c)), dtype=np.float32)
        in_l, in_r = place_l[own] >= 0, place_r[own] >= 0
        ml[place_l[own[in_l]], col[in_l]] = 1
        if mr is not ml:
            mr[place_r[own[in_r]], col[in_r]] = 1
        shared += ml @ mr.T
    for r in range(0, len(left), step):
        s = shared[r : r + step].astype(np.int64)
        total = sizes[left[r : r + step]][:, None] + sizes[right][None, :]
        a, b = np.nonzero((den * s >= num * (total - s)) & (s > 0))
        yield left[r + a], right[b]


def _verify(batches, threshold: float):
    """Rows (id, n_links, earlier, root) for block pairs of components; see ``verify_components``."""
    num, den = ratio(threshold)
    keys = ["comp", "i", "j"]

    def weigh(batch):
        offsets = batch.column("tokens").buffers()[1]
        at = np.frombuffer(offsets, dtype=np.int32)[batch.column("tokens").offset :][: batch.num_rows + 1]
        return int(at[-1] - at[0]) // 8

    for table in group_runs(batches, keys, rows=1 << 15, weigh=weigh, weight=CHUNK_VALUES):
        bounds = group_offsets(table, keys)
        tokens = table.column("tokens").combine_chunks()
        if isinstance(tokens, pa.ChunkedArray):
            tokens = tokens.chunk(0)
        at = np.frombuffer(tokens.buffers()[1], dtype=np.int32)[tokens.offset :][: len(tokens) + 1].astype(np.int64)
        values = np.frombuffer(tokens.buffers()[2], dtype=np.uint8)[at[0] : at[-1]].view(np.uint64)
        offsets = (at - at[0]) // 8
        ids = table.column("id").to_numpy()
        side = table.column("side").to_numpy()
        i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
        n = table.num_rows
        group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        sizes = np.diff(bounds)
        small = (sizes <= SMALL_GROUP)[group] & (i == j)
        pick = np.flatnonzero(small)
        links = Links(n)
        degree = np.zeros(n, dtype=np.int64)
        earlier = np.zeros(n, dtype=bool)

        def found(a, b):
            degree[:] += np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
            earlier[b] = True
            links.add(a, b)

        if len(pick):
            own = np.diff(offsets)[pick]
            starts = np.concatenate([[0], np.cumsum(own)])
            take = np.repeat(offsets[pick] - starts[:-1], own) + np.arange(starts[-1])
            a, b, s = _pairs_of_small(group[pick], starts, values[take])
            total = own[a] + own[b]
            ok = den * s >= num * (total - s)
            found(pick[a[ok]], pick[b[ok]])
        for g in np.flatnonzero((sizes > SMALL_GROUP) | (i != j)[bounds[:-1]]):
            lo, hi = bounds[g], bounds[g + 1]
            sub = offsets[lo : hi + 1] - offsets[lo]
            val = values[offsets[lo] : offsets[hi]]
            alone = i[lo] == j[lo]
            left = np.arange(hi - lo) if alone else np.flatnonzero(side[lo:hi] == i[lo])
            right = left if alone else np.flatnonzero(side[lo:hi] == j[lo])
            for a, b in _links_of_large(sub, val, left, right, num, den):
                if alone:
                    ahead = a < b
                    a, b = a[ahead], b[ahead]
                found(lo + np.minimum(a, b), lo + np.maximum(a, b))
        root = links.roots()
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(degree), pa.array(earlier), pa.array(ids[root])],
            names=["id", "n_links", "earlier", "root"],
        )


def verify_components(members: DataFrame, order: list[str], threshold: float) -> DataFrame:
    """Exact links inside components.

    ``members``: id (long), comp (long), tokens (binary of distinct uint64,
    one row per id) and the ``order`` columns. Two ids are linked when the
    Jaccard similarity of their sets is at least ``threshold`` (compared as
    integers). Returns per id: n_links, earlier (a linked id comes before it
    in ``order``) and class (an id shared by exactly the ids it is connected
    to through links).
    """
    weights = members.groupBy("comp").agg(
        F.count("*").alias("c"), F.sum(F.octet_length("tokens") / 8).alias("w")
    )
    blocks = F.greatest(
        F.least(F.ceil(F.col("c") / BLOCK_ROWS), F.lit(SPREAD)),
        F.ceil(F.col("c") / MAX_BLOCK_ROWS),
        F.ceil(F.col("w") / BLOCK_VALUES),
    )
    sized = members.join(weights, "comp")
    dealt = with_blocks(sized, "id", blocks)
    dealt = dealt.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", *order, "id")
    dealt = dealt.select("comp", "i", "j", "side", "id", "n_blocks", "tokens")
    checked = written(
        dealt.mapInArrow(
            lambda it: _verify(it, threshold), "id long, n_links long, earlier boolean, root long"
        ),
        "verified",
    )
    per_id = checked.groupBy("id").agg(
        F.sum("n_links").alias("n_links"),
        F.max("earlier").alias("earlier"),
        F.min("root").alias("root_min"),
        F.max("root").alias("root_max"),
    )
    split = per_id.where("root_min <> root_max").select("id")
    if split.isEmpty():
        return per_id.select("id", "n_links", "earlier", F.col("root_min").alias("class"))
    labels = components(checked.select(F.col("id").alias("src"), F.col("root").alias("dst")))
    return (
        per_id.join(labels, "id", "left")
        .select("id", "n_links", "earlier", F.coalesce("comp", "id").alias("class"))
    )
