"""Mix overlapping sources to target token counts by min-cost flow.

Documents are aggregated by membership pattern, the set of sources that hold
them. Token capacity flows from patterns to source quotas: the r-th copy of a
pattern's tokens costs r, so the flow meets as much of the quotas as it can and
repeats as little as it can. Every document of a pattern then gets the whole
copies of the flow, and the rest goes to documents in the order of a seeded
hash, in rounds. A round looks at the open documents that fit into what is
missing and takes them in order up to the one that overshoots; where that is
less than half of what is missing, it takes the overshooting one instead. So
what is missing halves each round, and the rounds end when no open document
fits. Last comes the smallest open document where it brings the total nearer.

One row per pattern reaches the driver. Patterns without a common source do not
compete, so the flow is solved part by part; a pattern that shares its only
source with no other takes what its quota asks, without a flow. A connected part
of more than ``MAX_PATTERNS`` overlapping patterns raises an error; the number of
sources and parts has no limit. Plans of more than ``BROADCAST_PLAN`` rows are
joined by shuffles. The cut of a round in the seeded order is found by two
levels of 256 hash buckets and an exact ranking inside the last bucket, so no
task holds a source.

Sizes count runs of ``[^\\x20\\x09-\\x0D]``; a null text has size 0. A document
without words is never taken. A null source is a source of its own. Repeated
rows are separate documents; rows equal in id and size tie and either may come
first. Nothing depends on partitioning, so reruns agree.
"""

from __future__ import annotations

import heapq
import json
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

MAX_PATTERNS = 5000
BROADCAST_PLAN = 200_000
MAX_COPIES = 3
_BUCKETS = 256


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def capped_targets(sizes: dict, weights: dict, total: int, cap: int = MAX_COPIES) -> dict:
    """Share ``total`` by weight; a target stops at ``cap`` times its source's size, the excess is shared anew."""
    targets: dict = {}
    rest, open_ = Fraction(total), set(sizes)
    while open_:
        weight = sum(Fraction(weights[s]) for s in open_)
        if weight == 0:
            return targets | {s: Fraction(0) for s in open_}
        full = {s for s in open_ if rest * Fraction(weights[s]) / weight > cap * sizes[s]}
        if not full:
            return targets | {s: rest * Fraction(weights[s]) / weight for s in open_}
        for s in full:
            targets[s] = Fraction(cap * sizes[s])
        rest -= sum(targets[s] for s in full)
        open_ -= full
    return targets


def route(capacity: dict[str, int], members: dict[str, list], quotas: dict, copies: int = MAX_COPIES) -> dict[tuple, int]:
    """Min-cost maximum flow of pattern tokens into source quotas.

    ``capacity``: tokens per pattern; the r-th copy (from 0) of a pattern costs
    r per token. ``members``: sources of each pattern. Returns tokens per
    (pattern, source). Successive shortest paths with potentials; costs and
    capacities are integers, ties go to the first pattern in order.
    """
    patterns, sources = sorted(capacity), list(quotas)
    first_source = 2 + len(patterns)
    node = {("s", s): first_source + k for k, s in enumerate(sources)}
    graph: list[list[int]] = [[] for _ in range(first_source + len(sources))]
    to, cap, cost = [], [], []

    def arc(u, v, c, w):
        for a, b, x, y in ((u, v, c, w), (v, u, 0, -w)):
            graph[a].append(len(to))
            to.append(b)
            cap.append(x)
            cost.append(y)

    links = {}
    for k, p in enumerate(patterns):
        for r in range(copies):
            arc(0, 2 + k, capacity[p], r)
        for s in members[p]:
            links[p, s] = len(to)
            arc(2 + k, node["s", s], copies * capacity[p], 0)
    for s in sources:
        arc(node["s", s], 1, int(quotas[s]), 0)
    height = [0] * len(graph)
    while True:
        far = [None] * len(graph)
        came = [-1] * len(graph)
        far[0] = 0
        queue = [(0, 0)]
        while queue:
            d, u = heapq.heappop(queue)
            if d > far[u]:
                continue
            for e in graph[u]:
                if cap[e] > 0:
                    step = d + cost[e] + height[u] - height[to[e]]
                    if far[to[e]] is None or step < far[to[e]]:
                        far[to[e]] = step
                        came[to[e]] = e
                        heapq.heappush(queue, (step, to[e]))
        if far[1] is None:
            break
        most = max(x for x in far if x is not None)
        height = [h + (most if x is None else x) for h, x in zip(height, far)]
        path, v = [], 1
        while v:
            path.append(came[v])
            v = to[came[v] ^ 1]
        amount = min(cap[e] for e in path)
        for e in path:
            cap[e] -= amount
            cap[e ^ 1] += amount
    return {key: cap[e ^ 1] for key, e in links.items()}


def _code_points(source):
    return source is None, source or ""


def connected_parts(members: dict[str, list]) -> list[list[str]]:
    """Patterns grouped by shared sources, directly or through others; in order of their first pattern."""
    root: dict = {}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for pattern in sorted(members):
        nodes = [("p", pattern), *(("s", s) for s in members[pattern])]
        for x in nodes:
            root.setdefault(x, x)
        for x in nodes[1:]:
            root[find(x)] = find(nodes[0])
    parts: dict = {}
    for pattern in sorted(members):
        parts.setdefault(find(("p", pattern)), []).append(pattern)
    return list(parts.values())


def route_parts(capacity: dict[str, int], members: dict[str, list], quotas: dict, copies: int = MAX_COPIES) -> dict[tuple, int]:
    """``route`` for each connected part; a part of one pattern with one source needs no search."""
    flow: dict[tuple, int] = {}
    for part in connected_parts(members):
        if len(part) == 1 and len(members[part[0]]) == 1:
            (p,), (s,) = part, members[part[0]]
            flow[p, s] = min(int(quotas[s]), copies * capacity[p])
            continue
        if len(part) > MAX_PATTERNS:
            raise ValueError(f"more than {MAX_PATTERNS} overlapping membership patterns")
        own = {s: quotas[s] for s in sorted({s for p in part for s in members[p]}, key=_code_points)}
        flow |= route({p: capacity[p] for p in part}, {p: members[p] for p in part}, own, copies)
    return flow


def _cut(parts: DataFrame, bucket: str, rest: str) -> DataFrame:
    """The bucket of each pattern in which ``rest`` is exceeded, and what is left on entering it."""
    upto = Window.partitionBy("pattern").orderBy(bucket)
    sums = parts.groupBy("pattern", bucket, rest).agg(F.sum("size").alias("n"))
    running = sums.withColumn("before", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, -1)))
    running = running.withColumn("before", F.coalesce("before", F.lit(0)))
    return running.where(f"before <= {rest} and before + n > {rest}").select(
        "pattern", F.col(bucket).alias(f"cut_{bucket}"), (F.col(rest) - F.col("before")).alias(f"left_{bucket}")
    )


_PLACE = ("mark", "doc_id", "size", "row")


def _round(fitting: DataFrame, few) -> DataFrame:
    """(pattern, gap, place, alone, missing) of one round over open rows that fit into their pattern's ``gap``.

    Taken are the rows before ``place`` (all, if null), or the row at ``place``
    where ``alone``.
    """
    totals = fitting.groupBy("pattern", "gap").agg(F.sum("size").alias("n"))
    one = _cut(fitting, "b1", "gap")
    inside = fitting.join(few(one), "pattern").where("b1 = cut_b1")
    two = _cut(inside, "b2", "left_b1")
    edge = inside.join(few(two), "pattern").where("b2 = cut_b2")
    order = Window.partitionBy("pattern").orderBy(*_PLACE).rowsBetween(Window.unboundedPreceding, 0)
    over = edge.withColumn("left", F.col("left_b2") - F.sum("size").over(order)).where("left < 0")
    first = F.struct(*[F.col(c) for c in _PLACE])
    over = over.groupBy("pattern").agg(F.min(F.struct(first.alias("place"), "left")).alias("o"))
    over = over.select("pattern", "o.place", (F.col("o.left") + F.col("o.place.size")).alias("left"))
    alone = F.coalesce(2 * F.col("left") > F.col("gap"), F.lit(False))
    missing = F.when(F.col("place").isNull(), F.col("gap") - F.col("n"))  # all taken: no open row fits any more
    missing = missing.when(F.col("alone"), F.col("gap") - F.col("place.size")).otherwise(F.col("left"))
    return (
        totals.join(over, "pattern", "left")
        .withColumn("alone", alone)
        .select("pattern", "gap", "place", "alone", missing.alias("missing"))
    )


def _taken_in(rounds: DataFrame | None, rows: DataFrame, few) -> DataFrame:
    """``rows`` with ``extra``: whether one of the ``rounds`` takes the row."""
    if rounds is None:
        return rows.withColumn("extra", F.lit(False))
    steps = rounds.groupBy("pattern").agg(F.collect_list(F.struct("gap", "place", "alone")).alias("steps"))
    place = F.struct(*[F.col(c) for c in _PLACE])

    def takes(r):
        before = r["place"].isNull() | (~r["alone"] & (place < r["place"]))
        return (F.col("size") <= r["gap"]) & (before | (r["alone"] & (place == r["place"])))

    extra = (F.col("size") > 0) & F.exists("steps", takes)
    joined = rows.join(few(steps), "pattern", "left")
    return joined.withColumn("extra", F.coalesce(extra, F.lit(False))).drop("steps")


def select_documents(sized: DataFrame, plan: DataFrame, seed: int = 0, small: bool = True) -> DataFrame:
    """Add ``taken`` to rows (doc_id, pattern, size, row, ...) given plan rows (pattern, copies, rest).

    ``row`` tells repeated rows apart. A ``small`` plan is broadcast, as are
    the rounds, which number log2(rest) + 1 at most; another is joined by shuffles.
    """
    few = F.broadcast if small else lambda frame: frame
    mark = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 1)  # not negative, so in the order of its buckets
    dealt = sized.join(few(plan), "pattern").withColumn("mark", mark)
    gaps, rounds = plan.where("rest > 0").select("pattern", F.col("rest").alias("gap")), None
    left = gaps.withColumn("missing", F.col("gap"))
    while not gaps.isEmpty():
        fitting = _taken_in(rounds, dealt.join(few(gaps), "pattern").where("size > 0 and size <= gap"), few)
        fitting = fitting.where("not extra").withColumns(
            {"b1": F.shiftright("mark", 55), "b2": F.shiftright("mark", 47).bitwiseAND(_BUCKETS - 1)}
        )
        fitting = fitting.select("pattern", "gap", *_PLACE, "b1", "b2")
        step = written(_round(fitting, few), "mix-round")
        rounds = step if rounds is None else rounds.unionByName(step)
        gaps = step.where("place is not null and missing > 0").select("pattern", F.col("missing").alias("gap"))
    if rounds is not None:
        last = rounds.groupBy("pattern").agg(F.min("missing").alias("after"))
        left = left.join(last, "pattern", "left").select("pattern", F.coalesce("after", "missing").alias("missing"))
    chosen = _taken_in(rounds, dealt, few)
    # the smallest open document is larger than what is missing; it is added where the total comes nearer
    nearer = (
        chosen.join(few(left.where("missing > 0")), "pattern")
        .where("not extra and size > 0 and size < 2 * missing")
        .groupBy("pattern")
        .agg(F.min(F.struct("size", "mark", "doc_id", "row")).alias("s"))
        .select("pattern", F.col("s.row").alias("nearest"))
    )
    chosen = chosen.join(few(nearer), "pattern", "left")
    extra = F.col("extra") | F.coalesce(F.col("row") == F.col("nearest"), F.lit(False))
    taken = F.col("copies") * F.col("size") + F.when(extra, F.col("size")).otherwise(0)
    return chosen.select(*sized.columns, taken.alias("taken")).drop("row")


def mix_sources(
    docs: DataFrame,
    sources: Column,
    weights,
    copies: int = MAX_COPIES,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, dict]:
    """Documents with the words the mix takes, and the plan.

    ``sources``: array column naming the sources that hold a row.
    ``weights``: function from the list of sources in code point order (null
    last) to their weights. Targets share the words of all documents by weight
    and stop at ``copies`` times the words a source holds.

    Returns rows (doc_id, pattern, size, taken) and a dict with ``sizes``,
    ``targets`` and ``flow`` by source and pattern.
    """
    pattern = F.to_json(F.sort_array(F.array_distinct(sources)))
    sized = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            word_count(F.col(text_col)).alias("size"),
            pattern.alias("pattern"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mix-sizes",
    )
    rows = sized.groupBy("pattern").agg(F.sum("size").alias("n")).collect()
    capacity = {r["pattern"]: r["n"] for r in rows}
    members = {p: json.loads(p) for p in capacity}
    names = sorted({s for m in members.values() for s in m}, key=_code_points)
    sizes = dict.fromkeys(names, 0)
    for p, n in capacity.items():
        for s in members[p]:
            sizes[s] += n
    targets = capped_targets(sizes, dict(zip(names, weights(names))), sum(capacity.values()), copies)
    flow = route_parts(capacity, members, {s: round(targets[s]) for s in names}, copies)
    used = {p: sum(flow[p, s] for s in members[p]) for p in capacity}
    plan = docs.sparkSession.createDataFrame(
        [(p, used[p] // n if n else 0, used[p] % n if n else 0) for p, n in sorted(capacity.items())],
        "pattern string, copies long, rest long",
    )
    return select_documents(sized, plan, seed, small=len(capacity) <= BROADCAST_PLAN), {"sizes": sizes, "targets": targets, "flow": flow}


def repeating_weights(names: list, cycle: tuple[int, ...] = (5, 2, 1)) -> list[int]:
    return [cycle[k % len(cycle)] for k in range(len(names))]


def mix_single_source(docs: DataFrame, source_col: str = "source", seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for documents of one source each, weighing 5, 2, 1."""
    mixed, plan = mix_sources(docs, F.array(F.col(source_col)), repeating_weights, seed=seed, id_col=id_col, text_col=text_col)
    totals = docs.sparkSession.createDataFrame(
        [(s, plan["sizes"][s], float(plan["targets"][s])) for s in plan["sizes"]],
        "source string, source_size long, target double",
    ).withColumn("pattern", F.to_json(F.array("source")))
    few = F.broadcast(totals) if len(plan["sizes"]) <= BROADCAST_PLAN else totals
    return mixed.join(few, "pattern").select("doc_id", "source", "size", "source_size", "target", "taken")
