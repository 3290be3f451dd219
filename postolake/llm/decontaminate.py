"""Benchmark decontamination by winnowing, with DataFrame operations only.

Words are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing
A-Z. The benchmark's windows are all runs of ``WINDOW`` consecutive words of an
item; an item of fewer words is one window. Every word of a document inside an
occurrence of a window is hit.

Winnowing: both sides hash all runs of ``GRAM`` words and keep, of every
``WINDOW - GRAM + 1`` consecutive hashes, the smallest (leftmost on ties) with
its position. A shared span of ``WINDOW`` words therefore always shares a kept
hash at the same place of the span. Documents and benchmark join on the kept
hashes; each hit is extended to the full windows it can stand for and the words
themselves are compared, so hash collisions never count. Items shorter than
``WINDOW`` words are found through the hash of their first words, of which the
document side then keeps every one.

The benchmark side is broadcast only when its windows fit ``BROADCAST_BYTES``;
a larger benchmark is joined by shuffles that carry no text.

Null and empty texts have no words and no hits. Rows with equal doc_id and text
give equal results, one each. Items with a null id are not reported; repeated
items count once. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import numbered_columns, written

WINDOW = 13
GRAM = 5
BROADCAST_BYTES = 32 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_POSITION_BITS = 31  # a string holds fewer than 2**31 words


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), _SEPARATORS), "")


def _kept_hashes(w: str, window: int, gram: int) -> Column:
    """Winnowed ``hash << 31 | position`` values of an array of words; empty below ``window`` words."""
    span = window - gram + 1
    parts = ", ".join(f"h[i + {j}]" if j else "h[i]" for j in range(gram))
    grams = f"transform(sequence(0, size(h) - {gram}), i -> shiftleft(xxhash64({parts}), {_POSITION_BITS}) | i)"
    # smallest of `span` neighbours in two steps
    step = max(d for d in range(1, span + 1) if span % d == 0 and d * d <= span)
    inner = ", ".join(f"g[i + {j}]" for j in range(step))
    outer = ", ".join(f"m[i + {j * step}]" for j in range(span // step))
    least = lambda items: f"least({items})" if "," in items else items
    mins = f"transform(sequence(0, size(g) - {step}), i -> {least(inner)})"
    kept = f"transform(sequence(0, size(m) - {span - step + 1}), i -> {least(outer)})"

    def let(name: str, value: str, body: str) -> str:
        return f"transform(array({value}), {name} -> {body})[0]"

    body = let("h", f"transform({w}, x -> xxhash64(x))", let("g", grams, let("m", mins, f"array_distinct({kept})")))
    return F.expr(f"if(size({w}) >= {window}, {body}, cast(array() as array<bigint>))")


def _first_hashes(w: str, length: int) -> Column:
    """``hash << 31 | position`` of every run of ``length`` words."""
    return F.expr(
        f"if(size({w}) >= {length}, transform(sequence(0, size({w}) - {length}), "
        f"i -> shiftleft(xxhash64({length}, slice({w}, i + 1, {length})), {_POSITION_BITS}) | i), "
        "cast(array() as array<bigint>))"
    )


def _windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows: (text, len, items)."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (
        items.where("size(w) > 0")
        .select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("v"))
        .groupBy(F.array_join("v", " ").alias("window"))
        .agg(F.first(F.size("v")).alias("len"), F.collect_set("item").alias("items"))
    )


def _covered(spans: Column) -> Column:
    """Number of positions in the union of sorted (start, len) spans."""
    zero = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))

    def step(acc, s):
        end = s["start"] + s["len"]
        fresh = F.greatest(end - F.greatest(acc["to"], s["start"]), F.lit(0))
        return F.struct(F.greatest(acc["to"], end).alias("to"), (acc["n"] + fresh).alias("n"))

    return F.aggregate(F.array_sort(spans), zero, step, lambda acc: acc["n"])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    ``spans`` are the (start, len) word ranges of matched windows. A document
    is contaminated when n_hit > 0 and 20 * n_hit >= n_words.
    """
    found = written(_windows(benchmark, window, item_col, item_text_col), "bench-windows")
    totals = found.agg(
        F.sum(F.octet_length("window") + 32).alias("bytes"), F.min(F.when(F.col("len") < window, F.col("len"))).alias("short")
    ).first()
    fits = (totals["bytes"] or 0) <= broadcast_bytes
    short = totals["short"]
    hint = F.broadcast if fits else (lambda df: df)

    split = found.select(F.split("window", " ").alias("v"), "len")
    keyed = split.where(F.col("len") == window).select(
        F.explode(_kept_hashes("v", window, gram)).alias("s"), "len"
    )
    if short is not None:
        heads = split.where(F.col("len") < window).select(
            _first_hashes("v", short)[0].alias("s"), "len"
        )
        keyed = keyed.unionByName(heads)
    places = keyed.groupBy(F.shiftright("s", _POSITION_BITS).alias("fp")).agg(
        F.collect_set(
            F.struct(F.col("s").bitwiseAND((1 << _POSITION_BITS) - 1).cast("int").alias("offset"), "len")
        ).alias("places")
    )

    base = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), words(F.col(text_col)).alias("w")
    )
    kept = _kept_hashes("w", window, gram)
    if short is not None:
        kept = F.concat(kept, _first_hashes("w", short))
    # one extra entry for each row (-1) keeps documents without a hit
    entries = base.select("doc_id", "text_hash", "w", F.explode(F.concat(F.array(F.lit(-1).cast("long")), kept)).alias("s"))
    position = F.col("s").bitwiseAND((1 << _POSITION_BITS) - 1).cast("int")
    if fits:
        hits = (
            entries.withColumn("fp", F.shiftright("s", _POSITION_BITS))
            .join(hint(places), "fp", "left")
            .where("s = -1 or places is not null")
            .select("doc_id", "text_hash", "w", "s", position.alias("at"), "places")
        )
    else:
        narrow = (
            entries.select("doc_id", "text_hash", "s", F.shiftright("s", _POSITION_BITS).alias("fp"))
            .where("s <> -1")
            .join(places, "fp")
            .groupBy("doc_id", "text_hash")
            .agg(F.collect_set(F.struct("s", position.alias("at"), "places")).alias("found"))
            .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "found")
        )
        kind = "array<struct<s:bigint,at:int,places:array<struct<offset:int,len:int>>>>"
        row = F.array(F.struct(F.lit(-1).cast("long"), F.lit(0), F.lit(None))).cast(kind)
        same_text = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        hits = (
            base.join(narrow, same_text, "left")
            .withColumn("f", F.explode(F.concat(row, F.coalesce("found", F.array().cast(kind)))))
            .select("doc_id", "text_hash", "w", "f.*")
        )
    candidates = hits.select(
        "doc_id",
        "text_hash",
        F.when(F.col("s") == -1, F.size("w")).alias("n_words"),
        "w",
        F.explode_outer(
            F.transform("places", lambda p: F.struct((F.col("at") - p["offset"]).alias("start"), p["len"].alias("len")))
        ).alias("c"),
    ).where("c is null or (c.start >= 0 and c.start + c.len <= size(w))")
    texts = candidates.select(
        "doc_id",
        "text_hash",
        "n_words",
        "c",
        F.when(F.col("c").isNotNull(), F.array_join(F.slice("w", F.col("c.start") + 1, F.col("c.len")), " ")).alias("window"),
    )
    matched = texts.join(hint(found.select("window", "items")), "window", "left")
    per_text = matched.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.count("n_words").alias("copies"),
        F.collect_set(F.when(F.col("items").isNotNull(), F.col("c"))).alias("spans"),
        F.collect_set("items").alias("items"),
    )
    items = F.sort_array(F.array_distinct(F.flatten("items")))
    n_hit = _covered(F.col("spans"))
    return (
        per_text.withColumn("items", items)
        .withColumn("n_hit", n_hit)
        .select(
            "doc_id",
            "text_hash",
            F.col("n_words").cast("long").alias("n_words"),
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
            F.array_sort("spans").alias("spans"),
            "copies",
        )
        .withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .drop("_row", "copies")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` less its contaminated rows; all columns stay, whatever their names."""
    plain, names = numbered_columns(docs)
    id_col, text_col = names[options.get("id_col", "doc_id")], names[options.get("text_col", "text")]
    bad = (
        contamination(plain, benchmark, **options | {"id_col": id_col, "text_col": text_col})
        .where("contaminated")
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .distinct()
    )
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(text_col) == F.col("_hash"))
    return plain.join(bad, same, "left_anti").toDF(*docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bs AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS win, least(len(w), 13) AS n FROM bs),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, ns WHERE len(w) >= n),
hit AS (SELECT dw.rid, dw.i, dw.n, bw.item_id FROM (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM dw) dw
        JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY rid)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN pos ON pos.rid = d.rid LEFT JOIN its ON its.rid = d.rid
"""
