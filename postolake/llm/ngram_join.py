"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification.

Two documents are linked when the Jaccard similarity of their sets of five-word
shingles is at least 0.8. Documents with the same word sequence form one class
and are compared once. Classes that agree on all rows of a signature band are
candidates; their MinHash values are compared a few at a time and a pair is
dropped as soon as the posterior probability that its similarity reaches the
threshold falls below ``tolerance``. What survives is grouped into components,
inside which every pair is checked on the whole shingle sets.

With 20 bands of 3 values a pair at exactly 0.8 misses every band with
probability 6e-7, and lower thresholds of the posterior lose it with about the
tolerance at each step.

Words are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after
lower-casing A-Z. A text of one to four words is a single shingle; a text
without words (or null) links to nothing and is its own class.

A class is named by 64 bits of a 128-bit hash of its word sequence; the chance
that any two of n different texts share a name is about n*n/2**65.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .scratch import id_bitmap, in_bitmap, numbered_columns, written
from .setjoin import Links, components, group_offsets, group_runs, verify_components, with_blocks

SHINGLE = 5
BANDS, ROWS = 20, 3
HASHES = BANDS * ROWS
STEPS = (12, 24, 36, HASHES)
BUCKET_ROWS = 2048
FILTER_BITS = 24

_rng = np.random.default_rng(20240607)
_A = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_POS = np.uint64(0x9E3779B97F4A7C15)


def _class_ids(tokens: tv.Tokens) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hash of each text's word sequence, as two int64 arrays."""
    owner = tv.owners(tokens.offsets)
    place = (np.arange(len(tokens.hashes)) - tokens.offsets[owner]).astype(np.uint64)
    h = tv.mix(tokens.hashes + place * _POS)
    count = np.diff(tokens.offsets).astype(np.uint64)
    first = tv.mix(tv.segment_sums(h, tokens.offsets) ^ (count * _POS))
    second = tv.mix(tv.segment_sums(tv.mix(h ^ _POS), tokens.offsets) + count)
    return first.view(np.int64), second.view(np.int64)


def _signatures(batches):
    for batch in tv.text_chunks(batches, "text"):
        offsets, data = tv.utf8(batch.column("text"))
        tokens = tv.tokenize(offsets, tv.FOLD[data], tv.ALNUM)
        at, sh = tv.shingles(tokens.offsets, tokens.hashes, SHINGLE)
        id1, id2 = _class_ids(tokens)
        rows = np.flatnonzero(np.diff(at) > 0)
        sig = np.zeros((batch.num_rows, HASHES), dtype=np.uint32)
        if len(rows):
            starts = at[:-1][rows]
            for k in range(HASHES):
                sig[rows, k] = np.minimum.reduceat(((sh * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), starts)
        filled = np.zeros(batch.num_rows, dtype=bool)
        filled[rows] = True
        width = sig.dtype.itemsize * HASHES
        cells = tv.binary_rows(np.arange(batch.num_rows + 1) * width, sig.view(np.uint8).reshape(-1))
        none = pa.array(~filled)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(id1, mask=~filled),
                pa.array(id2, mask=~filled),
                pa.compute.if_else(none, pa.scalar(None, pa.binary()), cells),
            ],
            names=["doc_id", "text_hash", "id", "id2", "sig"],
        )


def _sig_matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.binary())
    at = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset :][: len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], dtype=np.uint8)[at[0] : at[-1]]
    return raw.view(np.uint32).reshape(len(column), HASHES)


def _bands(batches):
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sig = _sig_matrix(batch.column("sig")).astype(np.uint64)
        out = np.empty((batch.num_rows, BANDS), dtype=np.uint64)
        for b in range(BANDS):
            h = np.full(batch.num_rows, b + 1, dtype=np.uint64)
            for r in range(ROWS):
                h = tv.mix((h ^ sig[:, b * ROWS + r]) * _POS)
            out[:, b] = h
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column("id").to_numpy(), BANDS)), pa.array(out.reshape(-1).view(np.int64))],
            names=["id", "band"],
        )


def min_matches(compared: int, threshold: float, tolerance: float) -> int:
    """Fewest equal values among ``compared`` for which P(similarity >= threshold) is at least ``tolerance``.

    With a uniform prior the posterior after m of n equal values is
    Beta(m+1, n-m+1), whose upper tail at t is P(Binomial(n+1, t) <= m).
    """
    tail = 0.0
    for m in range(compared + 1):
        tail += comb(compared + 1, m) * threshold**m * (1 - threshold) ** (compared + 1 - m)
        if tail >= tolerance:
            return m
    return compared


def _survivors(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[int]):
    equal = np.zeros(len(a), dtype=np.int16)
    done = 0
    for upto, need in zip(STEPS, least):
        for k in range(done, upto):
            equal += left[a, k] == right[b, k]
        done = upto
        keep = equal >= need
        a, b, equal = a[keep], b[keep], equal[keep]
        if not len(a):
            break
    return a, b


def _prune(batches, threshold: float, tolerance: float):
    least = [min_matches(n, threshold, tolerance) for n in STEPS]
    keys = ["band", "i", "j"]
    for table in group_runs(batches, keys, rows=1 << 14):
        bounds = group_offsets(table, keys)
        sig = np.ascontiguousarray(_sig_matrix(table.column("sig")))
        ids = table.column("id").to_numpy()
        side, i, j = (table.column(c).to_numpy() for c in ("side", "i", "j"))
        sizes = np.diff(bounds)
        links = Links(table.num_rows)
        # all buckets of up to 64 members at once, by distance inside the bucket
        group = np.repeat(np.arange(len(sizes)), sizes)
        small = ((sizes <= 64) & (i == j)[bounds[:-1]])[group]
        for d in range(1, 64):
            a = np.flatnonzero(small[:-d] & (group[d:] == group[:-d])) if d < len(group) else np.zeros(0, dtype=int)
            if not len(a):
                break
            for s in range(0, len(a), 1 << 16):
                links.add(*_survivors(sig, sig, a[s : s + (1 << 16)], a[s : s + (1 << 16)] + d, least))
        for g in np.flatnonzero((sizes > 64) | (i != j)[bounds[:-1]]):
            lo, hi = bounds[g], bounds[g + 1]
            left = np.flatnonzero(side[lo:hi] == i[lo]) + lo
            right = np.flatnonzero(side[lo:hi] == j[lo]) + lo
            for r in range(0, len(left), 32):
                block = left[r : r + 32]
                x, y = np.repeat(block, len(right)), np.tile(right, len(block))
                if i[lo] == j[lo]:
                    ahead = x < y
                    x, y = x[ahead], y[ahead]
                links.add(*_survivors(sig, sig, x, y, least))
        root = links.roots()
        moved = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[moved]), pa.array(ids[root[moved]])], names=["src", "dst"]
        )


def _candidate_sets(batches, bitmap):
    for batch in tv.text_chunks(batches, "text"):
        offsets, data = tv.utf8(batch.column("text"))
        tokens = tv.tokenize(offsets, tv.FOLD[data], tv.ALNUM)
        id1, _ = _class_ids(tokens)
        wanted = (np.diff(tokens.offsets) > 0) & in_bitmap(bitmap.value, id1.view(np.uint64))
        _, first = np.unique(id1, return_index=True)
        once = np.zeros(len(id1), dtype=bool)
        once[first] = True
        rows = np.flatnonzero(wanted & once)
        if not len(rows):
            continue
        counts = np.diff(tokens.offsets)[rows]
        picked = np.concatenate([[0], np.cumsum(counts)])
        take = np.repeat(tokens.offsets[rows] - picked[:-1], counts) + np.arange(picked[-1])
        at, sh = tv.shingles(picked, tokens.hashes[take], SHINGLE)
        at, values = tv.sorted_sets(at, sh)
        yield pa.RecordBatch.from_arrays(
            [pa.array(id1[rows]), tv.binary_rows(at, values)], names=["id", "tokens"]
        )


def classes_of_texts(
    docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash (``xxhash64``), class (null without words), class_id, n_links, n_copies."""
    spark = docs.sparkSession
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")
    )
    signed = written(
        narrow.mapInArrow(_signatures, "doc_id long, text_hash long, id long, id2 long, sig binary"), "ngram-sig"
    )
    classes = written(
        signed.where("id is not null")
        .groupBy("id")
        .agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.first("sig").alias("sig")),
        "ngram-classes",
    )
    bands = classes.select("id", "sig").mapInArrow(_bands, "id long, band long")
    buckets = (
        bands.groupBy("band")
        .agg(F.count("*").alias("n"), F.min("id").alias("low"), F.bit_xor(F.xxhash64("id")).alias("mark"))
        .where("n > 1")
        .groupBy("n", "low", "mark")
        .agg(F.min("band").alias("band"))  # one of the buckets that hold the same classes
        .select("band", "n")
    )
    members = with_blocks(bands.join(buckets, "band"), "id", F.ceil(F.col("n") / BUCKET_ROWS))
    dealt = (
        members.drop("n", "n_blocks")
        .join(classes.select("id", "sig"), "id")
        .repartition("band", "i", "j")
        .sortWithinPartitions("band", "i", "j")
        .select("band", "i", "j", "side", "id", "sig")
    )
    candidates = dealt.mapInArrow(lambda it: _prune(it, threshold, tolerance), "src long, dst long")
    comps = components(candidates)
    bitmap = spark.sparkContext.broadcast(id_bitmap(comps, "id", FILTER_BITS))
    sets = narrow.select("text").mapInArrow(lambda it: _candidate_sets(it, bitmap), "id long, tokens binary")
    one_each = comps.join(sets.groupBy("id").agg(F.first("tokens").alias("tokens")), "id")
    links = verify_components(one_each, [], threshold)
    known = written(
        classes.select("id", "first_doc", "copies")
        .join(links, "id", "left")
        .select(
            "id",
            "first_doc",
            "copies",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("class", "id").alias("class"),
        ),
        "ngram-known",
    )
    names = known.groupBy("class").agg(F.min("first_doc").alias("class_id"))
    per_class = known.join(names, "class").select("id", "copies", "n_links", "class", "class_id")
    return (
        signed.select("doc_id", "text_hash", "id")
        .join(per_class, "id", "left")
        .select(
            "doc_id",
            "text_hash",
            "class",
            F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce(F.col("copies") - 1, F.lit(0)).cast("long").alias("n_copies"),
        )
    )


def ngram_jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links, n_copies.

    ``class_id``: smallest id among the documents reached through links and
    equal word sequences. ``n_links``: different word sequences linked to this
    one. ``n_copies``: other rows with the same word sequence. A text without
    words has class_id = its own id and no links or copies. Repeated rows are
    copies of each other; null ids are kept and never name a class that holds
    another id. Other columns of ``docs`` are not read. Options are those of
    ``classes_of_texts``.
    """
    return classes_of_texts(docs, **options).select("doc_id", "class_id", "n_links", "n_copies")


def one_of_each_class(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near duplicates: of every class one row with the smallest id stays.

    A class whose ids are all null keeps one of its rows; texts without words
    all stay. Where several rows carry the smallest id of a class, one stays.
    Other columns may have any name.
    """
    plain, names = numbered_columns(docs)
    id_col, text_col = names[options.get("id_col", "doc_id")], names[options.get("text_col", "text")]
    judged = written(classes_of_texts(plain, **options | {"id_col": id_col, "text_col": text_col}).where("class is not null"), "ngram-judged")
    stays = F.col("doc_id").eqNullSafe(F.col("class_id"))
    crowd = judged.where(stays).groupBy("class").count().where("count > 1").select("class")
    several = judged.where(stays).join(crowd, "class").select("doc_id", "text_hash", "class").distinct()
    away = judged.where(~stays).select("doc_id", "text_hash").distinct()

    def keyed(frame):
        return frame.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash", "class": "_class"}).hint("shuffle_hash")

    same = F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(text_col) == F.col("_hash"))
    single = plain.join(keyed(away.unionByName(several.drop("class"))), same, "left_anti")
    doubles = plain.join(keyed(several), same).dropDuplicates(["_class"]).select(*plain.columns)
    return single.unionByName(doubles).toDF(*docs.columns)
