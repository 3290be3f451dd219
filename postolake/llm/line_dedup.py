"""Near-duplicate lines by an exact set-similarity join.

A line is the text between line feeds; its tokens are the distinct maximal runs
of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. Two lines match
when the Jaccard similarity of their token sets is at least the threshold. The
order of lines is (doc_id, hash of the text, line number), null ids first. A
line is removed when any line before it matches; whether that line is itself
removed plays no part. Lines without tokens are never removed.

Steps: equal token sets collapse to their first line (a task posts a set once). Tokens are ordered by
rarity (counts of all tokens of all lines, added up per hash bucket so that the
table has a fixed size); a set of n tokens is posted under its first
n - ceil(t*n) + 1 tokens. Postings that share a token become candidates after
the length filter, the positional filter and a 128-bit parity bound on the
symmetric difference, all of which keep every true match. Components of the
candidates are verified on whole token sets. A token with more than
``POSTINGS`` postings is dealt in block pairs over several tasks.

A token set is named by 64 bits of hash; the chance that any two of n different
sets share a name is about n*n/2**65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .scratch import id_bitmap, in_bitmap, numbered_columns, written
from .setjoin import Links, ratio, components, group_runs, verify_components, with_blocks

RARITY_BITS = 20
FILTER_BITS = 24
POSTINGS = 4096
NEWLINE = 10
_BLOCKS = 64
_MOST = np.uint64(2**32 - 1)
_SIZE_BITS = 30
_SEEN = 1 << 21  # sets a task remembers to post them once
_SALT = np.uint64(0xD1B54A32D192ED03)


def _line_tokens(column):
    """(line starts per text, tokens of each line) of a text column."""
    offsets, data = tv.utf8(column)
    data = tv.FOLD[data]
    feeds = np.flatnonzero(data == NEWLINE) + 1
    starts = np.sort(np.concatenate([offsets[:-1], feeds]), kind="stable")
    bounds = np.concatenate([starts, offsets[-1:]])
    # a feed at byte p opens a line at p + 1, which may be the start of the next text
    owner = np.searchsorted(offsets, feeds - 1, side="right") - 1
    counts = np.bincount(owner, minlength=len(offsets) - 1) + 1
    first = np.concatenate([[0], np.cumsum(counts)])
    return first, tv.tokenize(bounds, data, tv.ALNUM)


def _rarity(batches, bits: int):
    counts = np.zeros(1 << bits, dtype=np.int64)
    held, size = [], 0
    for batch in tv.text_chunks(batches, "text"):
        offsets, data = tv.utf8(batch.column("text"))
        tokens = tv.tokenize(offsets, tv.FOLD[data], tv.ALNUM)
        held.append((tokens.hashes & np.uint64((1 << bits) - 1)).astype(np.int32))
        size += len(held[-1])
        if size > 1 << bits:
            counts += np.bincount(np.concatenate(held), minlength=1 << bits)
            held, size = [], 0
    if held:
        counts += np.bincount(np.concatenate(held), minlength=1 << bits)
    counts = counts.astype(np.uint64)
    yield _count_blocks(np.arange(_BLOCKS), np.minimum(counts, _MOST).astype(np.uint32).reshape(_BLOCKS, -1))


def _count_blocks(names: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    cells = pa.array([row.tobytes() for row in counts], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), cells], names=["b", "n"])


def _add_blocks(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, cell in zip(batch.column("b").to_pylist(), batch.column("n")):
            part = np.frombuffer(cell.as_buffer(), dtype=np.uint32).astype(np.uint64)
            sums[b] = np.minimum(sums[b] + part, _MOST) if b in sums else part
    if sums:
        yield _count_blocks(np.array(list(sums)), np.stack(list(sums.values())).astype(np.uint32))


def token_rarity(texts: DataFrame, bits: int = RARITY_BITS) -> np.ndarray:
    """Number of tokens per hash bucket over all texts, saturating at 2**32 - 1.

    A task emits its counts as ``_BLOCKS`` blocks, which are added up by block;
    the result has ``2**bits`` entries whatever the input.
    """
    blocks = texts.mapInArrow(lambda it: _rarity(it, bits), "b int, n binary").repartition("b")
    table = blocks.mapInArrow(_add_blocks, "b int, n binary").toArrow()
    out = np.zeros((_BLOCKS, (1 << bits) // _BLOCKS), dtype=np.uint32)
    for b, cell in zip(table.column("b").to_pylist(), table.column("n").to_pylist()):
        out[b] = np.frombuffer(cell, dtype=np.uint32)
    return out.reshape(-1)


def _sets(tokens: tv.Tokens):
    """(offsets, distinct tokens, id) of each line's token set."""
    at, values = tv.sorted_sets(tokens.offsets, tokens.hashes)
    ids = tv.mix(tv.segment_sums(tv.mix(values ^ _SALT), at) + np.diff(at).astype(np.uint64)).view(np.int64)
    return at, values, ids


def _parity(at: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """128-bit XOR of one bit per token; differs in at most as many bits as the sets differ in tokens."""
    h = tv.mix(values ^ _SALT)
    bit = np.uint64(1) << (h & np.uint64(63))
    out = []
    filled = np.diff(at) > 0
    for half in (0, 1):
        words = np.where((h >> np.uint64(6)) & np.uint64(1) == np.uint64(half), bit, np.uint64(0))
        row = np.zeros(len(at) - 1, dtype=np.uint64)
        if filled.any():
            row[filled] = np.bitwise_xor.reduceat(words, at[:-1][filled])
        out.append(row.view(np.int64))
    return out


def _lines(batches, rarity, num: int, den: int):
    table = rarity.value
    smallest = 1
    while num * (smallest + 1) > den * smallest:
        smallest += 1  # a set this small only matches equal sets
    seen: set[int] = set()
    for batch in tv.text_chunks(batches, "text"):
        first, tokens = _line_tokens(batch.column("text"))
        at, values, ids = _sets(tokens)
        sizes = np.diff(at)
        owner = tv.owners(first)
        line_no = np.arange(first[-1]) - first[owner]
        rows = np.flatnonzero(sizes > 0)
        fresh = np.zeros(len(sizes), dtype=bool)
        for k in rows.tolist():
            name = int(ids[k])
            if name not in seen:
                seen.add(name)
                fresh[k] = True
        if len(seen) > _SEEN:
            seen.clear()
        take = np.where(fresh & (sizes >= smallest), sizes - (num * sizes + den - 1) // den + 1, 0)
        rank = table[(values & np.uint64(len(table) - 1)).astype(np.int64)]
        prefix_at = np.concatenate([[0], np.cumsum(take)])
        index = np.repeat(at[:-1] - prefix_at[:-1], take) + np.arange(prefix_at[-1])
        prefix = tv.ranked(at, values, rank, 20)[index]
        count = table[(prefix & np.uint64(len(table) - 1)).astype(np.int64)]
        # tokens of crowded buckets go to a column of their own, empty for most lines; -1 holds a place
        code = ((prefix >> np.uint64(24)) & np.uint64(0xFFFFFFFF)).astype(np.int64) * 2
        busy = count > POSTINGS
        usual = np.where(busy | (count <= 1), -1, code)  # a token counted once is in no other line
        has_busy = tv.segment_sums(busy.astype(np.int64), prefix_at) > 0
        in_busy = np.repeat(has_busy, take)
        busy_at = np.concatenate([[0], np.cumsum(np.where(has_busy, take, 0))])
        lists = [
            pa.ListArray.from_arrays(pa.array(a.astype(np.int32)), pa.array(v))
            for a, v in ((prefix_at, usual), (busy_at, np.where(busy, code + 1, -1)[in_busy]))
        ]
        parity = _parity(at, values)
        key = [batch.column(c).take(pa.array(owner[rows])) for c in ("doc_id", "text_hash")]
        yield pa.RecordBatch.from_arrays(
            [
                *key,
                pa.array(line_no[rows].astype(np.int32)),
                pa.array(ids[rows]),
                pa.array(sizes[rows].astype(np.int32)),
                *(pa.array(p[rows], mask=take[rows] == 0) for p in parity),
                *(x.take(pa.array(rows)) for x in lists),
            ],
            names=["doc_id", "text_hash", "line_no", "id", "n", "p0", "p1", "prefix", "busy"],
        )


_LINE_SCHEMA = (
    "doc_id long, text_hash long, line_no int, id long, n int, p0 long, p1 long, prefix array<long>, busy array<long>"
)


def _candidates(batches, num: int, den: int):
    """Spanning edges of the pairs that share a token and pass every filter.

    Rows come ordered by key (token, then set size) and id. ``place`` holds the
    token's position in the set, and two flags for postings of a block pair.
    """
    for table in group_runs(batches, ["token"], rows=1 << 16):
        key, ids, place, p0, p1 = (table.column(c).to_numpy() for c in ("key", "id", "place", "p0", "p1"))
        again = np.zeros(len(ids), dtype=bool)  # one set posted by several tasks
        again[1:] = (ids[1:] == ids[:-1]) & (key[1:] == key[:-1]) & (place[1:] == place[:-1])
        key, ids, place = key[~again], ids[~again], place[~again]
        p0, p1 = p0[~again].view(np.uint64), p1[~again].view(np.uint64)
        token, size, pos = key >> _SIZE_BITS, key & ((1 << _SIZE_BITS) - 1), place >> 2
        rest = size - pos  # tokens from the shared one on
        mixed, second = (place & 2) > 0, place & 1
        n = len(ids)
        names, local = np.unique(ids, return_inverse=True)
        links = Links(len(names))
        a = np.arange(n - 1)
        d = 0
        while len(a):
            d += 1
            a = a[a < n - d]
            b = a + d
            same = (token[a] == token[b]) & (den * size[a] >= num * size[b])
            a, b = a[same], b[same]  # sizes ascend inside a group, so a failed start stays failed
            total = size[a] + size[b]
            need = (num * total + num + den - 1) // (num + den)
            ok = (np.minimum(rest[a], rest[b]) >= need) & (~mixed[a] | (second[a] != second[b]))
            x, y = a[ok], b[ok]
            if len(x):
                differ = np.bitwise_count(p0[x] ^ p0[y]).astype(np.int64) + np.bitwise_count(p1[x] ^ p1[y])
                close = differ <= total[ok] - 2 * need[ok]
                links.add(local[x[close]], local[y[close]])
        root = links.roots()
        moved = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[root[moved]])], names=["src", "dst"])


def _candidate_sets(batches, texts, sets):
    """Sets of the lines in the bitmap ``sets``, from texts in the bitmap ``texts``; each once a chunk."""
    for whole in batches:
        wanted_text = in_bitmap(texts.value, whole.column("text_hash").to_numpy().view(np.uint64))
        for batch in tv.text_chunks([whole.filter(pa.array(wanted_text))], "text"):
            _, tokens = _line_tokens(batch.column("text"))
            at, values, ids = _sets(tokens)
            wanted = (np.diff(at) > 0) & in_bitmap(sets.value, ids.view(np.uint64))
            _, once = np.unique(ids, return_index=True)
            first = np.zeros(len(ids), dtype=bool)
            first[once] = True
            rows = np.flatnonzero(wanted & first)
            counts = np.diff(at)[rows]
            out = np.concatenate([[0], np.cumsum(counts)])
            take = np.repeat(at[:-1][rows] - out[:-1], counts) + np.arange(out[-1])
            yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), tv.binary_rows(out, values[take])], names=["id", "tokens"])


def removed_lines(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, lines): numbers, from 0, of the lines that match an earlier line.

    Only texts that lose a line have a row; ``text_hash`` is ``xxhash64`` of
    the text. Rows with equal id and text are one document: they lose the same
    lines and no line to each other.
    """
    spark = docs.sparkSession
    num, den = ratio(threshold)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    ).where("text is not null and text <> ''")
    rarity = spark.sparkContext.broadcast(token_rarity(texts.select("text")))
    lines = written(texts.mapInArrow(lambda it: _lines(it, rarity, num, den), _LINE_SCHEMA), "line-sets")
    firsts = written(
        lines.groupBy("id").agg(F.min(F.struct("doc_id", "text_hash", "line_no")).alias("first")), "line-firsts"
    )
    posted = lambda column: (
        lines.where(F.size(column) > 0)
        .select("id", "n", "p0", "p1", F.posexplode(column).alias("pos", "token"))
        .where("token >= 0")
    )
    # only tokens of crowded rarity buckets can have more than POSTINGS postings
    odd = posted("busy")
    crowded = odd.groupBy("token").count().where(F.col("count") > POSTINGS)
    blocks = F.coalesce(F.ceil(F.col("count") / POSTINGS), F.lit(1))
    split = with_blocks(odd.join(crowded, "token", "left"), "id", blocks)
    # a block pair of a crowded token is a token of its own
    split = split.withColumn("token", F.expr("(xxhash64(token, i, j) & 4294967295) * 2 + 1"))
    flags = F.expr("if(i <> j, if(side = j, 3, 2), 0)")
    key = F.shiftleft("token", _SIZE_BITS).bitwiseOR(F.col("n")).alias("key")
    place = (F.shiftleft("pos", 2) + F.col("flags")).cast("long").alias("place")
    parts = [split.withColumn("flags", flags), posted("prefix").withColumn("flags", F.lit(0))]
    dealt = parts[0].select(key, "id", place, "p0", "p1").unionByName(parts[1].select(key, "id", place, "p0", "p1"))
    token = F.shiftright("key", _SIZE_BITS)
    pairs = (
        dealt.repartition(token)
        .sortWithinPartitions("key", "id")
        .withColumn("token", token)
        .mapInArrow(lambda it: _candidates(it, num, den), "src long, dst long")
    )
    comps = components(pairs)
    needed = written(comps.join(firsts.select("id", "first.*"), "id"), "line-needed")
    sc = spark.sparkContext
    in_texts = sc.broadcast(id_bitmap(needed, "text_hash", FILTER_BITS))
    in_sets = sc.broadcast(id_bitmap(needed, "id", FILTER_BITS))
    sets = texts.select("text_hash", "text").mapInArrow(
        lambda it: _candidate_sets(it, in_texts, in_sets), "id long, tokens binary"
    )
    one_each = needed.join(sets.groupBy("id").agg(F.first("tokens").alias("tokens")), "id")
    later = verify_components(one_each, ["doc_id", "text_hash", "line_no"], threshold).where("earlier").select("id")
    verdicts = firsts.select("id", "first").join(later.withColumn("later", F.lit(True)), "id", "left")
    return (
        lines.select("doc_id", "text_hash", "line_no", "id")
        .join(verdicts.hint("shuffle_hash"), "id")
        .where(
            F.coalesce("later", F.lit(False))
            | ~F.struct("doc_id", "text_hash", "line_no").eqNullSafe(F.col("first"))
        )
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set("line_no")).alias("lines"))
    )


def dedup_lines(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``removed`` (array of line numbers, maybe empty).

    The text keeps its other lines in order, joined by line feeds; a text that
    loses every line becomes empty, a null text stays null. Other columns may have
    any name; where one is called ``removed``, the new last column gets underscores
    until its name is free.
    """
    added = "removed"
    while added in docs.columns:
        added += "_"
    plain, names = numbered_columns(docs)
    id_col, text_col = names[id_col], names[text_col]
    gone = removed_lines(plain, threshold, id_col, text_col).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("lines").alias("_lines")
    )
    text = F.col(text_col)
    # the small side is hashed, so texts are shuffled but not sorted
    joined = plain.join(
        gone.hint("shuffle_hash"),
        F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(text_col) == F.col("_hash")) & text.isNotNull(),
        "left",
    )
    numbered = F.transform(F.split(text, "\n", -1), lambda x, k: F.struct(x.alias("x"), k.alias("k")))
    kept = F.transform(F.filter(numbered, lambda e: ~F.array_contains(F.col("_lines"), e["k"])), lambda e: e["x"])
    columns = [
        (F.when(F.col("_lines").isNull(), text).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col else F.col(f"`{c}`"))
        for c in plain.columns
    ]
    found = joined.select(*columns, F.coalesce("_lines", F.array().cast("array<int>")).alias("removed"))
    return found.toDF(*docs.columns, added)
