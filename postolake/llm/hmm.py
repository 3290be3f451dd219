"""Hidden Markov language model: Baum-Welch training and exact sequence scores.

Tokens are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z, then one end
token. The ``FREQUENT`` commonest training tokens are classes of their own;
every other token belongs to one of ``RARE_CLASSES`` classes by its last two
bytes and length. The model emits a class from a hidden state and a token from
its class:

    P(token | state) = P(class | state) * P(token | class)

P(token | class) is (c + 0.5) / (C + 0.5 (V + 1)) with the token's training
count c and the class's count C and size V, so an unseen token has a share.
This factor does not depend on the state, so the likelihood of a text is the
forward recursion over classes plus a sum over its rare tokens, and the exact
counts of rare tokens come from a join instead of a broadcast vocabulary.

Counts, class totals and every Baum-Welch iteration cover all training texts;
expected counts are added up by class across partitions. Only the starting
point is fitted on a bounded sample (``SEED_TEXTS`` texts, a mixture of class
distributions). Tables that reach the driver have at most FREQUENT +
RARE_CLASSES rows.

A null text is empty and consists of the end token. Rows with equal doc_id and
text get equal scores, one each; a null doc_id counts as held out. Tokens are
told apart by a 64-bit hash.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chains
from . import textvec as tv
from .scratch import written

STATES = 8
ITERATIONS = 4
FREQUENT = 1 << 15
RARE_CLASSES = 1 << 12
SEED_TEXTS = 256
CHUNK_TOKENS = 1 << 19
FLUSH = 1 << 19
SMOOTH = 20.0
END = np.uint64(0x656E64)  # hash of the end token; no span hash is special, so it is as unlikely as any other


class Vocabulary(NamedTuple):
    hashes: np.ndarray  # sorted hashes of the frequent tokens
    counts: np.ndarray
    tokens: int  # N
    types: int  # V


class Model(NamedTuple):
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # (classes, states)


def _tokens(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, hashes, rare class) of each text's tokens with the end token last."""
    offsets, data = tv.utf8(column)
    data = tv.FOLD[data]
    tokens = tv.tokenize(offsets, data, tv.BLANK_SPLIT)
    length = tokens.ends - tokens.starts
    last = data[tokens.ends - 1].astype(np.uint64) if len(length) else np.zeros(0, dtype=np.uint64)
    previous = np.where(length > 1, data[np.maximum(tokens.ends - 2, 0)] if len(length) else last, 0).astype(np.uint64)
    shape = tv.mix(last | previous << np.uint64(8) | np.minimum(length, 12).astype(np.uint64) << np.uint64(16))
    rare = (shape % np.uint64(RARE_CLASSES)).astype(np.int32)
    at = tokens.offsets + np.arange(len(tokens.offsets))
    hashes = np.empty(at[-1], dtype=np.uint64)
    classes = np.zeros(at[-1], dtype=np.int32)
    ends = at[1:] - 1
    inner = np.ones(at[-1], dtype=bool)
    inner[ends] = False
    hashes[inner], hashes[ends] = tokens.hashes, END
    classes[inner] = rare
    return at, hashes, classes


def _counts(batches):
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def folded():
        h = np.concatenate([x[0] for x in held])
        c = np.concatenate([x[1] for x in held])
        n = np.concatenate([x[2] for x in held])
        names, first, where = np.unique(h, return_index=True, return_inverse=True)
        return names, c[first], np.bincount(where, n).astype(np.int64)

    def rows(table):
        for s in range(0, len(table[0]), 1 << 17):
            part = slice(s, s + (1 << 17))
            yield pa.RecordBatch.from_arrays(
                [pa.array(table[0][part].view(np.int64)), pa.array(table[1][part]), pa.array(table[2][part])],
                names=["h", "class", "n"],
            )

    for batch in tv.text_chunks(batches, "text"):
        _, hashes, classes = _tokens(batch.column("text"))
        names, first, n = np.unique(hashes, return_index=True, return_counts=True)
        held.append((names, classes[first], n.astype(np.int64)))
        size += len(names)
        if size > 2 * FLUSH:
            held = [folded()]
            size = len(held[0][0])
            if size > FLUSH:
                yield from rows(held[0])
                held, size = [], 0
    if held:
        yield from rows(folded())


def _sequences(batches, vocabulary):
    v: Vocabulary = vocabulary.value
    scale = v.tokens + 0.5 * (v.types + 1)
    logs = np.log10((v.counts + 0.5) / scale)
    rare_type = pa.list_(pa.struct([("h", pa.int64()), ("class", pa.int32()), ("m", pa.int32())]))
    for batch in tv.text_chunks(batches, "text"):
        at, hashes, classes = _tokens(batch.column("text"))
        n = np.diff(at)
        owner = tv.owners(at)
        place = np.minimum(np.searchsorted(v.hashes, hashes), max(len(v.hashes) - 1, 0))
        common = v.hashes[place] == hashes if len(v.hashes) else np.zeros(len(hashes), dtype=bool)
        codes = np.where(common, place, FREQUENT + classes).astype(np.uint16)
        base = np.bincount(owner, np.where(common, logs[place] if len(logs) else 0.0, 0.0), minlength=len(n))
        known = np.bincount(owner, common, minlength=len(n)).astype(np.int64)
        odd = np.flatnonzero(~common)
        order = odd[np.lexsort((hashes[odd], owner[odd]))]
        h, o = hashes[order], owner[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        firsts = np.flatnonzero(new)
        times = np.diff(np.append(firsts, len(h))).astype(np.int32)
        per_text = np.concatenate([[0], np.cumsum(np.bincount(o[firsts], minlength=len(n)))]).astype(np.int32)
        fields = pa.StructArray.from_arrays(
            [pa.array(h[firsts].view(np.int64)), pa.array(classes[order[firsts]]), pa.array(times)], fields=list(rare_type.value_type)
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                batch.column("held_out"),
                pa.array(n),
                pa.array(known),
                pa.array(base),
                tv.binary_rows(at, codes),
                pa.ListArray.from_arrays(pa.array(per_text), fields),
            ],
            names=["doc_id", "text_hash", "held_out", "n_tokens", "known", "base", "codes", "rare"],
        )


_SEQUENCES = (
    "doc_id long, text_hash long, held_out boolean, n_tokens long, known long, base double, codes binary, "
    "rare array<struct<h: long, class: int, m: int>>"
)


def _code_chunks(batches):
    """(batch slice, offsets, codes) of about CHUNK_TOKENS tokens, across batches."""
    held, size = [], 0
    for batch in tv.text_chunks(batches, "codes", limit=2 * CHUNK_TOKENS):
        held.append(batch)
        size += batch.column("codes").nbytes // 2
        if size >= CHUNK_TOKENS:
            yield _decoded(held)
            held, size = [], 0
    if held:
        yield _decoded(held)


def _decoded(held):
    table = pa.Table.from_batches(held).combine_chunks()
    column = table.column("codes").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    at = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset :][: len(column) + 1].astype(np.int64)
    codes = np.frombuffer(column.buffers()[2], dtype=np.uint8)[at[0] : at[-1]].view(np.uint16).astype(np.int64)
    return table, (at - at[0]) // 2, codes


def _expected(batches, model):
    """Expected counts of one partition: rows (class, s0..) with emissions, class -1 starts, -2-i moves from state i."""
    m: Model = model.value
    K = len(m.start)
    emit = m.emit.astype(np.float32)
    move, start = m.move.astype(np.float32), m.start.astype(np.float32)
    seen = np.zeros((len(emit), K))
    first, moves = np.zeros(K), np.zeros((K, K))
    for _, offsets, codes in _code_chunks(batches):
        lay = chains.layout(offsets)
        order = codes[lay.order]
        scale = emit[order]
        alpha, norm = chains.forward(scale, lay, start, move)
        gamma, between = chains.backward(scale, alpha, norm, lay, move)
        moves += between
        first += gamma[: lay.begin[1]].sum(axis=0, dtype=np.float64)
        for k in range(K):
            seen[:, k] += np.bincount(order, gamma[:, k], minlength=len(emit))
    used = np.flatnonzero(seen.any(axis=1))
    label = np.concatenate([used, [-1], -2 - np.arange(K)]).astype(np.int32)
    values = np.concatenate([seen[used], first[None], moves])
    yield pa.RecordBatch.from_arrays(
        [pa.array(label), *(pa.array(np.ascontiguousarray(values[:, k])) for k in range(K))],
        names=["class", *(f"s{k}" for k in range(K))],
    )


def baum_welch_step(sequences: DataFrame, model: Model, prior: np.ndarray) -> Model:
    """One iteration over all ``sequences``; ``prior`` is the class distribution used for smoothing."""
    K = len(model.start)
    shared = sequences.sparkSession.sparkContext.broadcast(model)
    columns = [f"s{k}" for k in range(K)]
    table = (
        sequences.select("codes")
        .mapInArrow(lambda it: _expected(it, shared), "class int, " + ", ".join(f"{c} double" for c in columns))
        .groupBy("class")
        .agg(*(F.sum(c).alias(c) for c in columns))
        .toArrow()
    )
    shared.unpersist()
    label = table.column("class").to_numpy()
    values = np.column_stack([table.column(c).to_numpy() for c in columns])
    emit = SMOOTH * prior[:, None] * np.ones(K)
    emit[label[label >= 0]] += values[label >= 0]
    start = np.full(K, 0.1)
    start += values[label == -1].sum(axis=0)
    move = np.full((K, K), 0.1)
    for k in range(K):
        move[k] += values[label == -2 - k].sum(axis=0)
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def seed_model(sequences: DataFrame, prior: np.ndarray, states: int = STATES, texts: int = SEED_TEXTS) -> Model:
    """Starting point: a mixture of class distributions fitted to ``texts`` sequences (lowest text hashes).

    Components start from texts far apart in the Hellinger sense; the states
    stay with themselves nine times out of ten.
    """
    middling = sequences.where("n_tokens between 30 and 5000")
    hashes = middling.select("text_hash").distinct().orderBy("text_hash").limit(texts).collect()
    picked = middling.where(F.col("text_hash").isin([r[0] for r in hashes]))
    rows = picked.groupBy("text_hash").agg(F.first("codes").alias("codes")).orderBy("text_hash").select("codes").collect()
    emit = np.repeat(prior[:, None], states, axis=1)
    if rows:
        counts = np.stack([np.bincount(np.frombuffer(r[0], dtype=np.uint16), minlength=len(prior)) for r in rows]).astype(np.float32)
        root = np.sqrt(counts / counts.sum(axis=1, keepdims=True))
        near = root @ root[0]
        seeds = [0]
        while len(seeds) < min(states, len(rows)):
            seeds.append(int(near.argmin()))
            near = np.maximum(near, root @ root[seeds[-1]])
        member = (root @ root[seeds].T).argmax(axis=1)
        for _ in range(10):
            mix = np.stack([counts[member == k].sum(axis=0) for k in range(len(seeds))])
            mix = mix + 200 * prior[None]
            mix /= mix.sum(axis=1, keepdims=True)
            member = (counts @ np.log(mix).T).argmax(axis=1)
        emit[:, : len(seeds)] = mix.T
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    # unequal starting shares part states that have no seed of their own
    start = np.linspace(1.0, 1.1, states)
    return Model(start / start.sum(), move, emit / emit.sum(axis=0))


def _forward_scores(batches, model):
    m: Model = model.value
    for table, offsets, codes in _code_chunks(batches):
        lay = chains.layout(offsets)
        _, norm = chains.forward(m.emit[codes[lay.order]], lay, m.start, m.move)
        score = tv.segment_sums(np.log10(norm)[lay.place], offsets)
        for batch in table.drop_columns(["codes"]).append_column("chain", pa.array(score)).combine_chunks().to_batches():
            yield batch


def score_texts(
    docs: DataFrame,
    folds: int = 5,
    held: int = 1,
    states: int = STATES,
    iterations: int = ITERATIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    Learns from rows whose crc32(doc_id as text) mod ``folds`` is not ``held``.
    ``base_score`` is the smoothed unigram log10 probability, ``score`` the
    model's.
    """
    spark = docs.sparkSession
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.coalesce(fold == held, F.lit(True)).alias("held_out"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    counts = texts.where("not held_out").select("text").mapInArrow(_counts, "h long, class int, n long")
    vocabulary = written(
        counts.groupBy("h").agg(F.first("class").alias("class"), F.sum("n").alias("n")), "hmm-vocabulary"
    )
    totals = vocabulary.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = totals["n"] or 0, totals["v"]
    end = int(END)
    top = vocabulary.orderBy(F.col("h") != end, F.desc("n"), "h").limit(FREQUENT).select("h", "n").toArrow()
    hashes = top.column("h").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    frequent = Vocabulary(hashes[order], top.column("n").to_numpy()[order], n_all, v_all)
    shared = spark.sparkContext.broadcast(frequent)
    coded = texts.mapInArrow(lambda it: _sequences(it, shared), _SEQUENCES)
    # texts of like length share a chunk, so few steps run for a handful of long ones
    sequences = written(coded.sortWithinPartitions(F.desc("n_tokens")), "hmm-sequences")

    # at most FREQUENT rows
    common = spark.createDataFrame(pa.table({"h": hashes.view(np.int64)}))
    rest = vocabulary.join(F.broadcast(common), "h", "left_anti")
    class_rows = written(
        rest.groupBy("class").agg(F.sum("n").alias("class_n"), F.count("*").alias("class_v")), "hmm-classes"
    )
    sizes = np.zeros(FREQUENT + RARE_CLASSES)
    sizes[: len(frequent.counts)] = frequent.counts
    table = class_rows.toArrow()
    sizes[FREQUENT + table.column("class").to_numpy()] = table.column("class_n").to_numpy()
    prior = (sizes + 0.5) / (sizes + 0.5).sum()

    training = sequences.where("not held_out")
    model = seed_model(training, prior, states)
    for _ in range(iterations if n_all else 0):
        model = baum_welch_step(training, model, prior)
    final = spark.sparkContext.broadcast(model)
    chain = sequences.select("doc_id", "text_hash", "held_out", "n_tokens", "known", "base", "codes").mapInArrow(
        lambda it: _forward_scores(it, final),
        "doc_id long, text_hash long, held_out boolean, n_tokens long, known long, base double, chain double",
    )

    c = F.coalesce("n", F.lit(0))
    scale = n_all + 0.5 * (v_all + 1)
    of_class = F.coalesce("class_n", F.lit(0)) + 0.5 * (F.coalesce("class_v", F.lit(0)) + 1)
    # at most RARE_CLASSES rows
    rare = (
        sequences.select("doc_id", "text_hash", F.explode("rare").alias("r"))
        .select("doc_id", "text_hash", "r.*")
        .join(rest.select("h", "n"), "h", "left")
        .join(F.broadcast(class_rows), "class", "left")
        .select(
            "doc_id",
            "text_hash",
            (F.col("m") * F.log10((c + 0.5) / F.lit(scale))).alias("base_rare"),
            (F.col("m") * F.log10((c + 0.5) / of_class)).alias("word_rare"),
            F.when(c > 0, F.col("m")).otherwise(0).cast("long").alias("known_rare"),
            F.lit(0).alias("row"),
        )
    )
    # one extra row for each text counts how often equal rows have been added up
    mark = sequences.select(
        "doc_id",
        "text_hash",
        F.lit(0.0).alias("base_rare"),
        F.lit(0.0).alias("word_rare"),
        F.lit(0).cast("long").alias("known_rare"),
        F.lit(1).alias("row"),
    )
    per_text = (
        rare.unionByName(mark)
        .groupBy("doc_id", "text_hash")
        .agg(*(F.sum(x).alias(x) for x in ("base_rare", "word_rare", "known_rare")), F.sum("row").alias("rows"))
        .select(
            F.col("doc_id").alias("_id"),
            F.col("text_hash").alias("_hash"),
            (F.col("base_rare") / F.col("rows")).alias("base_rare"),
            (F.col("word_rare") / F.col("rows")).alias("word_rare"),
            (F.col("known_rare") / F.col("rows")).cast("long").alias("known_rare"),
        )
    )
    return chain.join(
        per_text, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    ).select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.col("known_rare")).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("base_rare")).alias("base_score"),
        (F.col("chain") + F.col("word_rare")).alias("score"),
    )
