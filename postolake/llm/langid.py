"""Language identification with a linear-chain conditional random field.

Every word of a text gets a distribution over languages; the text's language is
the one with the largest expected number of words. A word's score for a
language adds a lexicon feature (log-odds of the word's hash bucket, counted
over all training texts), prefixes and suffixes of one to three bytes, and the
byte bigrams and trigrams of the word (each hashed into a table of fixed size).
Transition weights between neighbouring words are learned together with the
rest, so text that switches language is followed word by word. Marginals come
from scaled forward-backward over the whole text.

Training: the lexicon counts cover all labelled training rows. Weights are
fitted on a bounded sample, ``SAMPLE_PER_LANG`` texts per language (lowest
hashes of id and text) of at most ``SAMPLE_WORDS`` words each; their words are
cut into segments and segments of different languages are put together, which
gives code-switched sequences with known labels. Each step adds up gradients
over the partitions of the sample.

Words are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing
A-Z. A text without a letter (Unicode category L), an empty or a null text gets
``und`` and score 0; so does every text when there is nothing to learn from.
Long texts are read whole. Ties go to the language that sorts first.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import chains
from . import textvec as tv
from .scratch import written

UNDETERMINED = "und"
LEXICON_BITS = 16
FEATURE_BITS = 16
SAMPLE_PER_LANG = 300
SAMPLE_WORDS = 20_000
STEPS = 12
SEGMENT = 24
SEGMENTS = 4
_SAMPLE_PARTS = 6
_SAMPLE_SALTS = 32
_F = 1 << FEATURE_BITS


class Model(NamedTuple):
    langs: list[str]
    lexicon: np.ndarray  # (buckets, languages) centred log-odds
    weights: np.ndarray  # (feature buckets, languages)
    scale: np.ndarray  # weight of the lexicon feature per language
    start: np.ndarray
    change: np.ndarray  # (languages, languages) transition weights


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Feature buckets of each word as (word row, bucket, value) triples."""
    lengths = ends - starts
    rows, buckets, values = [], [], []

    def add(row, code, kind, value):
        h = tv.mix(code * np.uint64(8) + np.uint64(kind))
        rows.append(row)
        buckets.append(_bucket(h, FEATURE_BITS))
        values.append(value)

    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    for k in (1, 2, 3):
        has = np.flatnonzero(lengths >= k)
        keep = np.uint64((1 << (8 * k)) - 1)
        one = np.ones(len(has))
        add(has, words[starts[has]] & keep | np.uint64(k << 24), 1, one)
        add(has, words[ends[has] - k] & keep | np.uint64(k << 24), 2, one)
    first = np.concatenate([[0], np.cumsum(lengths)])
    row = np.repeat(np.arange(len(starts)), lengths)
    at = np.arange(first[-1]) - first[row] + starts[row]
    here = data[at].astype(np.uint64)
    before = np.where(at > starts[row], data[at - 1], 32).astype(np.uint64)
    after = np.where(at < ends[row] - 1, padded[at + 1], 32).astype(np.uint64)
    value = 1.0 / lengths[row]
    add(row, before << np.uint64(8) | here, 3, value)
    add(row, before << np.uint64(16) | here << np.uint64(8) | after, 4, value)
    return np.concatenate(rows), np.concatenate(buckets), np.concatenate(values)


class _Words(NamedTuple):
    """Distinct words of a chunk: their features and the distinct word of each token."""

    token: np.ndarray
    lexicon: np.ndarray
    row: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    count: int


def _distinct(data: np.ndarray, tokens: tv.Tokens) -> _Words:
    names, first, token = np.unique(tokens.hashes, return_index=True, return_inverse=True)
    row, bucket, value = _features(data, tokens.starts[first], tokens.ends[first])
    return _Words(token, _bucket(names, LEXICON_BITS), row, bucket, value, len(names))


def _word_scores(words: _Words, model: Model) -> np.ndarray:
    score = model.lexicon[words.lexicon] * model.scale
    for y in range(len(model.langs)):
        score[:, y] += np.bincount(words.row, model.weights[words.bucket, y] * words.value, minlength=words.count)
    return score


def _marginals(emission: np.ndarray, offsets: np.ndarray, start: np.ndarray, change: np.ndarray, pairs: bool = False):
    """Posterior of each token's label over CSR sequences; ``emission`` holds scores.

    With ``pairs`` the expected transition counts and first-label counts follow.
    """
    lay = chains.layout(offsets)
    scale = np.exp(emission - emission.max(axis=1, keepdims=True))[lay.order]
    move = np.exp(change)
    alpha, norm = chains.forward(scale, lay, np.exp(start), move)
    gamma, moves = chains.backward(scale, alpha, norm, lay, move)
    if not pairs:
        return gamma[lay.place]
    firsts = gamma[: lay.begin[1]].sum(axis=0) if len(lay.begin) > 1 else start * 0
    return gamma[lay.place], moves, firsts


def _lexicon_counts(batches, langs: list[str]):
    size = 1 << LEXICON_BITS
    counts = np.zeros(len(langs) * size, dtype=np.int64)
    names = pa.array(langs)
    for batch in tv.text_chunks(batches, "text"):
        offsets, data = tv.utf8(batch.column("text"))
        tokens = tv.tokenize(offsets, tv.FOLD[data], tv.ALNUM)
        label = pa.compute.index_in(batch.column("lang"), names).fill_null(-1).to_numpy(zero_copy_only=False)
        label = np.repeat(label, np.diff(tokens.offsets))
        known = label >= 0
        counts += np.bincount(label[known] * size + _bucket(tokens.hashes[known], LEXICON_BITS), minlength=len(counts))
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["cell", "n"])


def _lexicon(labelled: DataFrame, langs: list[str]) -> np.ndarray:
    """log P(bucket | language), centred over languages."""
    counted = labelled.select("text", "lang").mapInArrow(lambda it: _lexicon_counts(it, langs), "cell int, n long")
    table = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    size = 1 << LEXICON_BITS
    counts = np.zeros(len(langs) * size)
    counts[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    counts = counts.reshape(len(langs), size) + 0.5
    log = np.log(counts / counts.sum(axis=1, keepdims=True)).T
    return log - log.mean(axis=1, keepdims=True)


def _switched(data, tokens, label, rng):
    """Segments of the sample dealt into mixed sequences: (token order, sequence offsets, label per token)."""
    counts = np.diff(tokens.offsets)
    starts = np.concatenate([np.arange(o, o + c, SEGMENT) for o, c in zip(tokens.offsets[:-1], counts)] or [[]]).astype(np.int64)
    owner = np.searchsorted(tokens.offsets, starts, side="right") - 1
    stops = np.minimum(starts + SEGMENT, tokens.offsets[owner + 1])
    shuffled = rng.permutation(len(starts))
    starts, stops, owner = starts[shuffled], stops[shuffled], owner[shuffled]
    sizes = stops - starts
    first = np.concatenate([[0], np.cumsum(sizes)])
    order = np.repeat(starts - first[:-1], sizes) + np.arange(first[-1])
    return order, first[np.append(np.arange(0, len(sizes), SEGMENTS), len(sizes))], np.repeat(label[owner], sizes)


def _gradient(batches, model):
    """One row: the sample partition's observed minus expected feature counts, and its number of words."""
    m: Model = model.value
    L = len(m.langs)
    parts = [b for b in batches if b.num_rows]
    total = [np.zeros((_F, L)), np.zeros(L), np.zeros(L), np.zeros((L, L))]
    seen = 0
    if parts:
        table = pa.Table.from_batches(parts)
        offsets, data = tv.utf8(table.column("text"))
        data = tv.FOLD[data]
        tokens = tv.tokenize(offsets, data, tv.ALNUM)
        label = np.array([m.langs.index(x) for x in table.column("lang").to_pylist()])
        order, seq, y = _switched(data, tokens, label, np.random.default_rng(1))
        if len(order):
            words = _distinct(data, tokens)
            word = words.token[order]
            gamma, moves, begins = _marginals(_word_scores(words, m)[word], seq, m.start, m.change, pairs=True)
            seen = len(order)
            residual = -gamma
            residual[np.arange(seen), y] += 1
            per_word = np.column_stack([np.bincount(word, residual[:, k], minlength=words.count) for k in range(L)])
            for k in range(L):
                total[0][:, k] = np.bincount(words.bucket, per_word[words.row, k] * words.value, minlength=_F)
            total[1] = (per_word * m.lexicon[words.lexicon]).sum(axis=0)
            total[2] = np.bincount(y[seq[:-1]], minlength=L) - begins
            inner = np.ones(seen, dtype=bool)
            inner[seq[:-1]] = False
            at = np.flatnonzero(inner)
            total[3] = np.bincount(y[at - 1] * L + y[at], minlength=L * L).reshape(L, L) - moves
    flat = np.concatenate([t.reshape(-1) for t in total])
    yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([flat.tobytes()], pa.binary())], names=["n", "g"])


def train(labelled: DataFrame) -> Model:
    """Fit a model on rows (doc_id, text, lang) with non-null text and lang."""
    langs = sorted(r[0] for r in labelled.select("lang").distinct().collect())
    L = len(langs)
    if L == 0:
        return Model([], np.zeros((1 << LEXICON_BITS, 0)), np.zeros((_F, 0)), np.zeros(0), np.zeros(0), np.zeros((0, 0)))
    lexicon = _lexicon(labelled, langs)
    pick = F.xxhash64("doc_id", "text")
    ranked = (
        labelled.select("lang", pick.alias("pick"), F.regexp_count("text", F.lit(r"\S+")).alias("words"))
        .where((F.col("words") > 0) & (F.col("words") <= SAMPLE_WORDS))
        # first inside hash parts, so that no task ranks a whole language
        .withColumn("part", F.pmod(F.col("pick"), F.lit(_SAMPLE_SALTS)))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy("pick")))
        .where(F.col("rank") <= SAMPLE_PER_LANG)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("pick")))
        .where(F.col("rank") <= SAMPLE_PER_LANG)
        .select("pick")
        .distinct()
    )
    # at most SAMPLE_PER_LANG rows for each language
    sample = written(
        labelled.withColumn("pick", pick)
        .join(F.broadcast(ranked), "pick")
        .repartition(_SAMPLE_PARTS, "pick")
        .sortWithinPartitions("pick")
        .select("text", "lang"),
        "langid-sample",
    )
    spark = labelled.sparkSession
    model = Model(langs, lexicon, np.zeros((_F, L)), np.full(L, 1.0), np.zeros(L), 2.0 * np.eye(L))
    history = None
    for step in range(STEPS):
        shared = spark.sparkContext.broadcast(model)
        rows = sample.mapInArrow(lambda it, shared=shared: _gradient(it, shared), "n long, g binary").toArrow()
        shared.unpersist()
        n = sum(rows.column("n").to_pylist())
        if n == 0:
            break
        grad = sum(np.frombuffer(g, dtype=np.float64) for g in rows.column("g").to_pylist()) / n
        params = np.concatenate([p.reshape(-1) for p in model[2:]])
        grad = grad - 1e-6 * params
        history = grad * grad if history is None else history + grad * grad
        params = params + 0.5 * grad / (np.sqrt(history) + 1e-8)
        cut = np.cumsum([_F * L, L, L])
        w, s, b, t = np.split(params, cut)
        model = Model(langs, lexicon, w.reshape(_F, L), s, b, t.reshape(L, L))
    return model


def _has_letter(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Whether each text holds a character of Unicode category L; only texts without a-z are decoded."""
    latin = (data >= 97) & (data <= 122)
    out = tv.segment_sums(latin.astype(np.int64), offsets) > 0
    foreign = tv.segment_sums((data >= 128).astype(np.int64), offsets) > 0
    for i in np.flatnonzero(~out & foreign):
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def _token_letters(data: np.ndarray, tokens: tv.Tokens) -> np.ndarray:
    """Tokens with a byte other than a digit."""
    other = np.concatenate([[0], np.cumsum((data < 48) | (data > 57))])
    return other[tokens.ends] > other[tokens.starts]


def _predict(batches, model, text: str, keep_text: bool):
    m: Model = model.value
    L = len(m.langs)
    names = pa.array([*m.langs, UNDETERMINED])
    for batch in tv.text_chunks(batches, text, limit=1 << 20):
        offsets, data = tv.utf8(batch.column(text))
        data = tv.FOLD[data]
        lettered = _has_letter(offsets, data)
        best = np.full(batch.num_rows, L)
        score = np.zeros(batch.num_rows)
        if L and lettered.any():
            tokens = tv.tokenize(offsets, data, tv.ALNUM)
            words = _distinct(data, tokens)
            gamma = _marginals(_word_scores(words, m)[words.token], tokens.offsets, m.start, m.change)
            counted = _token_letters(data, tokens)
            gamma[~counted] = 0
            share = np.column_stack([tv.segment_sums(gamma[:, k], tokens.offsets) for k in range(L)])
            total = share.sum(axis=1)
            ok = lettered & (total > 0)
            best[ok] = share[ok].argmax(axis=1)
            score[ok] = np.clip(share[ok].max(axis=1) / total[ok], 0.0, 1.0)
        kept = [c for c in batch.schema.names if keep_text or c != text]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), names.take(pa.array(best)), pa.array(score)], names=[*kept, *PREDICTED]
        )


PREDICTED = ("lang_pred", "score")


def predict(texts: DataFrame, model: Model, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Add lang_pred and score to a frame (replacing columns of these names); other columns pass through."""
    plain = texts.drop(*PREDICTED)
    shared = texts.sparkSession.sparkContext.broadcast(model)
    kept = ", ".join(f"`{n}` {t}" for n, t in plain.dtypes if keep_text or n != text_col)
    return plain.mapInArrow(lambda it: _predict(it, shared, text_col, keep_text), f"{kept}, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 3, held: int = 1, id_col: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of documents (doc_id, text, lang).

    Rows with crc32(doc_id as text) mod ``folds`` = ``held`` are held out; a
    null doc_id counts as held out. The model sees text and lang of the others
    only, and predictions see text only. Repeated rows are predicted each.
    """
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(fold == held, F.lit(True)).alias("held_out"),
        F.col("text"),
        F.col("lang"),
    )
    model = train(base.where("not held_out and lang is not null and text is not null").select("doc_id", "text", "lang"))
    return predict(base.select("doc_id", "held_out", "text"), model)


def with_language(docs: DataFrame, least: float = 0.3, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs``, all columns, less the rows without a recognisable language.

    A row goes when its prediction is ``und`` or when no language reaches the
    share ``least`` of its words; mixed texts stay. The model learns from all
    labelled rows. Without any label nothing can be judged and all rows stay.
    """
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = train(labelled.where("lang is not null and text is not null"))
    if not model.langs:
        return docs
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}  # other columns may be called like predictions
    judged = predict(docs.toDF(*names.values()), model, names[text_col], keep_text=True)
    kept = judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return kept.select(*(F.col(short).alias(c) for c, short in names.items()))
