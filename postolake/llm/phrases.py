"""Phrase collocation mining with weighted acyclic automata.

Every language has its own statistics (null languages are ``und``). Texts are
lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words
``[^\\x20\\x09]+``; an occurrence of a phrase lies within one piece.

1. Bounds: the order of runs is cut into prefix ranges of about ``RANGE_RUNS``
   occurrences each, by the runs at every 1,024th word of all texts; a crowded
   first word or pair is cut further by its next words. The bounds only deal out
   work.
2. Shards: each task turns about ``SHARD_TOKENS`` words at a time into a count
   transducer (``transducer.py``) of their runs of one to three words, and cuts it
   at the bounds; each range's parts are united with counts added. Runs
   below the least count are dropped there: parts of a candidate are at least as
   frequent as it is, so no count that a score needs is lost.
3. Part lookups: a range asks for the distinct parts of its candidates; the range
   that holds a part composes the requests with its transducer. A three-word
   candidate's request for its two-word parts also tells how frequent it is, which
   decides whether those are dropped as contained.
4. Scores are exact decimals; the best of every language by two window steps.

A label is a 64-bit hash of language and word (two of n different ones share a
label with probability n*n/2**65). Texts are never moved, only transducers.

Defined cases: null and empty texts have no words; equal rows count each; ids and
other columns, whatever their names, are not read; a very long text is cut into
several shards that overlap by two words; an empty table gives an empty result;
ties in score, then count, go by the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .scratch import written
from .transducer import CountTransducer, Grams, counted, restricted, union

LEAST = 10
TOP = 2000
CONTAINED_PERCENT = 50
SCALE = 1_000_000
SHARD_TOKENS = 1 << 19
RANGE_RUNS = 1 << 21
SAMPLE_EVERY = 1024
SALTS = 64

BREAKS = ~tv._class([*b".,;:!?", *range(0x0A, 0x0E)])
WORDS = tv._class([0x20, 0x09, *b".,;:!?", *range(0x0A, 0x0E)])

SAMPLE = "langs array<string>, words array<long>, sample array<long>"
PART = "range int, blob binary, labels array<long>, names array<string>"


def _named(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The given spans of ``data`` (ascending, disjoint) as strings."""
    if not len(starts):
        return pa.array([], pa.large_string())
    edges = np.stack([starts, ends], axis=1).reshape(-1).astype(np.int64)
    spans = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
    return spans.take(pa.array(np.arange(0, len(edges) - 1, 2))).cast(pa.large_string())


def _shard(labels: np.ndarray, joined: np.ndarray, runs_from: int) -> CountTransducer:
    """Transducer of the runs that start at the first ``runs_from`` words."""
    symbols, number = np.unique(labels, return_inverse=True)
    number = number.astype(np.int64) + 1
    n = len(labels)
    two = np.zeros(n, dtype=bool)
    two[: n - 1] = joined[: n - 1]
    three = np.zeros(n, dtype=bool)
    three[: n - 2] = two[: n - 2] & two[1 : n - 1]
    one = np.arange(n) < runs_from
    at2, at3 = np.flatnonzero(two & one), np.flatnonzero(three & one)
    at1 = np.flatnonzero(one)
    first = number[np.concatenate([at1, at2, at3])]
    second = np.concatenate([np.zeros(len(at1), dtype=np.int64), number[at2 + 1], number[at3 + 1]])
    third = np.concatenate([np.zeros(len(at1) + len(at2), dtype=np.int64), number[at3 + 2]])
    return CountTransducer.build(symbols, counted(first, second, third))


def _codes(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """Order-keeping 63-bit code of a run: 32, 20 and 11 leading bits of its labels."""
    code = (first >> np.uint64(32)) << np.uint64(31)
    code |= (second >> np.uint64(44)) << np.uint64(11)
    code |= third >> np.uint64(53)
    return code.astype(np.int64)


class _Collector:
    """Labels of the words of texts and which are followed by another of their piece, gathered until they make a shard."""

    def __init__(self):
        self.labels: list[np.ndarray] = []
        self.joined: list[np.ndarray] = []
        self.known: list[np.ndarray] = []  # labels, and the word and language of each
        self.names: list[pa.Array] = []
        self.size = 0

    def add(self, words: _Words) -> None:
        self.labels.append(words.labels)
        self.joined.append(words.joined)
        self.size += len(words.labels)
        distinct, at = np.unique(words.labels, return_index=True)
        order = np.argsort(at)
        self.known.append(distinct[order])
        self.names.append(words.named(at[order]))


class _Words:
    """Labels of the words of some texts."""

    def __init__(self, batch: pa.RecordBatch):
        offsets, data = tv.utf8(batch.column("text"))
        self.data = tv.FOLD[data]
        self.tokens = tv.tokenize(offsets, self.data, WORDS)
        self.owner = tv.owners(self.tokens.offsets)
        langs = batch.column("lang").dictionary_encode()
        self.langs, self.code = langs.dictionary, langs.indices.to_numpy()
        # not the hash a word of that name has
        salt = tv.mix(tv.span_hashes(*_packed(self.langs.to_pylist())) + tv._GOLD)
        self.labels = tv.mix(self.tokens.hashes ^ salt[self.code[self.owner]])
        self.labels[self.labels == 0] = 1
        self.joined = np.zeros(len(self.labels), dtype=bool)
        if len(self.labels):
            passed = np.cumsum(BREAKS[self.data])[self.tokens.starts]
            self.joined[:-1] = (self.owner[1:] == self.owner[:-1]) & (passed[1:] == passed[:-1])

    def named(self, at: np.ndarray) -> pa.Array:
        """Word and language of the tokens at ascending places."""
        words = _named(self.data, self.tokens.starts[at], self.tokens.ends[at])
        of = self.langs.take(pa.array(self.code[self.owner[at]])).cast(pa.large_string())
        return pa.compute.binary_join_element_wise(words, of, pa.scalar("\t", pa.large_string()))

    def counts(self) -> dict[str, int]:
        per = np.bincount(self.code[self.owner], minlength=len(self.langs)).tolist()
        return dict(zip(self.langs.to_pylist(), per))


def _samples(batches, every: int) -> Iterator[pa.RecordBatch]:
    """Words of each language, and codes of the runs at every so many words."""
    counts: dict[str, int] = {}
    for batch in tv.text_chunks(batches, "text"):
        words = _Words(batch)
        for lang, n in words.counts().items():
            counts[lang] = counts.get(lang, 0) + n
        n = len(words.labels)
        at = np.arange(0, n, every)
        none = np.zeros(len(at), dtype=np.uint64)
        ahead = np.concatenate([words.labels, np.zeros(2, dtype=np.uint64)])
        two = words.joined[at] if n else np.zeros(0, dtype=bool)
        three = two & np.append(words.joined, False)[at + 1]
        first, second, third = words.labels[at], np.where(two, ahead[at + 1], none), np.where(three, ahead[at + 2], none)
        codes = [_codes(first, none, none), _codes(first, second, none)[two], _codes(first, second, third)[three]]
        yield _sample_row([], [], np.concatenate(codes))
    yield _sample_row(list(counts), list(counts.values()), np.zeros(0, dtype=np.int64))


def _sample_row(langs: list[str], words: list[int], codes: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([langs], pa.list_(pa.string())), pa.array([words], pa.list_(pa.int64())), _one_list(pa.array(codes))]
    return pa.RecordBatch.from_arrays(columns, names=["langs", "words", "sample"])


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = [n.encode() for n in names]
    ends = np.cumsum([len(r) for r in raw]).astype(np.int64)
    return np.frombuffer(b"".join(raw), dtype=np.uint8), ends - [len(r) for r in raw], ends


def _parts_of_shards(batches, bounds: np.ndarray, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    """Transducers of shards, cut at the bounds of the ranges."""
    held = _Collector()
    for batch in tv.text_chunks(batches, "text"):
        held.add(_Words(batch))
        if held.size >= shard_tokens:
            yield from _cut(held, bounds, shard_tokens)
            held = _Collector()
    yield from _cut(held, bounds, shard_tokens)


def _cut(held: _Collector, bounds: np.ndarray, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    if not held.size:
        return
    labels, joined = np.concatenate(held.labels), np.concatenate(held.joined)
    known, at = np.unique(np.concatenate(held.known), return_index=True)
    every_name = pa.concat_arrays(held.names).take(pa.array(at))
    for start in range(0, len(labels), shard_tokens):
        own = min(shard_tokens, len(labels) - start)
        whole = _shard(labels[start : start + own + 2], joined[start : start + own + 2], own)
        names = every_name.take(pa.array(np.searchsorted(known, whole.symbols))).cast(pa.string())
        g = whole.grams()
        keys = [whole.hashes(c) for c in g[:3]]
        of = np.searchsorted(bounds, _codes(*keys), side="right")
        edges = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(of))
        blobs = [restricted(whole, Grams(*(c[a:b] for c in g))).to_bytes() for a, b in zip(edges[:-1], edges[1:])]
        single = np.flatnonzero(g.second == 0)
        upto = pa.array(np.searchsorted(single, edges).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(of[edges[:-1]].astype(np.int32)),
                pa.array(blobs, pa.binary()),
                pa.ListArray.from_arrays(upto, pa.array(keys[0][single].view(np.int64))),
                pa.ListArray.from_arrays(upto, names.take(pa.array(g.first[single] - 1))),
            ],
            names=["range", "blob", "labels", "names"],
        )


def _unite(least: int):
    def of_range(table: pa.Table) -> pa.Table:
        whole = union([CountTransducer.from_bytes(b.as_py()) for b in table.column("blob")], least)
        labels = table.column("labels").combine_chunks().flatten().to_numpy().view(np.uint64)
        names = table.column("names").combine_chunks().flatten()
        kept = whole.levels[0]
        single = whole.hashes(kept.labels[kept.weights > 0])
        order = np.argsort(labels, kind="stable")
        at = order[np.searchsorted(labels[order], single)] if len(single) else np.zeros(0, dtype=np.int64)
        return pa.table(
            {
                "range": table.column("range").slice(0, 1).combine_chunks(),
                "blob": pa.array([whole.to_bytes()], pa.binary()),
                "labels": _one_list(pa.array(single.view(np.int64))),
                "names": _one_list(names.take(pa.array(at))),
            }
        )

    return of_range


def _candidates(blob: bytes) -> tuple[np.ndarray, ...]:
    """Labels and counts of the runs of two and three words."""
    whole = CountTransducer.from_bytes(blob)
    g = whole.grams()
    keep = g.second > 0
    return (*(whole.hashes(c[keep]) for c in g[:3]), g.counts[keep])


def _parts(h1: np.ndarray, h2: np.ndarray, h3: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(first, second) labels of the parts asked for: each word, and of three words both pairs."""
    none = np.zeros(len(h1), dtype=np.uint64)
    three = h3 != 0
    return [(h1, none), (h2, none), (h3[three], none[three]), (h1[three], h2[three]), (h2[three], h3[three])]


def _requests(batches, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The distinct parts of a range's candidates, addressed to the range holding each.

    ``cover`` is the highest count of a three-word candidate around a pair.
    """
    for batch in batches:
        for row in range(batch.num_rows):
            h1, h2, h3, a = _candidates(batch.column("blob")[row].as_py())
            if not len(a):
                continue
            parts = _parts(h1, h2, h3)
            p1, p2 = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            three = a[h3 != 0]
            cover = np.concatenate([np.zeros(len(p1) - 2 * len(three), dtype=np.int64), three, three])
            order = np.lexsort((p2, p1))
            p1, p2, cover = p1[order], p2[order], cover[order]
            at = np.flatnonzero(np.append(True, (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])))
            k1, k2 = p1[at], p2[at]
            to = np.searchsorted(bounds, _codes(k1, k2, np.zeros_like(k1)), side="right")
            yield pa.RecordBatch.from_pydict(
                {
                    "to": pa.array(to.astype(np.int32)),
                    "of": pa.array(np.full(len(at), batch.column("range")[row].as_py(), dtype=np.int32)),
                    "p1": pa.array(k1.view(np.int64)),
                    "p2": pa.array(k2.view(np.int64)),
                    "cover": pa.array(np.maximum.reduceat(cover, at)),
                }
            )


ANSWER = "of int, p1 long, p2 long, count long, cover long, name string"


def _answer(asked: pa.Table, held: pa.Table) -> pa.Table:
    """Requests composed with the range's transducer; and, for the range itself, how its pairs are covered."""
    p1, p2 = (asked.column(c).to_numpy().view(np.uint64) for c in ("p1", "p2"))
    if not len(p1) or not held.num_rows:
        return _nothing()
    whole = CountTransducer.from_bytes(held.column("blob")[0].as_py())
    counts = whole.compose(p1, p2)
    labels = held.column("labels")[0].values.to_numpy().view(np.uint64)
    names = held.column("names")[0].values
    place = np.searchsorted(labels, p1)
    single = p2 == 0
    name = pa.compute.if_else(pa.array(single), names.take(pa.array(np.where(single, place, 0), mask=~single)), None)
    cover = asked.column("cover").to_numpy()
    replies = pa.table(
        {
            "of": asked.column("of"),
            "p1": asked.column("p1"),
            "p2": asked.column("p2"),
            "count": pa.array(counts),
            "cover": pa.nulls(len(p1), pa.int64()),
            "name": name.cast(pa.string()),
        }
    )
    pairs = np.flatnonzero(cover > 0)
    order = pairs[np.lexsort((p2[pairs], p1[pairs]))]
    if not len(order):
        return replies
    at = np.flatnonzero(np.append(True, (p1[order][1:] != p1[order][:-1]) | (p2[order][1:] != p2[order][:-1])))
    own = pa.table(
        {
            "of": pa.array(np.full(len(at), held.column("range")[0].as_py(), dtype=np.int32)),
            "p1": pa.array(p1[order][at].view(np.int64)),
            "p2": pa.array(p2[order][at].view(np.int64)),
            "count": pa.nulls(len(at), pa.int64()),
            "cover": pa.array(np.maximum.reduceat(cover[order], at)),
            "name": pa.nulls(len(at), pa.string()),
        }
    )
    return pa.concat_tables([replies, own.cast(replies.schema)])


def _nothing() -> pa.Table:
    types = {"of": pa.int32(), "p1": pa.int64(), "p2": pa.int64(), "count": pa.int64(), "cover": pa.int64(), "name": pa.string()}
    return pa.table({k: pa.array([], t) for k, t in types.items()})


SCORED = "lang string, phrase string, a long, cover long, l1 long, r1 long, l2 long, r2 long"


def _with_parts(held: pa.Table, answers: pa.Table) -> pa.Table:
    """A range's candidates with the counts of both cuts, their words and the highest count around them."""
    fields = ("lang", "phrase", "a", "cover", "l1", "r1", "l2", "r2")
    if not held.num_rows or not answers.num_rows:
        return pa.table({f: pa.array([], pa.string() if f in ("lang", "phrase") else pa.int64()) for f in fields})
    h1, h2, h3, a = _candidates(held.column("blob")[0].as_py())
    covers = answers.filter(pa.compute.is_valid(answers.column("cover")))
    counts = answers.filter(pa.compute.is_valid(answers.column("count")))
    none = np.zeros(len(a), dtype=np.uint64)

    def keyed(table: pa.Table):
        p1, p2 = (table.column(c).to_numpy().view(np.uint64) for c in ("p1", "p2"))
        order = np.lexsort((p2, p1))
        return p1[order], p2[order], order

    def find(keys, q1, q2):
        """Row of each (q1, q2); -1 where there is none."""
        p1, p2, order = keys
        if not len(order):
            return np.full(len(q1), -1, dtype=np.int64)
        both = np.rec.fromarrays([np.concatenate([p1, q1]), np.concatenate([p2, q2])])
        _, number = np.unique(both, return_inverse=True)
        row = np.full(number.max() + 1, -1, dtype=np.int64)
        row[number[: len(p1)]] = order
        return row[number[len(p1) :]]

    at = keyed(counts)
    value = counts.column("count").to_numpy()
    names = counts.column("name").combine_chunks()
    w1, w2, w3 = (find(at, h, none) for h in (h1, h2, h3))
    three = h3 != 0
    front, back = find(at, h1, np.where(three, h2, none)), find(at, h2, np.where(three, h3, none))
    cover = find(keyed(covers), h1, h2)
    around = covers.column("cover").to_numpy()
    words = [names.take(pa.array(w, mask=w < 0)) for w in (w1, w2, w3)]
    cut = [pa.compute.split_pattern(w, "\t", max_splits=1) for w in words]
    plain = [pa.compute.list_element(c, 0) for c in cut]
    pairs = pa.compute.binary_join_element_wise(plain[0], plain[1], " ")
    triples = pa.compute.binary_join_element_wise(plain[0], plain[1], plain[2], " ")
    covered = (cover >= 0) & ~three
    return pa.table(
        {
            "lang": pa.compute.list_element(cut[0], 1),
            "phrase": pa.compute.if_else(pa.array(three), triples, pairs),
            "a": pa.array(a),
            "cover": pa.array(around[np.where(covered, cover, 0)] if len(around) else np.zeros(len(a), np.int64), mask=~covered),
            "l1": pa.array(value[w1]),
            "r1": pa.array(value[back]),
            "l2": pa.array(value[front], mask=~three),
            "r2": pa.array(value[np.where(three, w3, 0)], mask=~three),
        }
    )


def _score(left: str, right: str) -> str:
    return f"cast((cast(a as decimal(16,0)) * a * {SCALE}) div (cast({left} as decimal(19,0)) * {right}) as long)"


def mine_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    contained_percent: int = CONTAINED_PERCENT,
    shard_tokens: int = SHARD_TOKENS,
    range_runs: int = RANGE_RUNS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of two and three words.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut that scores
    lowest, ``n`` all words of the language; score = floor(1,000,000 a a / (l r)).
    """
    every = max(1, min(SAMPLE_EVERY, range_runs // 64))
    texts = docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    seen = written(texts.mapInArrow(lambda b: _samples(b, every), SAMPLE), "phrase-samples")
    runs = (seen.agg(F.sum(F.size("sample").cast("long"))).first()[0] or 0) * every
    ranges = max(1, -(-runs // range_runs))
    bounds = np.zeros(0, dtype=np.int64)
    if ranges > 1:
        shares = ",".join(str(k / ranges) for k in range(1, ranges))
        cuts = f"percentile_approx(code, array({shares}), {max(10000, 20 * ranges)})"
        sample = seen.select(F.explode("sample").alias("code"))
        bounds = np.unique(np.array(sample.agg(F.expr(cuts)).first()[0], dtype=np.int64))

    parts = texts.mapInArrow(lambda b: _parts_of_shards(b, bounds, shard_tokens), PART)
    held = written(parts.groupBy("range").applyInArrow(_unite(least), PART), "phrase-ranges")
    asked = held.select("range", "blob").mapInArrow(
        lambda b: _requests(b, bounds), "to int, of int, p1 long, p2 long, cover long"
    )
    answers = asked.groupBy("to").cogroup(held.groupBy("range")).applyInArrow(_answer, ANSWER)
    runs_of = held.select(F.col("range").alias("k"), "blob")
    scored = runs_of.groupBy("k").cogroup(answers.groupBy("of")).applyInArrow(_with_parts, SCORED)

    cut1, cut2 = F.expr(_score("l1", "r1")), F.expr(_score("l2", "r2"))
    second = F.col("s2").isNotNull() & (F.col("s2") < F.col("s1"))
    kept = (
        scored.where(f"cover is null or 100 * cover < {contained_percent} * a")
        .withColumns({"s1": cut1, "s2": cut2})
        .select(
            "lang",
            "phrase",
            "a",
            F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
            F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
            F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"),
        )
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    few = kept.withColumn("salt", salt)
    few = few.withColumn("k", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("k") <= top)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    best = best.where(F.col("rank") <= top)
    totals = (
        seen.select(F.explode(F.arrays_zip("langs", "words")).alias("x"))
        .groupBy(F.col("x.langs").alias("lang"))
        .agg(F.sum("x.words").alias("n"))
    )
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS run
  FROM words, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, run, count(*)::HUGEINT AS a FROM runs GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, count(*) AS n FROM runs WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, run, a, string_split(run, ' ') AS p FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.k, c.run, c.a, j, array_to_string(p[1 : j], ' ') AS lp, array_to_string(p[j + 1 :], ' ') AS rp
  FROM cand c, (SELECT unnest([1, 2]) AS j) WHERE j < c.k),
scores AS (
  SELECT c.lang, c.k, c.run, c.a, j, l.a AS l, r.a AS r, (1000000 * c.a * c.a) // (l.a * r.a) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.run = c.lp JOIN f r ON r.lang = c.lang AND r.run = c.rp),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, run ORDER BY score, j) = 1),
covers AS (
  SELECT lang, array_to_string(p[j : j + 1], ' ') AS run, max(a) AS top
  FROM cand, (SELECT unnest([1, 2]) AS j) WHERE k = 3 GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN covers v ON v.lang = s.lang AND v.run = s.run
  WHERE v.top IS NULL OR 100 * v.top < 50 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, run) AS rank FROM kept)
SELECT lang, rank, run AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
