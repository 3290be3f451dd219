"""Quality rules by distribution divergence, in DataFrame functions only.

A document passes the base rules (enough words, not mostly repeated runs) and is
then held against its language: the histogram of its character classes and that
of the language's ``COMMON`` most frequent words (all others in one bin) are
compared with the language's own by the Jensen-Shannon distance. References are
formed from all documents of the language with at least ``LEAST_WORDS`` words.

A short text differs from any reference by chance: a histogram of k bins drawn
n times has an expected divergence of about (k - 1) / (8 n ln 2) bits, so that
much is added to the squared limit. A histogram is compared only if the text has
``MIN_CHARS`` characters or ``MIN_WORDS`` words and the reference at least
``REFERENCE_WORDS`` words; otherwise it counts as near.

The words of a text stay in its row: repeated runs are found by sorting hashes of
its three-word windows (two different windows of n share a 64-bit hash with probability
n*n/2**65), histograms by sorting places of common words. Only counts per language
and word are shuffled, added up in each task first, so a language that holds most
rows is one row a word and task.

Defined cases: a null text has no words and fails the base; a null language is
``und``; repeated rows and repeated or null ids stay, one result row per input row,
and each counts for the reference; ties among common words go by the word's bytes;
an empty table gives an empty result; other columns, whatever their names, are not
read; texts are read whole at any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

BLANK = r"\x20\x09-\x0D"
LEAST_WORDS = 50
REPEAT_PERCENT = 50
COMMON = 64
CHAR_DISTANCE = 0.28
WORD_DISTANCE = 0.22
MIN_CHARS = 200
MIN_WORDS = 50
REFERENCE_WORDS = 5000
BROADCAST_BYTES = 16 << 20

# what is taken away to count a class, once runs of a-z and spaces are gone; the class of those is the last
CLASSES = ("^A-Z", "^0-9", "^.,;:!?'\"()\\-", r"\x00-\x7F", r"^\x09-\x0D", "\\x09-\\x0D.,;:!?'\"()\\-A-Z0-9\\x{80}-\\x{10FFFF}")
SYMBOLS = "^#*$%&|<>"
SLOT_BITS = 13


def _sized(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Per row: doc_id, lang, t, w (its words), n_chars, n_symbols and sizes of the character classes."""

    def left(column: Column, removed: str) -> Column:
        return F.regexp_replace(column, f"[{removed}]+", "")

    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"),
    )
    few = left(F.col("t"), "a-z ")
    rows = rows.select(
        "doc_id",
        "lang",
        "t",
        F.array_remove(F.split("t", f"[{BLANK}]+"), "").alias("w"),
        F.length("t").alias("n_chars"),
        F.array(*[F.length(left(few, c)) for c in CLASSES], F.length("t") - F.length(few)).alias("classes"),
        F.length(left(few, SYMBOLS)).alias("n_symbols"),
    )
    return rows


def _measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Per row: doc_id, lang, sizes of the character classes, hashes of the words, and the base counts.

    Columns are added step by step: each is used several times by the next, and
    Catalyst keeps such steps apart, so nothing is computed twice. Few steps,
    because each copies the row.
    """
    rows = _sized(docs, id_col, text_col, lang_col)
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{BLANK}]"))
    rows = rows.select(
        "doc_id",
        "lang",
        "n_chars",
        "classes",
        "n_symbols",
        F.size("w").alias("n_words"),
        F.length(F.array_join("w", "")).alias("word_chars"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
        F.expr("-shiftleft(1L, cast(floor(log2(size(w) + 1)) + 1 as int))").alias("mask"),
        lines.alias("lines"),
    )
    # hash of each three-word window over its place, in one sortable number: as many low bits as places need
    packed = "xxhash64(x, h[i + 1], h[i + 2]) & mask | i"
    windows = f"sort_array(transform(slice(h, 1, greatest(n_words - 2, 0)), (x, i) -> {packed}))"
    rows = rows.withColumns({"runs": F.expr(windows), "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines"))})
    rows = rows.drop("lines")
    # neighbours with equal leading bits are looked at again by their whole hashes
    back, ahead = "(x ^ runs[i - 1]) & mask = 0", "(x ^ runs[i + 1]) & mask = 0"
    alike = (
        f"if(exists(transform(runs, (x, i) -> i > 0 and {back}), x -> x), "
        f"transform(filter(runs, (x, i) -> (i > 0 and {back}) or (i < size(runs) - 1 and {ahead})), "
        "x -> cast(x & ~mask as int)), cast(array() as array<int>))"
    )
    rows = rows.withColumn("alike", F.expr(alike)).drop("runs", "mask")
    whole = "sort_array(transform(alike, p -> named_struct('h', xxhash64(h[p], h[p + 1], h[p + 2]), 'p', p)))"
    rows = rows.withColumn("alike", F.expr(whole))
    again = (
        "transform(filter(alike, (x, i) -> (i > 0 and x.h = alike[i - 1].h)"
        " or (i < size(alike) - 1 and x.h = alike[i + 1].h)), x -> x.p)"
    )
    covered = (
        f"aggregate(sort_array({again}), named_struct('upto', 0, 'n', 0), (s, p) -> named_struct("
        "'upto', p + 3, 'n', s.n + p + 3 - greatest(p, s.upto)), s -> s.n)"
    )
    rows = rows.withColumn("n_repeat_words", F.expr(covered)).drop("alike")
    many = F.lit(100).cast("long") * F.col("n_repeat_words") > F.lit(REPEAT_PERCENT).cast("long") * F.col("n_words")
    return rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | many)


def language_references(sized: DataFrame, common: int = COMMON) -> DataFrame:
    """Per language: hashes of its common words, where they stand, their shares (last: all others), class shares,
    number of words.

    ``slots`` finds a common word by ``SLOT_BITS`` bits of its hash, taken at the
    first ``shift`` at which no two common words meet; where there is none,
    ``shift`` is null and the list of hashes is searched instead.
    """
    sound = sized.where(F.size("w") >= LEAST_WORDS)
    counts = sound.select("lang", F.explode("w").alias("key")).groupBy("lang", "key").agg(F.count("*").alias("n"))
    counts = written(counts, "language-words")
    sums = [F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(len(CLASSES) + 1)]
    chars = F.sum("n_chars")
    classes = sound.groupBy("lang").agg(*sums, chars.alias("n_chars"))
    class_shares = F.array(*[F.col(f"c{k}") / F.col("n_chars") for k in range(len(CLASSES) + 1)])
    classes = classes.select("lang", class_shares.alias("class_shares"))

    top = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("key"))
    best = counts.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= common)
    listed = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", F.xxhash64("key").alias("h"), "n"))).alias("best"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n_words"))
    joined = listed.join(totals, "lang").join(classes, "lang")
    share = F.transform("best", lambda b: b["n"] / F.col("n_words"))
    others = F.col("n_words") - F.aggregate("best", F.lit(0).cast("long"), lambda s, b: s + b["n"])
    rows = joined.select(
        "lang",
        F.transform("best", lambda b: b["h"]).alias("common"),
        F.concat(share, F.array(others / F.col("n_words"))).alias("word_shares"),
        "class_shares",
        F.col("n_words").alias("reference_words"),
    )
    free = f"size(array_distinct(transform(common, x -> {_slot('s')}))) = size(common)"
    rows = rows.withColumn("shift", F.expr(f"get(filter(sequence(0, {64 - SLOT_BITS}), s -> {free}), 0)"))
    rows = rows.withColumn("taken", F.expr(f"transform(common, x -> {_slot('coalesce(shift, 0)')})"))
    slots = f"transform(sequence(0, {(1 << SLOT_BITS) - 1}), k -> cast(array_position(taken, k) as tinyint))"
    return rows.withColumn("slots", F.expr(slots)).drop("taken")


def _slot(shift: str) -> str:
    return f"cast(shiftrightunsigned(x, {shift}) & {(1 << SLOT_BITS) - 1} as int)"


def _term(p: str, q: str) -> str:
    """What a bin adds to twice the divergence of shares p > 0 and q, less q (all q together are 1)."""
    return (
        f"({p} * log2(2 * {p} / ({p} + {q})) + if({q} > 0, {q} * log2(2 * {q} / ({p} + {q})), 0D) - {q})"
    )


def _distance(total: Column) -> Column:
    return F.sqrt(F.greatest((total + 1) / 2, F.lit(0.0)))


def _near(distance: str, limit: float, bins: Column, drawn: str) -> Column:
    chance = (bins - 1) / (8 * F.log(F.lit(2.0)) * F.col(drawn))
    return F.col(distance) * F.col(distance) <= limit * limit + chance


def apply_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    common: int = COMMON,
    reference_words: int = REFERENCE_WORDS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, char_distance, word_distance (null where not compared)."""
    sized = _sized(docs, id_col, text_col, lang_col)
    references = written(language_references(sized, common), "language-references")
    held = references.count() * ((1 << SLOT_BITS) + 40 * common)
    references = F.broadcast(references) if held <= broadcast_bytes else references

    rows = _measured(docs, id_col, text_col, lang_col).join(references, "lang", "left")
    compared = F.coalesce(F.col("reference_words") >= reference_words, F.lit(False))
    # place of each common word, 0 for all others
    found = f"transform(h, x -> named_struct('x', x, 'k', cast(slots[{_slot('shift')}] as int)))"
    found = f"transform(filter({found}, f -> f.k > 0 and common[f.k - 1] = f.x), f -> coalesce(f.k, 0))"
    searched = "filter(transform(h, x -> cast(coalesce(array_position(common, x), 0) as int)), k -> k > 0)"
    places = F.expr(f"sort_array(if(shift is null, {searched}, {found}))")
    by_words = compared & (F.col("n_words") >= MIN_WORDS)
    rows = rows.withColumns(
        {
            "by_chars": compared & (F.col("n_chars") >= MIN_CHARS),
            "by_words": by_words,
            "places": F.when(by_words, places),
        }
    ).drop("h", "slots", "common")

    of_class = "if(c > 0, " + _term("(c / n_chars)", "class_shares[i]") + ", 0D)"
    chars = F.expr(f"aggregate(transform(classes, (c, i) -> {of_class}), 0D, (s, t) -> s + t)")
    # a run of equal places is a bin: its term is added when the next begins, and for the last at the end
    bin_ = _term("(s.run / n_words)", "word_shares[s.last - 1]")
    rest = _term("(r / n_words)", "element_at(word_shares, -1)")
    step = (
        f"if(x = s.last, named_struct('last', x, 'run', s.run + 1, 'sum', s.sum), "
        f"named_struct('last', x, 'run', 1, 'sum', s.sum + if(s.last = 0, 0D, {bin_})))"
    )
    bins = f"aggregate(places, named_struct('last', 0, 'run', 0, 'sum', 0D), (s, x) -> {step}, s -> s.sum + if(s.last = 0, 0D, {bin_}))"
    other = f"aggregate(array(n_words - size(places)), 0D, (z, r) -> if(r > 0, {rest}, 0D))"
    rows = rows.withColumn("word_sum", F.expr(f"{bins} + {other}"))
    rows = rows.withColumns(
        {
            "char_distance": F.when(F.col("by_chars"), _distance(chars)),
            "word_distance": F.when(F.col("by_words"), _distance(F.col("word_sum"))),
        }
    )
    near_chars = _near("char_distance", CHAR_DISTANCE, F.lit(len(CLASSES) + 1), "n_chars")
    near_words = _near("word_distance", WORD_DISTANCE, F.size("word_shares"), "n_words")
    near = F.coalesce(near_chars, F.lit(True)) & F.coalesce(near_words, F.lit(True))
    return rows.select(
        "doc_id",
        *[F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed",
        (~F.col("base_failed") & near).alias("kept"),
        "char_distance",
        "word_distance",
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT id, doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    [length(regexp_replace(t, '[^A-Z]', '', 'g')), length(regexp_replace(t, '[^0-9]', '', 'g')),
     length(regexp_replace(t, '[^.,;:!?''"()\-]', '', 'g')), length(regexp_replace(t, '[\x00-\x7F]', '', 'g')),
     length(regexp_replace(t, '[^\x09-\x0D]', '', 'g')), length(regexp_replace(t, '[^a-z ]', '', 'g'))] AS c FROM d),
runs AS (
  SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS run
  FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM m WHERE len(w) > 2)),
rep AS (
  SELECT id, count(DISTINCT j) AS n FROM (
    SELECT id, unnest([i, i + 1, i + 2]) AS j FROM (SELECT id, i, count(*) OVER (PARTITION BY id, run) AS k FROM runs) WHERE k > 1)
  GROUP BY id),
b AS (
  SELECT m.id, doc_id, lang, w, list_append(c, (length(t) - list_sum(c))::BIGINT) AS c, length(t) AS n_chars, len(w) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words FROM m LEFT JOIN rep USING (id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
lw AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM f WHERE n_words >= 50) GROUP BY ALL),
lt AS (SELECT lang, sum(n) AS total FROM lw GROUP BY lang),
top AS (SELECT * FROM lw QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 64),
wq AS (
  SELECT lang, word, n / total AS q FROM top JOIN lt USING (lang)
  UNION ALL SELECT lang, NULL, (any_value(total) - sum(n)) / any_value(total) FROM top JOIN lt USING (lang) GROUP BY lang),
ck AS (SELECT lang, k, sum(c[k]) AS n FROM f, range(1, 8) r(k) WHERE n_words >= 50 GROUP BY ALL),
cq AS (SELECT lang, k, n / sum(n) OVER (PARTITION BY lang) AS q FROM ck),
dw AS (
  SELECT id, lang, top.word, count(*) AS n
  FROM (SELECT id, lang, unnest(w) AS x FROM f) e LEFT JOIN top USING (lang) WHERE top.word = x GROUP BY ALL),
dr AS (SELECT id, f.lang, NULL::VARCHAR AS word, n_words - coalesce(sum(n), 0) AS n FROM f LEFT JOIN dw USING (id) GROUP BY id, f.lang, n_words),
wd AS (
  SELECT id, sqrt(greatest((sum(CASE WHEN x.n > 0 THEN p * log2(2 * p / (p + q)) + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END - q ELSE 0 END) + 1) / 2, 0)) AS dist
  FROM (SELECT id, lang, word, n, n / n_words AS p FROM (FROM dw UNION ALL FROM dr) u JOIN (SELECT id, n_words FROM f WHERE n_words >= 50) USING (id)) x
  JOIN wq ON wq.lang = x.lang AND wq.word IS NOT DISTINCT FROM x.word GROUP BY id),
cd AS (
  SELECT id, sqrt(greatest((sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END - q ELSE 0 END) + 1) / 2, 0)) AS dist
  FROM (SELECT id, f.lang, k, c[k] / n_chars AS p FROM f, range(1, 8) r(k) WHERE n_chars >= 200) x JOIN cq USING (lang, k) GROUP BY id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (coalesce(total, 0) < 5000 OR (
    coalesce(cd.dist * cd.dist <= 0.28 * 0.28 + 6 / (8 * ln(2) * n_chars), true)
    AND coalesce(wd.dist * wd.dist <= 0.22 * 0.22 + (SELECT count(*) - 1 FROM wq WHERE wq.lang = f.lang) / (8 * ln(2) * n_words), true))) AS kept
FROM f LEFT JOIN lt USING (lang) LEFT JOIN cd USING (id) LEFT JOIN wd USING (id)
"""
