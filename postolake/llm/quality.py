"""Quality classifier with hierarchical empirical Bayes over host and path.

Evidence of a document is a naive Bayes log-likelihood ratio over a few text
statistics, each cut into ``BINS`` bins; the bin counts come from all labelled
rows by one grouped aggregation. With the global share of good documents as
prior this gives every document, labelled or not, a first probability.

Hosts and paths (groups inside a host) then get posterior shares: the sum of
first probabilities of a host is shrunk toward the global share, that of a path
toward its host's posterior, with Beta prior strengths estimated by the method
of moments from the spread between groups. The document's own contribution is
taken out of its group, so it does not count twice. Sparse sites stay near the
level above, large sites move to their own share. The final log-odds are the
evidence plus the log-odds of the path's posterior.

Null texts count as empty. A null host or path is a group of its own. Without
labels of both kinds the evidence is 0 and every share is the prior 0.5 (or
the only label seen, smoothed). Repeated rows count each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .scratch import written

BINS = 12
FEATURES = ("symbols", "upper", "digits", "word_length", "distinct", "repeats", "bare_ends", "size")
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6


def _byte_share(data: np.ndarray, offsets: np.ndarray, low: int, high: int, size: np.ndarray) -> np.ndarray:
    return tv.segment_sums(((data >= low) & (data <= high)).astype(np.int64), offsets) / size


def _statistics(batches):
    for batch in tv.text_chunks(batches, "text"):
        offsets, data = tv.utf8(batch.column("text"))
        size = np.maximum(np.diff(offsets), 1)
        upper = _byte_share(data, offsets, 65, 90, size)
        lower = _byte_share(data, offsets, 97, 122, size)
        digits = _byte_share(data, offsets, 48, 57, size)
        ascii_ = _byte_share(data, offsets, 33, 126, size)
        tokens = tv.tokenize(offsets, data, tv.BLANK_SPLIT)
        n = np.maximum(np.diff(tokens.offsets), 1)
        length = tv.segment_sums(tokens.ends - tokens.starts, tokens.offsets) / n
        distinct = np.diff(tv.sorted_sets(tokens.offsets, tokens.hashes)[0]) / n
        same = np.zeros(len(tokens.hashes), dtype=np.int64)
        same[1:] = tokens.hashes[1:] == tokens.hashes[:-1]
        starts = tokens.offsets[:-1]
        same[starts[starts < len(same)]] = 0
        repeats = tv.segment_sums(same, tokens.offsets) / n
        last = data[tokens.ends - 1] if len(tokens.ends) else data
        bare = np.isin(last, np.frombuffer(b"!%$&#*|", dtype=np.uint8)).astype(np.int64)
        bare = tv.segment_sums(bare, tokens.offsets) / n
        # short texts have few distinct-word chances, so the ratio is compared at its square root of size
        scaled = np.clip((1 - distinct) * 4 / np.log2(n + 2) * 2, 0, 0.999)
        shares = [
            np.sqrt(np.clip(ascii_ - upper - lower - digits, 0, 0.999)),
            np.sqrt(np.clip(upper, 0, 0.999)),
            np.sqrt(np.clip(digits, 0, 0.999)),
            np.clip(length / 24, 0, 0.999),
            scaled,
            np.sqrt(np.clip(repeats, 0, 0.999)),
            np.sqrt(np.clip(bare, 0, 0.999)),
            np.clip(np.log2(n + 1) / 20, 0, 0.999),
        ]
        bins = np.column_stack([(s * BINS).astype(np.int32) for s in shares])
        cells = pa.FixedSizeListArray.from_arrays(pa.array(bins.reshape(-1)), len(FEATURES)).cast(pa.list_(pa.int32()))
        kept = [k for k, c in enumerate(batch.schema.names) if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in kept), cells], names=[*(batch.schema.names[k] for k in kept), "bins"]
        )


def _evidence(labelled: DataFrame) -> tuple[np.ndarray, float]:
    """(feature, bin) log-likelihood ratios and the smoothed share of good rows."""
    counts = (
        labelled.select("good", F.posexplode("bins").alias("f", "b"))
        .groupBy("f", "b")
        .agg(F.count_if(F.col("good")).alias("g"), F.count_if(~F.col("good")).alias("p"))
        .collect()
    )  # at most one row per feature and bin
    table = np.zeros((len(FEATURES), BINS, 2))
    for r in counts:
        table[r["f"], r["b"]] = r["g"], r["p"]
    good, poor = table[0].sum(axis=0)
    share = (good + 1) / (good + poor + 2)
    if good == 0 or poor == 0:
        return np.zeros((len(FEATURES), BINS)), float(share)
    smooth = table + 0.5
    return np.log(smooth[..., 0] / (good + 0.5 * BINS)) - np.log(smooth[..., 1] / (poor + 0.5 * BINS)), float(share)


def _strength(groups: DataFrame, centre: Column) -> float:
    """Beta prior strength by moments: m(1-m)/variance between groups - 1, from groups of at least two rows."""
    rate = F.col("s") / F.col("n")
    spread = F.greatest((rate - centre) * (rate - centre) - rate * (1 - rate) / F.col("n"), F.lit(0.0))
    row = (
        groups.where("n > 1")
        .agg((F.sum(F.col("n") * spread) / F.sum("n")).alias("var"), (F.sum(F.col("n") * centre * (1 - centre)) / F.sum("n")).alias("top"))
        .first()
    )
    if row["var"] is None or row["top"] is None or row["var"] <= 0:
        return MAX_STRENGTH if row["var"] is not None else MIN_STRENGTH
    return float(min(max(row["top"] / row["var"] - 1, MIN_STRENGTH), MAX_STRENGTH))


def _logit(p: Column) -> Column:
    q = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(q / (1 - q))


def _chance(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def classify(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """doc_id, labelled, evidence, first, host_share, path_share, quality (probability), keep (quality >= 0.5).

    ``labels`` has (id, 0/1); ids with several labels count as good if any is.
    """
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).alias("good"))
    texts = docs.select(
        F.col(id_col).alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(text_col).alias("text")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    measured = texts.mapInArrow(_statistics, f"doc_id {kind}, host string, path string, bins array<int>")
    rows = written(measured.join(known, F.col("doc_id") == F.col("_id"), "left").drop("_id"), "quality-rows")
    ratios, share = _evidence(rows.where("good is not null"))
    tables = [F.array(*(F.lit(float(x)) for x in line)) for line in ratios]
    evidence = sum((F.get(t, F.get("bins", F.lit(k))) for k, t in enumerate(tables)), F.lit(0.0))
    logit = float(np.log(share / (1 - share)))
    scored = rows.select("doc_id", "host", "path", F.col("good").isNotNull().alias("labelled"), evidence.alias("evidence"))
    scored = scored.withColumn("first", _chance(F.col("evidence") + F.lit(logit)))
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("first").alias("s"))
    paths = written(paths, "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    host_strength = _strength(hosts, F.lit(share))
    shrunk = hosts.withColumn("host_share", (F.col("s") + F.lit(host_strength * share)) / (F.col("n") + F.lit(host_strength)))
    above = shrunk.select(F.col("host").alias("_host"), F.col("n").alias("host_n"), F.col("s").alias("host_s"), "host_share")
    sites = paths.join(above, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    path_strength = _strength(sites, F.col("host_share"))
    sites = sites.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), "n", "s", "host_n", "host_s", "host_share"
    )
    joined = scored.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    # shares without the document itself
    of_host = (F.col("host_s") - F.col("first") + F.lit(host_strength * share)) / (F.col("host_n") - 1 + F.lit(host_strength))
    of_path = (F.col("s") - F.col("first") + F.lit(path_strength) * of_host) / (F.col("n") - 1 + F.lit(path_strength))
    quality = _chance(F.col("evidence") + _logit(of_path))
    return joined.select(
        "doc_id",
        "labelled",
        "evidence",
        "first",
        of_host.alias("host_share"),
        of_path.alias("path_share"),
        quality.alias("quality"),
        (quality >= 0.5).alias("keep"),
    )
