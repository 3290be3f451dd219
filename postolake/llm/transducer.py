"""Weighted acyclic automata over runs of one to three labels.

A ``CountTransducer`` accepts n-grams and gives each the count summed on the
arcs' last step: the arc that reads the last label carries the count of the
n-gram read so far (0 if it is only the beginning of a longer one). It is built
from n-grams in sorted order; a state is closed once the next n-gram leaves its
prefix, and states with equal arcs (labels, counts, targets) are one state.

Labels are 64-bit hashes; a transducer numbers those it uses by its own sorted
``symbols``. All steps are array operations over whole levels.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from . import textvec as tv

ID_BITS = 21  # three numbers of labels in one sort key
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


class Grams(NamedTuple):
    """Sorted distinct n-grams: three label columns (0 = none) and counts."""

    first: np.ndarray
    second: np.ndarray
    third: np.ndarray
    counts: np.ndarray


class Level(NamedTuple):
    """Arcs of the states of one depth: state ``s`` owns ``offsets[s]:offsets[s+1]``."""

    offsets: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    targets: np.ndarray


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + sizes[i] - 1`` of all spans in a row."""
    total = int(sizes.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.repeat(starts - before, sizes) + np.arange(total)


def _closed(level: Level) -> tuple[np.ndarray, Level]:
    """The register: equal states become one. Returns the new number of each state, and the level of those kept."""
    sizes = np.diff(level.offsets)
    n = len(sizes)
    marks = []
    for turn in range(2):
        h = tv.mix(level.labels.astype(np.uint64) * _SALTS[turn] + _SALTS[2 - turn])
        h = tv.mix(h ^ (level.weights.astype(np.uint64) * _SALTS[1 - turn]))
        h = tv.mix(h + level.targets.astype(np.uint64) * _SALTS[2])
        marks.append(tv.segment_sums(h, level.offsets))
    order = np.lexsort((sizes, marks[1], marks[0]))
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (
        (marks[0][order][1:] != marks[0][order][:-1])
        | (marks[1][order][1:] != marks[1][order][:-1])
        | (sizes[order][1:] != sizes[order][:-1])
    )
    number = np.empty(n, dtype=np.int64)
    number[order] = np.cumsum(fresh) - 1
    kept = order[fresh]
    at = _spans(level.offsets[:-1][kept], sizes[kept])
    offsets = np.concatenate([[0], np.cumsum(sizes[kept])])
    return number, Level(offsets, level.labels[at], level.weights[at], level.targets[at])


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted columns, with the end appended."""
    n = len(columns[0])
    if n == 0:
        return np.zeros(1, dtype=np.int64)
    change = np.ones(n, dtype=bool)
    change[1:] = False
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), n)


def _sort_keys(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray | None:
    """One sortable key for each n-gram, if three numbers fit."""
    if max((int(c.max()) for c in (first, second, third) if len(c)), default=0) >= 1 << ID_BITS:
        return None
    key = first.astype(np.uint64)
    for column in (second, third):
        key <<= np.uint64(ID_BITS)
        key |= column.astype(np.uint64)
    return key


def counted(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> Grams:
    """Sorted distinct n-grams and how often each occurs."""
    key = _sort_keys(first, second, third)
    if key is None:
        return summed(first, second, third, np.ones(len(first), dtype=np.int64))
    key.sort()
    at = _runs(key)
    head = key[at[:-1]]
    mask = np.uint64((1 << ID_BITS) - 1)
    parts = [(head >> np.uint64(ID_BITS * k) & mask).astype(np.int64) for k in (2, 1, 0)]
    return Grams(*parts, np.diff(at))


def summed(first: np.ndarray, second: np.ndarray, third: np.ndarray, counts: np.ndarray) -> Grams:
    """Sorted distinct n-grams of unsorted ones, counts added."""
    key = _sort_keys(first, second, third)
    if key is not None:
        order = np.argsort(key, kind="stable")
        at = _runs(key[order])
    else:
        order = np.lexsort((third, second, first))
        at = _runs(*(c[order] for c in (first, second, third)))
    head = order[at[:-1]]
    sums = np.add.reduceat(counts[order], at[:-1]) if len(head) else counts[:0]
    return Grams(first[head], second[head], third[head], sums)


class CountTransducer:
    def __init__(self, symbols: np.ndarray, levels: list[Level]):
        self.symbols = symbols
        self.levels = levels

    @classmethod
    def build(cls, symbols: np.ndarray, grams: Grams) -> CountTransducer:
        """From sorted distinct n-grams over numbers 1.. of ``symbols``."""
        k1, k2, k3, w = grams
        zero = np.zeros(len(w), dtype=np.int64)

        deep = k2 > 0
        pairs = _runs(k1[deep], k2[deep])  # one state of depth 2 for each
        p1, p2, p3, pw = k1[deep], k2[deep], k3[deep], w[deep]
        own = p3[pairs[:-1]] == 0  # the n-gram that ends at the state comes first
        pair_weight = np.where(own, pw[pairs[:-1]], 0)
        arcs = p3 > 0
        upto = np.concatenate([[0], np.cumsum(arcs)])
        number, last = _closed(Level(upto[pairs], p3[arcs], pw[arcs], zero[: int(upto[-1])]))

        heads = _runs(k1)  # one state of depth 1 for each
        first_of_pair = p1[pairs[:-1]]
        offsets = np.searchsorted(first_of_pair, np.append(k1[heads[:-1]], np.iinfo(np.int64).max))
        offsets[-1] = len(first_of_pair)
        upper, middle = _closed(Level(offsets, p2[pairs[:-1]], pair_weight, number))

        root_weight = np.where(k2[heads[:-1]] == 0, w[heads[:-1]], 0)
        root = Level(np.array([0, len(heads) - 1]), k1[heads[:-1]], root_weight, upper)
        return cls(symbols, [root, middle, last])

    def grams(self) -> Grams:
        """All n-grams in order, over numbers of ``symbols``; beginnings without a count of their own are left out."""
        root, middle, last = self.levels
        deg1 = np.diff(middle.offsets)[root.targets]
        a2 = _spans(middle.offsets[:-1][root.targets], deg1)
        f2 = np.repeat(root.labels, deg1)
        deg2 = np.diff(last.offsets)[middle.targets[a2]]
        a3 = _spans(last.offsets[:-1][middle.targets[a2]], deg2)
        f3 = np.repeat(f2, deg2)
        s3 = np.repeat(middle.labels[a2], deg2)
        first = np.concatenate([root.labels, f2, f3])
        second = np.concatenate([np.zeros_like(root.labels), middle.labels[a2], s3])
        third = np.concatenate([np.zeros_like(root.labels), np.zeros_like(f2), last.labels[a3]])
        weights = np.concatenate([root.weights, middle.weights[a2], last.weights[a3]])
        live = weights > 0
        return summed(first[live], second[live], third[live], weights[live])

    def hashes(self, numbers: np.ndarray) -> np.ndarray:
        """Labels of the numbers 1..; 0 stays 0."""
        return np.concatenate([np.zeros(1, dtype=np.uint64), self.symbols])[numbers]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of labels; 0 for 0, -1 for labels it does not use."""
        at = np.searchsorted(self.symbols, hashes)
        known = at < len(self.symbols)
        known[known] = self.symbols[at[known]] == hashes[known]
        return np.where(hashes == 0, 0, np.where(known, at + 1, -1)).astype(np.int64)

    def compose(self, *columns: np.ndarray) -> np.ndarray:
        """Counts of n-grams given as one to three columns of 64-bit labels (0 = none); 0 if not accepted.

        The n-grams are read as an acceptor and composed with this transducer
        level by level: in every state at once the arc of the next label is
        found by bisection among the state's sorted arcs.
        """
        n = len(columns[0])
        state = np.zeros(n, dtype=np.int64)
        alive = np.ones(n, dtype=bool)
        found = np.zeros(n, dtype=np.int64)
        for level, column in zip(self.levels, columns):
            label = self.numbers(column)
            reads = alive & (label != 0)
            found[reads] = 0
            low, high = level.offsets[:-1][state[reads]], level.offsets[1:][state[reads]]
            end, want = high.copy(), label[reads]
            while True:
                open_ = low < high
                if not open_.any():
                    break
                middle = (low + high) >> 1
                less = open_.copy()
                less[open_] = level.labels[middle[open_]] < want[open_]
                low = np.where(less, middle + 1, low)
                high = np.where(open_ & ~less, middle, high)
            hit = low < end
            hit[hit] = level.labels[low[hit]] == want[hit]
            at = np.flatnonzero(reads)[hit]
            found[at] = level.weights[low[hit]]
            state[at] = level.targets[low[hit]]
            alive &= label != 0
            alive[np.flatnonzero(reads)[~hit]] = False
        return found

    def to_bytes(self) -> bytes:
        arrays = [self.symbols]
        for level in self.levels:
            # offsets as sizes, labels as steps: small numbers
            arrays += [np.diff(level.offsets), level.labels, level.weights, level.targets]
        head, body = [], []
        for a in arrays:
            small = a if a.dtype == np.uint64 else a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))
            head += [len(small), small.dtype.itemsize]
            body.append(small.tobytes())
        raw = np.array(head, dtype=np.int64).tobytes() + b"".join(body)
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, blob: bytes) -> CountTransducer:
        raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
        head = np.frombuffer(raw, dtype=np.int64, count=26).reshape(13, 2)
        arrays, at = [], head.nbytes
        for size, width in head:
            arrays.append(np.frombuffer(raw, dtype=f"<u{width}", count=size, offset=at))
            at += int(size * width)
        levels = []
        for k in range(3):
            sizes, labels, weights, targets = (a.astype(np.int64) for a in arrays[1 + 4 * k : 5 + 4 * k])
            levels.append(Level(np.concatenate([[0], np.cumsum(sizes)]), labels, weights, targets))
        return cls(arrays[0].astype(np.uint64), levels)


def of_hashes(first: np.ndarray, second: np.ndarray, third: np.ndarray, counts: np.ndarray) -> CountTransducer:
    """Transducer of n-grams given by 64-bit labels, in any order; counts of equal ones are added."""
    symbols = np.unique(np.concatenate([first, second, third]))
    symbols = symbols[symbols != 0]
    numbers = [np.where(c == 0, 0, np.searchsorted(symbols, c) + 1).astype(np.int64) for c in (first, second, third)]
    return CountTransducer.build(symbols, summed(*numbers, counts))


def restricted(whole: CountTransducer, grams: Grams) -> CountTransducer:
    """Transducer of some of the n-grams of ``whole``, with just the symbols they use."""
    used = np.zeros(len(whole.symbols) + 1, dtype=bool)
    for column in grams[:3]:
        used[column] = True
    used[0] = False
    number = np.cumsum(used) * used
    return CountTransducer.build(whole.symbols[used[1:]], Grams(*(number[c] for c in grams[:3]), grams.counts))


def union(parts: list[CountTransducer], least: int = 1) -> CountTransducer:
    """One transducer of all parts, counts of equal n-grams added; those below ``least`` are left out.

    A beginning is at least as frequent as what it begins, so leaving out by
    count never cuts a kept n-gram off its beginnings.
    """
    symbols = np.unique(np.concatenate([t.symbols for t in parts]))
    columns = []
    for t in parts:
        number = np.concatenate([[0], np.searchsorted(symbols, t.symbols) + 1])
        g = t.grams()
        columns.append((number[g.first], number[g.second], number[g.third], g.counts))
    grams = summed(*(np.concatenate(c) for c in zip(*columns)))
    keep = grams.counts >= least
    kept = Grams(*(c[keep] for c in grams))
    return restricted(CountTransducer(symbols, []), kept)
