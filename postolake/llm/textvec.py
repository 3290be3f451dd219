"""Tokens of whole Arrow text columns as numpy arrays.

The operators that need words inside Python tasks read the UTF-8 buffer of an
Arrow column once and work on arrays of token hashes; no Python object is made
per word. All separator classes used here are ASCII, so every byte of a
multi-byte character is a word byte and byte-level splitting is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_MUL1 = np.uint64(0xFF51AFD7ED558CCD)
_MUL2 = np.uint64(0xC4CEB9FE1A85EC53)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)
LONG_TOKEN = 256  # bytes; longer tokens are hashed one by one

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def _class(separators: list[int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[separators] = False
    return table


# [^\x20\x09-\x0D]+
BLANK_SPLIT = _class([0x20, *range(0x09, 0x0E)])
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (text already folded to lower case)
ALNUM = _class([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


class Tokens(NamedTuple):
    """``offsets[i]:offsets[i+1]`` are the tokens of text ``i``; byte positions index the chunk's data."""

    offsets: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (int64, one more than rows) and bytes of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(len(column) + 1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    kind = np.int64 if wide else np.int32
    positions = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[positions[0] : positions[-1]]
    return positions - positions[0], raw


def text_chunks(batches, column: str, limit: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches holding about ``limit`` bytes of text (at least one row each)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        offsets, _ = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _SHIFT)
    h = h * _MUL1
    h ^= h >> np.uint64(29)
    h *= _MUL2
    h ^= h >> _SHIFT
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes a step over all spans at once."""
    lengths = ends - starts
    out = mix(lengths.astype(np.uint64) + _GOLD)
    if len(starts) == 0:
        return out
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    live = np.flatnonzero(lengths <= LONG_TOKEN)
    at, left = starts[live], lengths[live]
    whole = len(live) == len(starts)
    h = out if whole else out[live]
    while len(live):
        w = words[at]
        short = left < 8
        if short.any():
            keep = np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - left[short]) * 8).astype(np.uint64)
            w[short] &= keep
        h = (h ^ w) * _MUL1
        h ^= h >> _SHIFT
        more = left > 8
        done = ~more
        out[live[done]] = h[done]
        live, at, left, h = live[more], at[more] + 8, left[more] - 8, h[more]
    for i in np.flatnonzero(lengths > LONG_TOKEN):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, dtype="<u8")[0]
    return mix(out)


def tokenize(offsets: np.ndarray, data: np.ndarray, table: np.ndarray, breaks: np.ndarray | None = None) -> Tokens:
    """Maximal runs of word bytes, never across the given text offsets."""
    if len(data) == 0:
        empty = np.zeros(0, dtype=np.int64)
        return Tokens(np.zeros(len(offsets), dtype=np.int64), np.zeros(0, dtype=np.uint64), empty, empty)
    inside = table[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    after[lasts] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Tokens(np.searchsorted(starts, offsets), span_hashes(data, starts, ends), starts, ends)


def owners(offsets: np.ndarray) -> np.ndarray:
    """Row number of each element under CSR offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def shingles(offsets: np.ndarray, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` tokens; a text of 1..k-1 tokens is one shingle. Returns (offsets, hashes)."""
    counts = np.diff(offsets)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out_offsets = np.concatenate([[0], np.cumsum(sizes)])
    total = int(out_offsets[-1])
    if total == 0:
        return out_offsets, np.zeros(0, dtype=np.uint64)
    owner = owners(out_offsets)
    first = offsets[owner] + (np.arange(total) - out_offsets[owner])
    width = np.minimum(counts[owner], k)
    out = width.astype(np.uint64) * _GOLD
    padded = np.concatenate([hashes, np.zeros(k, dtype=np.uint64)])
    full = not (width < k).any()
    for j in range(k):
        step = padded[first + j] if full else np.where(j < width, padded[first + j], np.uint64(0))
        out = (out ^ step) * _MUL1
        out ^= out >> _SHIFT
    return out_offsets, mix(out)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each CSR segment (wrapping for unsigned integers), zero for empty ones."""
    out = np.zeros(len(offsets) - 1, dtype=values.dtype)
    filled = np.diff(offsets) > 0
    if filled.any():
        out[filled] = np.add.reduceat(values, offsets[:-1][filled])
    return out


def _packed_order(owner: np.ndarray, count: int, keys: list[tuple[np.ndarray, int]], hashes: np.ndarray) -> np.ndarray:
    """Order by (owner, keys..., hash) from one sort of packed 64-bit keys.

    ``keys`` come with their widths in bits; the hash fills the rest. If two
    different hashes share a packed key, the whole order is sorted in full.
    """
    free = 64 - max(count - 1, 1).bit_length()
    if free - sum(w for _, w in keys) < 16:
        return np.lexsort((hashes, *(k for k, _ in reversed(keys)), owner))
    packed = owner.astype(np.uint64) << np.uint64(free)
    for key, width in keys:
        free -= width
        packed |= key.astype(np.uint64) << np.uint64(free)
    packed |= hashes >> np.uint64(64 - free)
    order = np.argsort(packed)
    p, h = packed[order], hashes[order]
    if ((p[1:] == p[:-1]) & (h[1:] != h[:-1])).any():
        return np.lexsort((hashes, *(k for k, _ in reversed(keys)), owner))
    return order


def sorted_sets(offsets: np.ndarray, hashes: np.ndarray, owner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each segment, ascending. Returns (offsets, hashes)."""
    owner = owners(offsets) if owner is None else owner
    count = len(offsets) - 1
    order = _packed_order(owner, count, [], hashes)
    h, o = hashes[order], owner[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[keep], o[keep]
    return np.concatenate([[0], np.cumsum(np.bincount(o, minlength=count))]), h


def ranked(offsets: np.ndarray, hashes: np.ndarray, rank: np.ndarray, width: int) -> np.ndarray:
    """The hashes of each segment ordered by (rank, hash); ranks above ``2**width - 1`` count as that."""
    top = np.minimum(rank, (1 << width) - 1)
    return hashes[_packed_order(owners(offsets), len(offsets) - 1, [(top, width)], hashes)]


def binary_rows(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    """One binary cell per CSR segment, holding the segment's raw values."""
    raw = np.ascontiguousarray(values)
    return pa.Array.from_buffers(
        pa.binary(),
        len(offsets) - 1,
        [None, pa.py_buffer((offsets * raw.dtype.itemsize).astype(np.int32)), pa.py_buffer(raw)],
    )
