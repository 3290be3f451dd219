from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from postolake.llm import textvec as tv

from .helpers import words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 \n.é漢\x00~", max_size=40)), max_size=6)


def _tokens(texts, table=tv.ALNUM):
    offsets, data = tv.utf8(pa.array(texts, pa.string()))
    data = tv.FOLD[data]
    t = tv.tokenize(offsets, data, table)
    found = [data[s:e].tobytes().decode() for s, e in zip(t.starts, t.ends)]
    return [found[a:b] for a, b in zip(t.offsets, t.offsets[1:])], t


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_equal_the_regular_expression(texts):
    assert _tokens(texts)[0] == [words(t) for t in texts]
    blank = [re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for t in texts]
    assert _tokens(texts, tv.BLANK_SPLIT)[0] == blank


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes_and_others_differ(texts):
    per_text, t = _tokens(texts)
    flat = [w for ws in per_text for w in ws]
    assert len(set(flat)) == len(set(t.hashes.tolist()))
    assert len(set(zip(flat, t.hashes.tolist()))) == len(set(flat))


def test_long_words_and_sliced_columns():
    long = "x" * (tv.LONG_TOKEN + 50)
    per_text, t = _tokens([long + " a", "a " + long, long + "y"])
    assert t.hashes[0] == t.hashes[3] and t.hashes[1] == t.hashes[2] and t.hashes[4] != t.hashes[0]
    offsets, data = tv.utf8(pa.array(["ab", "cd", "ef"]).slice(1, 2))
    assert data.tobytes() == b"cdef" and offsets.tolist() == [0, 2, 4]


def test_shingles_cover_short_texts():
    _, t = _tokens(["", "a", "a b c", "a b c d e", "a b c d e f"])
    at, h = tv.shingles(t.offsets, t.hashes, 5)
    assert np.diff(at).tolist() == [0, 1, 1, 1, 2]
    assert h[2] == h[3]  # both start with a b c d e
    assert len(set(h.tolist())) == 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=8), max_size=6))
def test_sets_and_ranks(groups):
    offsets = np.concatenate([[0], np.cumsum([len(g) for g in groups])]).astype(np.int64)
    values = tv.mix(np.array([x for g in groups for x in g], dtype=np.uint64))
    at, sets = tv.sorted_sets(offsets, values)
    for g, a, b in zip(groups, at, at[1:]):
        assert sets[a:b].tolist() == sorted({int(tv.mix(np.array([x], dtype=np.uint64))[0]) for x in g})
    rank = (sets % np.uint64(3)).astype(np.int64)
    out = tv.ranked(at, sets, rank, 20)
    for a, b in zip(at, at[1:]):
        assert out[a:b].tolist() == sorted(sets[a:b].tolist(), key=lambda v: (v % 3, v))


def test_chunks_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * k for k in range(50)]})
    parts = list(tv.text_chunks([batch], "text", limit=100))
    assert sum(p.num_rows for p in parts) == 50 and len(parts) > 5
