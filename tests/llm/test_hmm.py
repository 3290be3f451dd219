from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from postolake.llm import chains, hmm

from .helpers import fold, prose


def _tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", fold(text)), "\0end"]


def _held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 1


def _rows():
    rng = random.Random(0)
    rows = []
    for k in range(120):
        lang = k % 2
        rows.append((k, " ".join(f"{'ab'[lang]}{min(rng.randrange(40), rng.randrange(40))}{rng.choice(['', ',', '.'])}" for _ in range(rng.randrange(5, 120)))))
    return rows + [(500, None), (501, ""), (502, " \n\t"), (None, "a1 a2"), (503, "é É 漢 A a"), (504, "a3 " * 30_000), (7, "a1 b1"), (7, "a1 b1"), (7, "x")]


def test_base_scores_and_counts(docs):
    rows = _rows()
    counts = Counter(t for d, text in rows if not _held(d) for t in _tokens(text))
    n, v = sum(counts.values()), len(counts)
    expected = []
    for d, text in rows:
        t = _tokens(text)
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)
        expected.append((str(d), _held(d), len(t), sum(counts[x] > 0 for x in t), n, round(base, 6)))
    out = hmm.score_texts(docs(rows), iterations=1).collect()
    assert sorted((str(r[0]), *r[1:5], round(r["base_score"], 6)) for r in out) == sorted(expected)


def test_rare_classes_carry_exact_counts(docs, monkeypatch):
    rows = [(k, prose(k, 40, 60)) for k in range(40)]
    full = {r["doc_id"]: r["base_score"] for r in hmm.score_texts(docs(rows), iterations=0).collect()}
    counts = Counter(t for d, text in rows if not _held(d) for t in _tokens(text))
    n, v = sum(counts.values()), len(counts)
    for d, text in rows:
        assert abs(full[d] - sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in _tokens(text))) < 1e-6


def test_model_beats_the_base_on_held_out_texts(docs):
    out = [r for r in hmm.score_texts(docs(_rows())).collect() if r["held_out"] and r["n_tokens"] > 10]
    assert out and sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_forward_matches_enumeration():
    rng = np.random.default_rng(0)
    start, move, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), size=3), rng.random((5, 3))
    offsets = np.array([0, 4, 4, 5, 11])
    codes = rng.integers(0, 5, 11)
    lay = chains.layout(offsets)
    alpha, norm = chains.forward(emit[codes[lay.order]], lay, start, move)
    logs = np.log(norm)[lay.place]
    for a, b in zip(offsets, offsets[1:]):
        if a == b:
            continue
        state = start * emit[codes[a]]
        for c in codes[a + 1 : b]:
            state = (state @ move) * emit[c]
        assert abs(logs[a:b].sum() - math.log(state.sum())) < 1e-9


def test_expected_counts_match_enumeration():
    rng = np.random.default_rng(1)
    start, move, emit = rng.dirichlet(np.ones(2)), rng.dirichlet(np.ones(2), size=2), rng.random((4, 2))
    offsets, codes = np.array([0, 5, 8]), rng.integers(0, 4, 8)
    lay = chains.layout(offsets)
    e = emit[codes[lay.order]]
    alpha, norm = chains.forward(e, lay, start, move)
    gamma, moves = chains.backward(e, alpha, norm, lay, move)
    gamma = gamma[lay.place]
    want_gamma, want_moves = np.zeros((8, 2)), np.zeros((2, 2))
    for a, b in zip(offsets, offsets[1:]):
        paths = {}
        for bits in range(2 ** (b - a)):
            path = [(bits >> i) & 1 for i in range(b - a)]
            p = start[path[0]] * emit[codes[a], path[0]]
            for i in range(1, b - a):
                p *= move[path[i - 1], path[i]] * emit[codes[a + i], path[i]]
            paths[tuple(path)] = p
        total = sum(paths.values())
        for path, p in paths.items():
            for i, s in enumerate(path):
                want_gamma[a + i, s] += p / total
                if i:
                    want_moves[path[i - 1], s] += p / total
    assert np.allclose(gamma, want_gamma) and np.allclose(moves, want_moves)


def test_iterations_raise_the_training_likelihood(docs):
    frame = docs([(k, t) for k, t in _rows()[:120]])
    score = [sum(r["score"] for r in hmm.score_texts(frame, iterations=i).collect() if not r["held_out"]) for i in (0, 1, 4)]
    assert score[0] < score[1] < score[2]


def test_empty_table_and_nothing_to_learn_from(docs):
    assert hmm.score_texts(docs([])).collect() == []
    only = hmm.score_texts(docs([(None, "a b")])).collect()
    assert only[0]["n_known"] == 0 and only[0]["train_tokens"] == 0 and only[0]["base_score"] == 0.0
    assert math.isfinite(only[0]["score"])
