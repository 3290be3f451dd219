from __future__ import annotations

import itertools
import random
import zlib

import numpy as np

from postolake.llm.langid import UNDETERMINED, _marginals, identify, with_language

SOUNDS = {"aa": ["ka", "to", "mi", "ra"], "bb": ["sch", "ung", "ein", "ker"], "cc": ["eau", "oux", "ell", "ñi"]}


def _word(lang, rng):
    return "".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4)))


def _rows(n=150):
    rng = random.Random(0)
    langs = sorted(SOUNDS)
    return [(k, " ".join(_word(langs[k % 3], rng) for _ in range(rng.randrange(3, 60))).title(), langs[k % 3]) for k in range(n)]


def _held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy(docs):
    rows = _rows()
    out = {r["doc_id"]: r for r in identify(docs(rows)).collect()}
    assert len(out) == len(rows) and all(out[d]["held_out"] == _held(d) for d, _, _ in rows)
    held = [d for d, _, _ in rows if _held(d)]
    assert sum(out[d]["lang_pred"] == rows[d][2] for d in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_labels_source_and_id_are_not_inputs_of_a_prediction(docs):
    rows = _rows()
    plain = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(docs(rows)).collect()}
    other = [(d, t, ("zz" if _held(d) else lang), f"src{d}") for d, t, lang in rows]
    changed = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(docs(other)).collect()}
    assert plain == changed


def test_texts_without_letters_and_odd_rows(docs):
    rng = random.Random(1)
    half = [_word("aa", rng) for _ in range(40)] + [_word("bb", rng) for _ in range(15)]
    odd = [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !? ٠", "aa"), (903, "€€", None), (904, "漢字", None), (None, "kato mira", "aa")]
    odd += [(905, " ".join(half), None), (906, "kato " * 60_000, None), (907, "7 kato 7", None), (907, "7 kato 7", None), (908, "ñ", None)]
    out = {}
    for r in identify(docs(_rows() + odd)).collect():
        out.setdefault(r["doc_id"], []).append(r)
    for d in (900, 901, 902, 903):
        assert [(r["lang_pred"], r["score"]) for r in out[d]] == [(UNDETERMINED, 0.0)]
    assert out[904][0]["lang_pred"] in SOUNDS and out[908][0]["lang_pred"] in SOUNDS
    assert out[None][0]["held_out"] and out[None][0]["lang_pred"] == "aa"
    assert out[905][0]["lang_pred"] == "aa" and 0.5 < out[905][0]["score"] < 0.95  # switched text is followed word by word
    assert out[906][0]["lang_pred"] == "aa" and len(out[907]) == 2


def test_nothing_to_learn_from(docs):
    assert identify(docs([])).collect() == []
    assert [r["lang_pred"] for r in identify(docs([(1, "kato", None), (2, None, None)])).collect()] == [UNDETERMINED] * 2


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    scores, start, change = rng.standard_normal((7, 3)), rng.standard_normal(3), rng.standard_normal((3, 3))
    offsets = np.array([0, 4, 4, 7])
    got = _marginals(scores, offsets, start, change)
    for a, b in zip(offsets, offsets[1:]):
        want, total = np.zeros((b - a, 3)), 0.0
        for path in itertools.product(range(3), repeat=b - a):
            if not path:
                continue
            s = start[path[0]] + sum(scores[a + i, y] for i, y in enumerate(path)) + sum(change[x, y] for x, y in zip(path, path[1:]))
            total += np.exp(s)
            for i, y in enumerate(path):
                want[i, y] += np.exp(s)
        assert a == b or np.allclose(got[a:b], want / total)


def test_filter_keeps_rows_with_a_language(docs):
    rows = _rows(60) + [(900, None, "aa"), (901, "12 34", "aa"), (902, "kato", None)]
    frame = docs(rows)
    kept = with_language(frame)
    assert kept.schema.names == frame.schema.names
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {d for d, _, _ in rows} - {900, 901}
    assert with_language(docs([(1, "!!", None)])).count() == 1  # nothing learned, nothing judged
