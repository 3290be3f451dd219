from __future__ import annotations

import random
from collections import Counter

from postolake.llm.licenses import TEMPLATES, scan_licenses

from .helpers import edited, prose, words


def _best(text, template, d=0.8):
    w, t = words(text), words(template)
    bag = Counter(zip(t, t[1:]))
    grams = list(zip(w, w[1:]))
    b, best = sum(bag.values()), 0.0
    for i in range(len(grams)):
        seen = Counter()
        for j in range(i, min(len(grams), i + int(b * (2 - d) / d) + 1)):
            seen[grams[j]] += 1
            best = max(best, 2 * sum(min(n, bag[g]) for g, n in seen.items()) / (j - i + 1 + b)) if b else best
    return best if best >= d else None


def test_best_passages_match_brute_force(docs):
    rng = random.Random(0)
    templates = {"short": "alpha beta gamma delta", "long": prose(5, 30, 50), "twice": "a b a b a b c", "word": "solo"}
    rows = []
    for k in range(60):
        base = templates[rng.choice(list(templates))]
        rows.append((k, f"{prose(k, rng.randrange(0, 30), 50)}. {edited(base, k, 0.08).title()}, {prose(k + 99, 20, 50)}"))
    rows += [(100, None), (101, ""), (102, "solo"), (103, "a b " * 300 + "a b a b a b c"), (103, "alpha beta gamma delta")]
    out = {}
    for r in scan_licenses(docs(rows), templates).collect():
        out.setdefault(r["doc_id"], []).append({m["license"]: m["dice"] for m in r["matches"]})
        if r["matches"]:
            assert r["license"] == r["matches"][0]["license"] and r["dice"] == max(m["dice"] for m in r["matches"])
        else:
            assert r["license"] is None and r["dice"] is None
    for doc_id, text in rows:
        expected = {n: s for n, t in templates.items() if (s := _best(text, t))}
        assert any(set(got) == set(expected) and all(abs(got[n] - s) < 1e-12 for n, s in expected.items()) for got in out[doc_id])


def test_notices_of_the_default_templates(docs):
    rows = [(k, f"{prose(k, 200)}\n{text}\n{prose(k + 50, 100)}") for k, text in enumerate(TEMPLATES.values())]
    found = {r["doc_id"]: r for r in scan_licenses(docs(rows)).collect()}
    for k, name in enumerate(TEMPLATES):
        assert found[k]["dice"] == 1.0  # a long text may hold a shorter notice whole
        m = next(m for m in found[k]["matches"] if m["license"] == name)
        assert m["dice"] == 1.0
        assert m["first_word"] == 200 and m["n_words"] == len(words(TEMPLATES[name]))


def test_empty_table(docs):
    assert scan_licenses(docs([])).collect() == []
    assert scan_licenses(docs(["any text"]), {}).collect()[0]["license"] is None
