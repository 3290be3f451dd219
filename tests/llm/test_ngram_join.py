from __future__ import annotations

from math import comb

from postolake.llm.ngram_join import min_matches, ngram_jaccard_join, one_of_each_class

from .helpers import edited, prose, words


def _expected(rows):
    seqs = [tuple(words(t)) for _, t in rows]
    sets = {s: {s[i : i + 5] for i in range(max(1, len(s) - 4))} for s in seqs if s}
    links = {a: {b for b in sets if b != a and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])} for a in sets}
    out = []
    for (doc_id, _), s in zip(rows, seqs):
        if not s:
            out.append((doc_id, doc_id, 0, 0))
            continue
        seen, todo = {s}, [s]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        ids = [d for (d, _), x in zip(rows, seqs) if x in seen and d is not None]
        out.append((doc_id, min(ids, default=None), len(links[s]), sum(x == s for x in seqs) - 1))
    return sorted(out, key=str)


def _result(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def _corpus():
    rows, n = [], 0
    for g in range(12):
        base = prose(g, 120 + 10 * g)
        for e in range(6):
            rows.append((n, edited(base, 100 * g + e, 0.01 * e)))
            n += 1
        rows.append((n, base.upper() + "!"))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "..."), (n + 3, "one two"), (n + 4, "One, two"), (None, "one two"), (n + 5, "one two")]
    rows += [(n + 5, "one two"), (None, "only without id"), (n + 6, "x " * 30_000)]
    return rows


def test_links_and_classes_match_brute_force(docs):
    rows = _corpus()
    assert _result(ngram_jaccard_join(docs(rows))) == _expected(rows)


def test_hot_group_of_near_copies(docs):
    base = prose(1, 60)
    rows = [(k, edited(base, k, 0.02)) for k in range(150)] + [(1000 + k, base) for k in range(50)]
    assert _result(ngram_jaccard_join(docs(rows))) == _expected(rows)


def test_empty_table_and_extra_columns(docs, spark):
    empty = docs([])
    assert ngram_jaccard_join(empty).collect() == []
    assert one_of_each_class(empty).collect() == []
    frame = spark.createDataFrame([(1, "a b c d e f", 5, "x"), (2, "a b c d e f", 6, "y")], "doc_id long, text string, id long, band string")
    assert _result(ngram_jaccard_join(frame)) == [(1, 1, 0, 1), (2, 1, 0, 1)]
    assert one_of_each_class(frame).collect() == [frame.collect()[0]]
    twice = spark.createDataFrame([(5, "a b c d e f"), (5, "A b c d e f"), (5, "something else here"), (6, "a b c d e f")], "doc_id long, text string")
    kept = sorted(r["text"].lower() for r in one_of_each_class(twice).collect())
    assert kept == ["a b c d e f", "something else here"]


def test_one_document_of_each_class_stays(docs):
    rows = _corpus()
    kept = one_of_each_class(docs(rows))
    assert kept.columns == docs(rows).columns
    expected = {c for d, c, _, _ in _expected(rows) if c is not None}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == 1  # the class without any id


def test_posterior_bound():
    # smallest m with P(Bin(n + 1, t) <= m) >= tolerance
    n, t, tol = 24, 0.8, 1e-5
    tail = lambda m: sum(comb(n + 1, i) * t**i * (1 - t) ** (n + 1 - i) for i in range(m + 1))
    m = min_matches(n, t, tol)
    assert tail(m) >= tol > tail(m - 1)
