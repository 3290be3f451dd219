from __future__ import annotations

from postolake.llm import line_dedup
from postolake.llm.line_dedup import dedup_lines, token_rarity

from .helpers import edited, prose, words


def _expected(rows):
    """Removed line numbers by (doc_id, text); rows are in order of doc_id, ids distinct."""
    seen, out = [], {}
    for doc_id, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            s = frozenset(words(line))
            if not s:
                continue
            if any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                out.setdefault(doc_id, []).append(k)
            seen.append(s)
    return out


def _corpus():
    rows = []
    for d in range(40):
        lines = []
        for k in range(6):
            base = prose(f"{d % 7}-{k}", 4 + 5 * k)
            lines.append(edited(base, 31 * d + k, 0.02 * (d % 5)))
        lines += ["shared footer line", "", "a b c", "...", "Shared, footer LINE"]
        rows.append((d, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "one"), (104, "one\none"), (105, "w " * 50_000 + "\n" + prose(9, 300))]
    return rows


def test_removed_lines_match_brute_force(docs):
    rows = _corpus()
    out = {r["doc_id"]: r for r in dedup_lines(docs(rows)).collect()}
    expected = _expected(rows)
    assert {d: r["removed"] for d, r in out.items() if r["removed"]} == expected
    for d, text in rows:
        kept = text if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in expected.get(d, []))
        assert out[d]["text"] == kept


def test_crowded_tokens_are_split_without_loss(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "POSTINGS", 3)
    rows = _corpus()[:30]
    out = {r["doc_id"]: r["removed"] for r in dedup_lines(docs(rows)).collect() if r["removed"]}
    assert out == _expected(rows)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(None, "x y z", 1, 2), (5, "x y z", 3, 4), (5, "x y z", 3, 4), (5, "x y z\nq r s", 1, 1), (7, "q r s", 0, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, id long, lines long")
    out = dedup_lines(frame)
    assert out.columns == ["doc_id", "text", "id", "lines", "removed"]
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"], r["id"], tuple(r["removed"])) for r in out.collect())
    # the null id comes first; the two equal rows lose the same line; order inside id 5 is by text hash
    assert (False, 0, "x y z", 1, ()) in got
    assert got.count((True, 5, "", 3, (0,))) == 2
    assert (True, 5, "q r s", 1, (0,)) in got and (True, 7, "", 0, (0,)) in got


def test_empty_table(docs):
    assert dedup_lines(docs([])).collect() == []
    assert dedup_lines(docs([(1, None), (2, "")])).count() == 2


def test_rarity_counts_every_token(docs):
    counts = token_rarity(docs(["a b a", None, "a"]).select("text"))
    assert counts.sum() == 4 and counts.max() == 3
