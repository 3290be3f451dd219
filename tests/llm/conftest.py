from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    from postolake.session import ship_package

    ship_package(spark)


@pytest.fixture()
def docs(spark):
    """Frame of documents from texts or (doc_id, text[, lang[, source]]) tuples."""

    def make(rows):
        full = []
        for k, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (k, r)
            doc_id, text, lang, source = (*r, *(None, "s")[len(r) - 2 :])[:4] if len(r) < 4 else r
            full.append((doc_id, text, lang, source, len(text) if text is not None else None))
        return spark.createDataFrame(full, DOCS)

    return make
