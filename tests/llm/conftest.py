from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents out of texts, or of (doc_id, text, lang, source)."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            doc_id, text, lang, source = row if isinstance(row, tuple) else (i, row, "en", "s")
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS)

    return make


#: Nulls, empty and blank texts, a long one, ties and repeats.
ODD = [None, "", " \n\t ", "word", "a" * 70_000, "the same text here", "the same text here", "\U0001f600 ünïcode ﬁ Σ", "1 2 3"]
