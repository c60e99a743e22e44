from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size int, host string"


@pytest.fixture
def make_docs(spark):
    """documents with extra columns whose names clash with results."""
    def build(texts, first=1, **columns):
        rows = [(first + i, t, columns.get("lang", [None] * len(texts))[i], columns.get("source", ["s"] * len(texts))[i],
                 None if t is None else len(t), True, 7, "h") for i, t in enumerate(texts)]
        if "doc_id" in columns:
            rows = [(d, *r[1:]) for d, r in zip(columns["doc_id"], rows)]
        return spark.createDataFrame(rows, DOCUMENTS)

    return build

