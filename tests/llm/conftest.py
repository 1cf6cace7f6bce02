from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, row string"


@pytest.fixture
def frame(spark):
    """documents from (doc_id, text) pairs, with columns that clash with the operators' own."""

    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, "src", len(t or ""), 9.5, "r") for i, t in rows], DOCUMENTS)

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and blank texts, one long text, repeated rows, and a row without an id."""
    long = " ".join(f"wörd{i % 977} of{i}" for i in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n\x0b"), (4, "a"), (5, long), (6, "same text here"), (6, "same text here"), (None, "no id at all"), (8, "\U0001f600 é \x00 ß")]


@pytest.fixture
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
