"""Exact most frequent words from bounded summaries against the full count."""

from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest

from barloom.operators import terms


@pytest.mark.parametrize("capacity", [5, 40, 1000])
def test_summaries_keep_their_bounds(capacity):
    rng = random.Random(capacity)
    batches, whole = [], Counter()
    for _ in range(8):
        words = [[f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randint(0, 40))] for _ in range(20)]
        whole.update(w for text in words for w in text)
        batches.append(pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string()))], ["words"]))
    (found,) = terms._summaries(capacity)(iter(batches))
    rows = dict(zip(found.column("term").to_pylist(), found.column("n").to_pylist(), strict=True))
    error = rows.pop(None)
    assert len(rows) <= capacity and error <= sum(whole.values()) / (capacity + 1) + 1
    assert all(rows.get(w, 0) <= n <= rows.get(w, 0) + error for w, n in whole.items())


@pytest.mark.parametrize("k,capacity,sent", [(5, 30, 200_000), (20, 400, 200_000), (7, 2, 200_000), (10, 60, 3), (5000, 50, 200_000)])
def test_equal_to_the_full_count(spark, monkeypatch, k, capacity, sent):
    monkeypatch.setattr(terms, "SENT_TERMS", sent)
    rng = random.Random(k)
    texts = [" ".join(f"W{'x' * (int(rng.paretovariate(0.8)) % 50)}y{'z' * rng.randint(0, 3)}" for _ in range(rng.randint(0, 60))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "", "12 34"])], "doc_id long, text string").repartition(6)
    assert terms.top_terms(docs, k, capacity=capacity).collect() == terms.term_freq(docs, k).collect()
    assert terms.top_terms(docs.limit(0), k, capacity=capacity).count() == 0
