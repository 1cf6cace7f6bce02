import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import codes, toxicity

WORDS = "scum idiot moron".split()


def corpus(count):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghilnorstu") for _ in range(rng.randint(2, 7))) for _ in range(500)]
    rows, labels = [], []
    for i in range(count):
        words = rng.choices(vocabulary, k=rng.randint(20, 120))
        toxic = rng.random() < 0.3
        for _ in range(6 * toxic):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out(spark, frame):
    rows, labels = corpus(500)
    truth = {i: t for i, _, t in labels}
    found = toxicity.toxicity(frame(rows), table(spark, labels)).collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == len(rows) and 60 < len(held) < 140
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in found)


def test_score_is_the_folded_classifier():
    rng = np.random.default_rng(0)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS).astype(np.float32), 0.25)
    texts = ["some TEXT to score", "", "abc", "text to score, some"]
    data, edges = codes.text_bytes(pa.array(texts))
    got = toxicity.margins(data, edges, model)
    for text, margin in zip(texts, got, strict=True):
        own, border = codes.text_bytes(pa.array([text]))
        grams = [b[ok] for b, ok in codes.gram_buckets(codes.LOWER[own], border, toxicity.GRAMS, toxicity.BUCKETS)]
        buckets = np.concatenate(grams) if grams else np.zeros(0, int)
        expected = 0.25 + (model.weights[buckets].mean() if len(buckets) else 0)
        assert margin == pytest.approx(expected, abs=1e-4)


def test_odd_rows(spark, frame, odd_rows):
    labels = [(1, 1, None), (2, None, 5), (5, 1, 1), (5, 1, 0), (6, 1, 0), (8, 0, 0), (77, 0, 1), (None, 1, 1), (4, 0, 0)]
    found = toxicity.toxicity(frame(odd_rows), table(spark, labels)).collect()
    assert len(found) == len(odd_rows)
    scores = {r["doc_id"]: r["score"] for r in found}
    assert scores[1] == scores[2] and not any(r["held_out"] for r in found if r["doc_id"] is None)
    for none in ([], [(4, 0, 0)]):
        found = toxicity.toxicity(frame(odd_rows), table(spark, none)).collect()
        assert len({r["score"] for r in found}) == 1 and all(r["predicted"] == (not none) * 1 for r in found)
    assert toxicity.toxicity(frame([]), table(spark, labels)).count() == 0
    model = toxicity.train(frame(odd_rows), table(spark, labels))
    kept = toxicity.score(frame(odd_rows), model)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "score"]


def test_sample_is_bounded_and_whole_below(spark):
    labels = table(spark, [(i, 1, i % 2) for i in range(50)] + [(3, 1, 0), (3, 1, 1)])
    assert toxicity.sample_labels(labels, 20).count() == 20
    assert toxicity.sample_labels(labels, 100).count() == 50
