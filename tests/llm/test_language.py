import math
import zlib

import numpy as np
import pytest

from barloom.llm import codes, language


def test_documents_held_out(documents):
    found = language.languages(documents).collect()
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    assert len(found) == len(truth)
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
    right = [row["lang_pred"] == truth[row["doc_id"]] for row in found if row["held_out"]]
    assert np.mean(right) > 0.95


def test_against_plain_naive_bayes(spark):
    rows = [(1, "aaab", "x"), (2, "ab ba", "x"), (3, "bbc", "y"), (4, "cÉc", "y"), (5, None, "y"), (6, "zzz", None)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["x", "y"]

    def grams(text):
        points, edges = codes.code_points([text.lower()])
        return np.concatenate([b[ok] for b, ok in codes.gram_buckets(points, edges, language.GRAMS, language.BUCKETS)])

    counts = {n: sum(np.bincount(grams(t), minlength=language.BUCKETS) for _, t, k in rows if k == n and t) for n in "xy"}
    texts = ["ab", "cé", "abc" * 50, "", None, "12 3²"]
    names, scores = language.predict_texts(texts, model)
    for text, name, score in zip(texts, names, scores, strict=True):
        if not text or text == "12 3²":
            assert (name, score) == ("und", 0)
            continue
        logs = {n: math.log(0.5) + (np.log(c + language.SMOOTHING) - np.log((c + language.SMOOTHING).sum()))[grams(text)].sum() for n, c in counts.items()}
        best = max(logs, key=logs.get)
        assert name == best
        assert score == pytest.approx(1 / sum(math.exp(v - logs[best]) for v in logs.values()), abs=1e-4)


def test_odd_rows(frame, odd_rows, spark):
    found = language.languages(frame(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    by_id = {r["doc_id"]: r["lang_pred"] for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == "und" and by_id[4] == "en"
    assert {r["lang_pred"] for r in language.languages(frame(odd_rows, None)).collect()} == {"und"}
    assert language.languages(frame([])).count() == 0
    kept = language.predict(frame(odd_rows), language.train(frame(odd_rows)), "row", "score")
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "score"]
