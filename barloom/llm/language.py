"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of every document it is given, in the tasks, as one dense table
of languages by buckets; the tables are added up block by block. The model, a matrix of
smoothed log probabilities and the log shares of the languages, has a size fixed by
``BUCKETS`` and the number of languages and is broadcast. A batch of texts is scored as a
sparse document-by-bucket product: gather the columns of all n-grams, add them up by text.

N-grams of 1 to 3 code points in lower case lie inside one text. A text that is null or has
no letter is ``und`` with score 0; so is every text if nothing was learned. The score is the
posterior probability of the predicted language; ties go to the smaller language name. Rows
without a language are not learned from. Repeated rows count and are predicted each for
itself; texts of any length count and are predicted whole, an empty table gives no rows. More
than ``MOST_LANGUAGES`` languages are refused. Columns of the input named as an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import codes
from barloom.llm.toxicity import remainder

GRAMS = (1, 2, 3)
BUCKETS = 1 << 16
COUNT_BLOCK = 1 << 12
SMOOTHING = 0.5
MOST_LANGUAGES = 512
SLICE_CHARS = 1 << 19
UNKNOWN = "und"

@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # log probability of a bucket, by language
    prior: np.ndarray


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, code points in lower case, borders) of about SLICE_CHARS each."""
    edges = np.concatenate([[0], np.cumsum([len(t or "") for t in texts], dtype=np.int64)])
    for start, stop in codes.slices(edges, SLICE_CHARS):
        yield start, stop, *codes.code_points([(t or "").lower() for t in texts[start:stop]])


def count_grams(texts: DataFrame) -> DataFrame:
    """lang, block and counts: how often each n-gram bucket occurs in all texts of each language."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            languages = batch.column("lang").to_pylist()
            for start, stop, points, edges in _slices(batch.column("text").to_pylist()):
                names = sorted(set(languages[start:stop]))
                number = np.array([names.index(x) for x in languages[start:stop]])
                of = np.repeat(number, np.diff(edges))
                count = np.zeros(len(names) * BUCKETS, np.int64)
                for bucket, inside in codes.gram_buckets(points, edges, GRAMS, BUCKETS):
                    place = of[: len(bucket)] * BUCKETS + bucket
                    count += np.bincount(place[inside], minlength=len(count))
                for at, name in enumerate(names):
                    totals[name] = totals.get(name, 0) + count[at * BUCKETS : (at + 1) * BUCKETS]
                    rows[name] = rows.get(name, 0) + int((number == at).sum())
                if len(totals) > MOST_LANGUAGES:
                    raise ValueError(f"more than {MOST_LANGUAGES} languages")
        for name, total in totals.items():
            parts = total.reshape(-1, COUNT_BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(parts)),
                    pa.array(range(len(parts)), pa.int32()),
                    pa.array([x.astype(np.int64).tobytes() for x in parts], pa.binary()),
                    pa.array([rows[name]] + [0] * (len(parts) - 1), pa.int64()),
                ],
                ["lang", "block", "counts", "rows"],
            )

    def summed(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(COUNT_BLOCK, np.int64), 0
        for batch in batches:
            for data, count in zip(batch.column("counts").to_pylist(), batch.column("rows").to_pylist(), strict=True):
                total += np.frombuffer(data, np.int64)
                rows += count
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary()), pa.array([rows], pa.int64())],
            ["lang", "block", "counts", "rows"],
        )

    schema = "lang string, block int, counts binary, rows long"
    return texts.select("lang", "text").mapInArrow(counted, schema).groupBy("lang", "block").applyInArrow(summed, schema)


def train(documents: DataFrame) -> Model:
    """Learn from text and lang of all rows that have both."""
    known = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    totals: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for row in count_grams(known).toLocalIterator():
        total = totals.setdefault(row["lang"], np.zeros(BUCKETS, np.int64))
        total[row["block"] * COUNT_BLOCK : (row["block"] + 1) * COUNT_BLOCK] = np.frombuffer(row["counts"], np.int64)
        rows[row["lang"]] = rows.get(row["lang"], 0) + row["rows"]
    languages = sorted(totals)
    if not languages:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0))
    counts = np.array([totals[x] for x in languages], np.float64) + SMOOTHING
    share = np.array([rows[x] for x in languages], np.float64)
    weights = np.log(counts) - np.log(counts.sum(1, keepdims=True))
    return Model(languages, weights.astype(np.float32), np.log(share / share.sum()))


def predict_texts(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    names, scores = [], np.zeros(len(texts))
    for start, stop, points, edges in _slices(texts):
        total = np.repeat(model.prior[:, None], stop - start, 1)
        for bucket, inside in codes.gram_buckets(points, edges, GRAMS, BUCKETS):
            short = np.minimum(edges, len(bucket))
            for language in range(len(model.languages)):
                total[language] += codes.segment_sums(model.weights[language][bucket] * inside, short)
        for row in range(stop - start):
            text = texts[start + row]
            if not model.languages or not any(map(str.isalpha, text or "")):
                names.append(UNKNOWN)
                continue
            best = int(total[:, row].argmax())
            names.append(model.languages[best])
            scores[start + row] = 1 / np.exp(total[:, row] - total[best, row]).sum()
    return names, scores


def predict(documents: DataFrame, model: Model, name: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows and columns of ``documents`` with the predicted language and its probability."""
    kept = documents.drop(name, score)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())])
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predict_texts(batch.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores)], [*batch.schema.names, name, score])

    return kept.mapInArrow(predicted, schema)


def languages(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; a third of the ids is held out."""
    model = train(documents.where(remainder("doc_id", 3) != 1))
    return predict(documents.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
