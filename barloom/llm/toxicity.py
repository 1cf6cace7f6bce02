"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Training features are the shares of hashed byte n-grams in a text, each multiplied by the
log ratio of its smoothed document counts in the two classes; a logistic regression is
fitted on them. After fitting, ratio and coefficient fold into one weight per bucket, so a
score is one gather and one sum over all n-grams of the whole text.

The classifier is fitted on a bounded sample of labelled rows, ``SAMPLE_ROWS`` documents
with the smallest hash of their id, of ``SAMPLE_BYTES`` of text at most. Everything else
covers all rows.

Defined results: a null text is an empty text and gets the score of the bias alone; labels
that are null or neither 0 nor 1 are not learned from; several labels of one document count
as toxic if one of them is; without labels of both classes, every score is the smoothed
share of toxic rows. Repeated rows are scored separately; texts of any length are scored whole,
an empty table gives no rows. A column of the input that bears the name of the score is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import codes
from barloom.llm.work import in_one_task, smallest_by_hash, stored, within_bytes

SAMPLE_ROWS = 5000
SAMPLE_BYTES = 32 << 20
GRAMS = (4, 5)
BUCKETS = 1 << 18
STEPS = 40
FIT_ROWS = 250
RATE = 0.05
DECAY = 1e-4


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def remainder(column: str | Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary")) % divisor


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets of each text with their counts, packed as bytes."""
    for batch in batches:
        rows: dict[str, list] = {"buckets": [], "counts": []}
        for start, stop, data, edges in codes.text_slices(batch):
            grams = list(codes.gram_buckets(codes.LOWER[data], edges, GRAMS, BUCKETS))
            for row in range(stop - start):
                low, high = edges[row], edges[row + 1]
                own = [bucket[low:high][inside[low:high]] for bucket, inside in grams]
                found, count = np.unique(np.concatenate(own), return_counts=True)
                rows["buckets"].append(found.astype(np.int32).tobytes())
                rows["counts"].append(codes.packed(count))
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(rows["buckets"], pa.binary()), pa.array(rows["counts"], pa.binary())],
            ["toxic", "buckets", "counts"],
        )


def sample_labels(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled ids, the smallest by a hash of the id."""
    one = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    return smallest_by_hash(one, "doc_id", rows)


def _fitted(found: pa.Table) -> pa.Table:
    model = fit(
        np.asarray(found["toxic"].to_numpy(), np.float64),
        [np.frombuffer(x, np.int32) for x in found["buckets"].to_pylist()],
        [codes.unpacked(x) for x in found["counts"].to_pylist()],
    )
    return pa.table({"weights": pa.array([model.weights.tobytes()], pa.binary()), "bias": [model.bias]})


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, limit: int = SAMPLE_BYTES) -> Model:
    """Fit, in a task, on at most ``rows`` labelled documents of ``limit`` bytes; only the weights reach the driver."""
    sample = documents.select("doc_id", "text").join(F.broadcast(sample_labels(labels, rows)), "doc_id")
    texts = within_bytes(stored(sample, "labelled"), "doc_id", limit)
    features = texts.select("toxic", "text").mapInArrow(_features, "toxic int, buckets binary, counts binary")
    row = in_one_task(features, _fitted, "weights binary, bias double")
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"]) if row else fit(np.zeros(0), [], [])


def fit(toxic: np.ndarray, buckets: list[np.ndarray], counts: list[np.ndarray]) -> Model:
    """Logistic regression by Adam on ratio-scaled shares, in a fixed order, some rows at a time."""
    weights = np.zeros(BUCKETS, np.float32)
    prior = (toxic.sum() + 1) / (len(toxic) + 2)
    bias = float(np.log(prior / (1 - prior)))
    if not 0 < toxic.sum() < len(toxic):
        return Model(weights, bias)
    order = sorted(range(len(toxic)), key=lambda i: (toxic[i], buckets[i].tobytes()))
    toxic = toxic[order]
    buckets, counts = [buckets[i] for i in order], [counts[i] for i in order]

    seen, other = np.ones(BUCKETS), np.ones(BUCKETS)
    for label, bucket in zip(toxic, buckets, strict=True):
        (seen if label else other)[bucket] += 1  # distinct buckets
    ratio = np.log(seen / seen.sum()) - np.log(other / other.sum())

    size = BUCKETS + 1
    point, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    point[-1] = bias
    for step in range(1, STEPS + 1):
        slope = DECAY * point
        for low in range(0, len(toxic), FIT_ROWS):
            part = slice(low, low + FIT_ROWS)
            sizes = [len(x) for x in buckets[part]]
            column = np.concatenate(buckets[part])
            row = np.repeat(np.arange(len(sizes)), sizes)
            share = np.concatenate([x * (100.0 / max(x.sum(), 1)) for x in counts[part]])
            value = share * ratio[column]
            margin = np.bincount(row, value * point[column], minlength=len(sizes)) + point[-1]
            error = (1 / (1 + np.exp(-margin)) - toxic[part]) / len(toxic)
            slope[:-1] += np.bincount(column, value * error[row], minlength=BUCKETS)
            slope[-1] += error.sum()
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        point -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model((point[:-1] * ratio * 100).astype(np.float32), float(point[-1]))


def margins(data: np.ndarray, edges: np.ndarray, model: Model) -> np.ndarray:
    """Linear score of each text of a slice."""
    total = np.zeros(len(edges) - 1)
    grams = np.zeros(len(edges) - 1)
    for bucket, inside in codes.gram_buckets(codes.LOWER[data], edges, GRAMS, BUCKETS):
        short = np.minimum(edges, len(bucket))
        total += codes.segment_sums(model.weights[bucket] * inside, short)
        grams += codes.segment_sums(inside, short)
    return total / np.maximum(grams, 1) + model.bias


def score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All rows and columns of ``documents`` with the probability that the text is toxic."""
    kept = documents.drop(name)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [margins(data, edges, shared.value) for _, _, data, edges in codes.text_slices(batch)]
            margin = np.concatenate(parts) if parts else np.zeros(0)
            value = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*batch.schema.names, name])

    return kept.mapInArrow(scored, schema)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; a fifth of the ids is held out."""
    learned = labels.where(remainder("doc_id", 5) != 0)
    model = train(documents, learned)
    return score(documents.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
