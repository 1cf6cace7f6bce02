"""A corpus in five stages: toxic documents go, near copies go, benchmark items go, secrets go, the rest is packed.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; ``run`` writes
each result as Parquet into the shared work folder and reads it for the next stage. All
stages but the last return the columns of ``documents``, whatever further columns those have.

* toxicity: fitted on the labelled documents among its input; documents of score 0.5 or more go.
* near_copies: five-word shingles, similarity 0.8; one row of each group stays, that of the smallest id.
* decontamination: documents that hold a benchmark item, or its question, go.
* secrets: secrets are replaced by a mark, all documents stay; the field is fitted on its input.
* packing: one row per piece of a document with its place in a sequence.

Null or empty texts pass all filters. Every stage judges rows, not ids: a row without an id, or
with the id of another, stays or goes by its own text, and of repeated rows one stays. Documents
of any length are read whole. An empty table passes through all stages and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import decontamination, near_jaccard, packing, secret_scan, toxicity
from barloom.llm.work import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, "toxic_score").where("toxic_score < 0.5").drop("toxic_score")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_jaccard.first_of_each(docs, words=5, least=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, secret_scan.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
