"""A keyed table of which each write replaces only the buckets it touches.

Rows lie in buckets by a hash of their key, or by a whole number of their own, such as a day.
A write reads the buckets of its own keys, merges
and writes them below its number, and publishes a list that names the write which holds each
bucket (a small versioned table, :mod:`barloom.sources.versions`). So the bytes written follow
the batch and not the table, readers see whole writes only, and a write of the same number,
repeated after a failure, replaces itself. Buckets which no kept list names are deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.sources import versions

BUCKETS = 64


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _place(table: str, version: int, bucket: int) -> str:
    return f"{table}/data/{version}/bucket={bucket}"


def _empty(table: str) -> str:
    return f"{table}/data/empty"


def holders(spark: SparkSession, table: str, number: int | None = None) -> dict[int, int]:
    """The write that holds each bucket, by the newest list or the one asked for."""
    return {row["bucket"]: row["version"] for row in versions.read(spark, table, number).collect()}


def read(spark: SparkSession, table: str, number: int | None = None, wanted: Callable[[int], bool] = lambda bucket: True) -> DataFrame:
    """The table, or its wanted buckets, as of its newest write or the one asked for."""
    held = holders(spark, table, number)
    return spark.read.parquet(_empty(table), *(_place(table, version, bucket) for bucket, version in sorted(held.items()) if wanted(bucket)))


def merge(
    rows: DataFrame, table: str, number: int, key: str | Column, merged: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS
) -> list[int]:
    """Write the rows into the table as write ``number``; gives the buckets it replaced.

    ``key`` is the column whose hash is the bucket, or the bucket itself, a whole number.
    ``merged`` makes the rows to keep from old and new rows of the same buckets. Rows are read
    twice, so they should not be costly to make. A large bucket is written by several tasks.
    """
    spark = rows.sparkSession
    own = bucket_of(key, buckets) if isinstance(key, str) else key.cast("int")
    before = [n for n in versions.finished(spark, table) if n < number]
    held = holders(spark, table, before[-1]) if before else {}
    new = rows.withColumn("bucket", own)
    changed = sorted(row["bucket"] for row in new.select("bucket").distinct().collect())
    if not before:
        rows.limit(0).write.mode("overwrite").parquet(_empty(table))
    old = [_place(table, held[b], b) for b in changed if b in held]
    both = rows.unionByName(spark.read.schema(rows.schema).parquet(*old)) if old else rows
    kept = merged(both).withColumn("bucket", own)
    kept.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/data/{number}")
    dropped = holders(spark, table, before[0]) if len(before) >= versions.KEPT else {}
    held |= dict.fromkeys(changed, number)
    listed = spark.createDataFrame(sorted(held.items()), "bucket int, version long")
    versions.publish(listed.coalesce(1), table, number)
    if dropped:
        _forget(spark, table, dropped)
    return changed


def _forget(spark: SparkSession, table: str, dropped: dict[int, int]) -> None:
    """Delete what a list that is gone named and no kept list names."""
    named = {pair for n in versions.finished(spark, table) for pair in holders(spark, table, n).items()}
    for bucket, version in set(dropped.items()) - named:
        path = spark._jvm.org.apache.hadoop.fs.Path(_place(table, version, bucket))
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
