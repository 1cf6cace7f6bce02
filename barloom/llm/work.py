"""Work tables in the shared folder, and settings an operator needs while it runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from barloom.session import work_folder

_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Free a finished job's shuffle files at once instead of at the driver's next collection.

    Work tables cut the lineage, so nothing reads those files again.
    """
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder and read it back: lineage ends here."""
    spark = frame.sparkSession
    place = work_folder(spark, name)
    with released_shuffles(spark):
        frame.write.option("compression", "zstd").parquet(place)
    return spark.read.schema(frame.schema).parquet(place)


def in_one_task(frame: DataFrame, made: Callable[[pa.Table], pa.Table], schema: str) -> Row | None:
    """The row that ``made`` makes of a whole frame of bounded size, in a task; None where the frame is empty.

    The frame's rows never come to the driver, the row does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for x in batches if x.num_rows]
        if held:
            yield from made(pa.Table.from_batches(held)).to_batches()

    return frame.repartition(1).mapInArrow(run, schema).first()


def smallest_by_hash(frame: DataFrame, key: str, rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hash of their key: a sample that no order of rows changes.

    Rows whose hash cannot be among them are dropped first, so that a task which puts the
    others in order sees about twice as many as asked for, however many there are.
    """
    total = frame.count()
    span = 1 << 40
    place = F.pmod(F.xxhash64(key), F.lit(span))
    if total > 2 * rows:
        frame = frame.where(place < int(span * 2 * rows / total))
    return frame.orderBy(place, key).limit(rows)


def within_bytes(texts: DataFrame, key: str, limit: int) -> DataFrame:
    """Of a sample (``key``, text), the rows whose texts, in the order of the key's hash, come to ``limit`` bytes at most.

    Only key and length of each row of the sample are put in order.
    """
    sizes = texts.select(key, F.octet_length("text").alias("_size"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.xxhash64(key), key)
    kept = sizes.withColumn("_sum", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("_sum") <= limit)
    return texts.join(F.broadcast(kept.select(key).distinct()), key)
