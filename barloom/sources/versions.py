"""Small tables kept as numbered versions: written aside, then published, the last few kept.

A version is visible to readers once its mark is written, so a failed write harms nothing and
a new version may be made from the one before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

KEPT = 3


def _version(table: str, number: int) -> str:
    return f"{table}/versions/{number}"


def _mark(table: str, number: int) -> str:
    return f"{table}/finished/{number}"


def finished(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the published versions, ascending: ``KEPT`` of them or, for a moment, one more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/finished")
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(folder):
        return []
    marks = [status.getPath() for status in files.listStatus(folder)]
    done = [mark for mark in marks if files.exists(spark._jvm.org.apache.hadoop.fs.Path(mark, "_SUCCESS"))]
    return sorted(int(mark.getName()) for mark in done)


def read(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """The newest published version, or the one asked for."""
    numbers = finished(spark, table)
    if not numbers or number not in (None, *numbers):
        raise ValueError(f"no such version of {table} is published")
    return spark.read.parquet(_version(table, numbers[-1] if number is None else number))


def publish(frame: DataFrame, table: str, number: int | None = None) -> int:
    """Write the frame as a new version, show it to readers, and drop versions beyond the last few.

    ``number`` makes a repeated write of the same version replace it.
    """
    spark = frame.sparkSession
    numbers = finished(spark, table)
    if number is None:
        number = numbers[-1] + 1 if numbers else 0
    frame.write.mode("overwrite").parquet(_version(table, number))
    spark.range(1).select(F.lit(number).alias("version")).write.mode("overwrite").json(_mark(table, number))
    for old in [n for n in numbers if n < number][: 1 - KEPT]:
        for place in (_mark(table, old), _version(table, old)):
            path = spark._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    return number
