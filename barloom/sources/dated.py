"""A table of days in which a load replaces whole days, and all of them become visible at once.

Rows lie in buckets by year (:mod:`barloom.sources.buckets`). A load writes the years of its days
below its own number, with the other days of these years, and then publishes the list of the
writes that hold each year. A reader sees the years of one list, so all old or all new, goes on
with them while the next loads run, and after a failed load finds the table as it was. A load of
the same number, repeated, replaces itself. One writer at a time.

Rows without a date count as one more day. An empty load changes nothing.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.sources import buckets, versions

WRITE = "_write"
UNDATED = -1


def put_days(df: DataFrame, table: str, column: str = "data_date", number: int | None = None) -> list[int]:
    """Replace the days that the frame holds; gives the years written (``UNDATED`` for rows without a date).

    The frame may read the version it changes.
    """
    spark = df.sparkSession
    if number is None:
        number = max(versions.finished(spark, table), default=-1) + 1

    def newer(both: DataFrame) -> DataFrame:
        own = both.where(F.col(WRITE) == number)
        days = own.select(F.col(column).alias("_day")).distinct()
        kept = both.where(F.col(WRITE) < number).join(days, F.col(column).eqNullSafe(F.col("_day")), "left_anti")
        return own.unionByName(kept)

    rows = df.withColumn(WRITE, F.lit(number).cast("long")).persist()
    try:
        return buckets.merge(rows, table, number, F.coalesce(F.year(column), F.lit(UNDATED)), newer)
    finally:
        rows.unpersist()


def read_days(
    spark: SparkSession,
    table: str,
    first: date | str | None = None,
    last: date | str | None = None,
    column: str = "data_date",
    number: int | None = None,
) -> DataFrame:
    """The rows from ``first`` to ``last``, both included, as of the newest load or the one asked for.

    Only files of these years are opened. Without any bound, rows without a date are given too.
    """
    low, high = (int(str(day)[:4]) if day is not None else None for day in (first, last))
    bounded = first is not None or last is not None

    def wanted(year: int) -> bool:
        return not bounded or (year != UNDATED and (low is None or low <= year) and (high is None or year <= high))

    found = buckets.read(spark, table, number, wanted).drop(WRITE)
    if first is not None:
        found = found.where(F.col(column) >= F.lit(str(first)).cast("date"))
    if last is not None:
        found = found.where(F.col(column) < F.date_add(F.lit(str(last)).cast("date"), 1))
    return found
