"""Intraday bars of a quote stream, with the quotes that come too late kept and corrected for.

A batch stores its quotes by batch and day, notes the latest instant seen, and makes the bars
of the windows that this closes: those that end ``delay`` before it. Quotes of windows which
earlier batches closed are late: they go to a table of their own as well, and :func:`correct`
rebuilds the bars they belong to, and no others, from the stored quotes. Streamed and corrected bars
are those of all quotes at once, in whatever order they came.

Everything a batch writes lies below its number and is written again by a repeated batch; bars
are a table of buckets by day (:mod:`barloom.sources.buckets`), of which readers see whole
writes only. Quotes without an instant belong to no bar.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom import fixed_values as fv
from barloom.sources import buckets, versions
from barloom.streaming.quotes import AVAILABLE, bars_of

DELAY = "10 minutes"
_QUOTE = "stock_code string, ts timestamp, price double, volume bigint"
_STORED = f"{_QUOTE}, batch long, day int"


def _day(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")


def _window_end(width: str) -> Column:
    return F.window("ts", width)["end"]


def _seen(spark: SparkSession, folder: str, number: int) -> tuple[object, list[int]]:
    """The latest instant that the batches before ``number`` saw, and their numbers."""
    before = [n for n in versions.finished(spark, f"{folder}/seen") if n < number]
    row = versions.read(spark, f"{folder}/seen", before[-1]).first() if before else None
    return (row["latest"] if row else None), before


def _newest(both: DataFrame) -> DataFrame:
    names = [x for x in both.columns if x != "bucket"]
    return both.groupBy("stock_code", "window_start").agg(F.max_by(F.struct(*names), "write").alias("b")).select("b.*")


def _put(bars: DataFrame, folder: str, write: int) -> None:
    """Bars into the table; the number of the write tells which of two bars of a window counts."""
    buckets.merge(bars.withColumn("write", F.lit(write).cast("long")), f"{folder}/bars", write, _day(F.col("window_start")), _newest)


def stored_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(f"{folder}/quotes")


def late_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """The side table: quotes that came after their window was closed, with their batch."""
    return spark.read.schema(f"{_QUOTE}, batch long").parquet(f"{folder}/late")


def read_bars(spark: SparkSession, folder: str) -> DataFrame:
    return buckets.read(spark, f"{folder}/bars").drop("write")


def take_batch(quotes: DataFrame, folder: str, number: int, width: str = fv.POLL_INTERVAL, delay: str = DELAY) -> None:
    """Store one batch of quotes (stock_code, ts, price, volume) and the bars of the windows it closes."""
    spark = quotes.sparkSession
    latest, _ = _seen(spark, folder, number)
    known = quotes.select("stock_code", F.col("ts").cast("timestamp"), "price", "volume").where("ts IS NOT NULL")
    place = f"{folder}/quotes/batch={number}"
    known.withColumn("day", _day(F.col("ts"))).repartition("day").write.mode("overwrite").partitionBy("day").parquet(place)
    own = spark.read.schema(f"{_QUOTE}, day int").parquet(place).drop("day")
    back = F.expr(f"INTERVAL {delay}")
    before = F.lit(latest) - back
    late = own.where(_window_end(width) <= before) if latest is not None else own.limit(0)
    late.write.mode("overwrite").parquet(f"{folder}/late/batch={number}")

    newest = own.agg(F.max("ts")).first()[0]
    reached = max((x for x in (latest, newest) if x is not None), default=None)
    closing = own.limit(0)
    if reached is not None and reached != latest:
        after = F.lit(reached) - back
        whole = stored_quotes(spark, folder).where(F.col("batch") <= number)
        closing = whole.where((_window_end(width) <= after) & (F.col("day") <= _day(after)))
        if latest is not None:
            closing = closing.where((_window_end(width) > before) & (F.col("day") >= _day(before - F.expr(f"INTERVAL {width}"))))
    _put(bars_of(closing.select("stock_code", "ts", "price", "volume"), width), folder, 2 * number)
    seen = spark.range(1).select(F.lit(reached).cast("timestamp").alias("latest"))
    versions.publish(seen, f"{folder}/seen", number)


def correct(spark: SparkSession, folder: str, width: str = fv.POLL_INTERVAL) -> int:
    """Rebuild the bars of all late quotes since the last correction; gives the number of bars."""
    finished = versions.finished(spark, f"{folder}/seen")
    done = versions.finished(spark, f"{folder}/corrected")
    if not finished or (done and done[-1] >= finished[-1]):
        return 0
    last, since = finished[-1], done[-1] if done else -1
    late = late_quotes(spark, folder).where(F.col("batch").between(since + 1, last))
    wanted = late.select("stock_code", F.window("ts", width).alias("w")).distinct().select("stock_code", F.col("w.start").alias("start"))
    wanted = wanted.persist()
    try:
        days = [row["day"] for row in late.select(_day(F.col("ts")).alias("day")).distinct().collect()]  # as many as the calendar has
        quotes = stored_quotes(spark, folder).where(F.col("day").isin(days) & (F.col("batch") <= last))
        own = quotes.withColumn("start", F.window("ts", width)["start"]).join(wanted, ["stock_code", "start"], "left_semi")
        _put(bars_of(own.select("stock_code", "ts", "price", "volume"), width), folder, 2 * last + 1)
        count = wanted.count()
    finally:
        wanted.unpersist()
    versions.publish(spark.range(1), f"{folder}/corrected", last)
    return count


def stream(
    quotes: DataFrame,
    folder: str,
    checkpoint: str,
    width: str = fv.POLL_INTERVAL,
    delay: str = DELAY,
    trigger: Mapping[str, object] = AVAILABLE,
) -> StreamingQuery:
    """Typed quotes into the tables below ``folder``."""

    def batch(rows: DataFrame, number: int) -> None:
        take_batch(rows, folder, number, width, delay)

    return quotes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()
