"""Quote stream: latest snapshot, end-of-day and intraday bars, repeated polls.

State is keyed by stock and window and bounded by watermarks. Aggregates combine
inside each task before the shuffle, so a heavily quoted stock sends few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType, TimestampNTZType

from barloom import fixed_values as fv
from barloom.functions.dates import in_session, utc_instant, utc_wall
from barloom.functions.prices import price_or_best_bid
from barloom.plans.loads import eod_bar, newest_quotes, quote_snapshot
from barloom.sources import buckets
from barloom.sources.sinks import upsert_days


def read_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options: object
) -> DataFrame:
    """Files as they arrive. Streams never infer a schema."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def typed_quotes(raw: DataFrame) -> DataFrame:
    """Raw quotes as ``stock_code, ts, price, volume``.

    Watermarks need instants, so wall-clock times are read as UTC.
    """
    wall = isinstance(raw.schema["ts"].dataType, TimestampNTZType)
    return raw.select(
        F.col("c").alias("stock_code"),
        utc_instant(F.col("ts")).alias("ts") if wall else F.col("ts"),
        price_or_best_bid(F.col("z"), F.col("b")).try_cast("double").alias("price"),
        F.col("v").try_cast("bigint").alias("volume"),
    )


#: polls go on at this interval; a run with ``AVAILABLE`` ends with the input that is there
POLLING = {"processingTime": fv.POLL_INTERVAL}
AVAILABLE = {"availableNow": True}


def read_snapshot(spark: SparkSession, table: str) -> DataFrame:
    """The newest finished snapshot."""
    return buckets.read(spark, table)


def stream_snapshot(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    order: Sequence[str] = ("ts",),
    ts: datetime | None = None,
    trigger: Mapping[str, object] = POLLING,
    session_only: bool = False,
) -> StreamingQuery:
    """Keep the latest quote of every stock in ``table``.

    Each batch rewrites the hashed buckets of its own stocks only, then publishes which write
    holds each bucket; the last few snapshots are kept. A repeated batch writes the same
    buckets again and readers see finished writes only, so a lost executor or driver harms no
    snapshot. With ``session_only``, quotes outside trading hours are left out.
    """

    def merge(batch: DataFrame, number: int) -> None:
        polled = batch.where(in_session(F.col("ts"))) if session_only else batch
        quotes = newest_quotes(quote_snapshot(polled, ts, keep=order), F.struct(*order)).persist()
        try:
            buckets.merge(quotes, table, number, "stock_code", lambda both: newest_quotes(both, F.struct(*order)))
        finally:
            quotes.unpersist()

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return query.trigger(**trigger).start()


def close_day(spark: SparkSession, table: str, prices: str, day: date) -> None:
    """After the close: the snapshot's quotes of that day become the day's bars in the price table.

    Run again, it replaces the day's bars.
    """
    quoted = read_snapshot(spark, table).where(F.to_date("ts") == F.lit(day))
    upsert_days(eod_bar(quoted, day), prices)


def _ohlc() -> list[Column]:
    moment = F.struct("ts", "volume")
    priced = F.when(F.col("price").isNotNull(), moment)
    return [
        F.min_by("price", priced).alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", priced).alias("close_price"),
        F.max("volume").alias("volume"),
    ]


def bars_of(quotes: DataFrame, width: str = fv.POLL_INTERVAL) -> DataFrame:
    """OHLC bars of fixed width; ``volume`` is the accumulated volume last seen in the window."""
    windowed = quotes.groupBy("stock_code", F.window("ts", width).alias("w")).agg(*_ohlc())
    return windowed.select(
        "stock_code",
        utc_wall(F.col("w.start")).alias("window_start"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
    )


def stream_bars(stream: DataFrame, width: str = fv.POLL_INTERVAL, delay: str = "10 minutes") -> DataFrame:
    """:func:`bars_of` a stream; a bar appears once the watermark passes its end.

    Quotes that come after that are not in it; :mod:`barloom.streaming.late` keeps them.
    """
    return bars_of(stream.withWatermark("ts", delay), width)


def stream_eod(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One bar per stock and day, once the day is over."""
    days = stream_bars(stream, "1 day", delay)
    return days.select(
        "stock_code",
        F.to_date("window_start").alias("data_date"),
        "high_price",
        "low_price",
        "open_price",
        "close_price",
        "volume",
        F.lit(None).cast("double").alias("adj_close_price"),
    )


def stream_dedup(
    stream: DataFrame, keys: Sequence[str] = ("stock_code", "ts"), delay: str = "10 minutes"
) -> DataFrame:
    """Drop polls that repeat a quote already seen within the delay."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def run_to_table(
    stream: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = AVAILABLE
) -> StreamingQuery:
    """Write the stream into a parquet table; by default what input there is, then stop."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )
