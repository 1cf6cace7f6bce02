"""Weekly and monthly bars from daily ones."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from barloom.functions.dates import iso_week, week_bounds, week_year, year_month
from barloom.operators.filters import between_dates, in_month


def first_nonnull(value: str, order: str) -> Column:
    """Earliest value that is not NULL."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order)))


def last_nonnull(value: str, order: str) -> Column:
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order)))


def first_last_nonnull(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        first_nonnull(value, order).alias(f"first_{value}"),
        last_nonnull(value, order).alias(f"last_{value}"),
    )


def _bar(order: str = "data_date") -> list[Column]:
    return [
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        first_nonnull("open_price", order).alias("open_price"),
        last_nonnull("close_price", order).alias("close_price"),
        F.coalesce(F.sum("volume"), F.lit(0)).cast("bigint").alias("volume"),
    ]


def _with_week(prices: DataFrame) -> DataFrame:
    day = F.col("data_date")
    monday, friday = week_bounds(day)
    return prices.select(
        "*",
        week_year(day).alias("data_year"),
        iso_week(day).alias("week_num"),
        monday.alias("week_start_date"),
        friday.alias("week_end_date"),
    )


def bars_week(
    prices: DataFrame, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """One bar per stock and ISO week; open and close skip NULLs. One shuffle."""
    chosen = between_dates(prices, start, end).where(F.col("stock_code").isNotNull())
    keys = ("stock_code", "data_year", "week_num", "week_start_date", "week_end_date")
    return _with_week(chosen).groupBy(*keys).agg(*_bar())


def bars_month(prices: DataFrame, month: str | None = None) -> DataFrame:
    """One bar per stock and month with the first and last traded date in it."""
    chosen = in_month(prices, month) if month else prices
    return (
        chosen.where(F.col("stock_code").isNotNull())
        .withColumn("data_year_month", year_month(F.col("data_date")))
        .groupBy("stock_code", "data_year_month")
        .agg(
            F.min("data_date").alias("month_start_date"),
            F.max("data_date").alias("month_end_date"),
            *_bar(),
        )
    )


def bars_multi(prices: DataFrame) -> DataFrame:
    """Weekly, monthly and all-time bars from one scan; ``grain`` tells them apart."""
    day = F.col("data_date")
    marked = prices.where(F.col("stock_code").isNotNull()).withColumns(
        {"week": week_bounds(day)[0].cast("string"), "month": year_month(day)}
    )
    grain = (
        F.when(F.grouping("week") == 0, "week").when(F.grouping("month") == 0, "month").otherwise("all")
    )
    grouped = marked.groupingSets(
        [
            [F.col("stock_code"), F.col("week")],
            [F.col("stock_code"), F.col("month")],
            [F.col("stock_code")],
        ],
        "stock_code",
        "week",
        "month",
    ).agg(grain.alias("grain"), *_bar())
    return grouped.select(
        "stock_code",
        "grain",
        F.coalesce("week", "month", F.lit("all")).alias("period"),
        "high_price",
        "low_price",
        "open_price",
        "close_price",
        "volume",
    )


def join_aggs(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left-join frames of one row per key. One ``groupBy`` does the same work in
    one shuffle where the frames come from one table; see :func:`bars_week`."""
    result, *rest = frames
    for frame in rest:
        result = result.join(frame, list(keys), "left")
    return result
