"""Filters, written so that they reach the file scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F


def _day(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def between_dates(
    df: DataFrame,
    start: date | str | None,
    end: date | str | None,
    column: str = "data_date",
) -> DataFrame:
    """Both ends included; a missing end leaves that side open."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(_day(start)))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(_day(end)))
    return df


def in_month(df: DataFrame, month: str, column: str = "data_date") -> DataFrame:
    """Rows of a ``YYYY-MM`` month, as a half-open range the scan can use."""
    first = date.fromisoformat(f"{month}-01")
    following = (first + timedelta(days=32)).replace(day=1)
    return df.where((F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(following)))


def recent_days(df: DataFrame, as_of: date | str, n: int = 3, column: str = "data_date") -> DataFrame:
    """``as_of`` and the ``n`` calendar days before it. Later dates pass too."""
    return df.where(F.col(column) >= F.lit(_day(as_of) - timedelta(days=n)))


def keep_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def drop_label(df: DataFrame, column: str, label: str) -> DataFrame:
    """Drop total rows or repeated headers. NULL is no label and stays."""
    return df.where(~F.col(column).eqNullSafe(F.lit(label)))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def year_of(df: DataFrame, column: str, year: int) -> DataFrame:
    return df.where(
        (F.col(column) >= F.lit(date(year, 1, 1))) & (F.col(column) < F.lit(date(year + 1, 1, 1)))
    )


def active_only(
    df: DataFrame, columns: Sequence[str] = ("stock_code", "stock_class"), status: str = "1"
) -> DataFrame:
    return df.where(F.col("stock_status") == status).select(*columns).distinct()


def having_any(df: DataFrame, columns: Sequence[str], value: int) -> DataFrame:
    """Rows where at least one of the columns equals the value."""
    return df.where(F.array_contains(F.array(*columns), value))
