"""Versions of the security master."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.operators.joins import semi

_VERSION_COLUMNS = ("update_date", "stock_status")


def scd_changed(old: DataFrame, new: DataFrame, day: date) -> DataFrame:
    """Master after a load: all new rows, stamped, and the old rows of changed stocks.

    A stock has changed when old and new rows together show more than one version,
    apart from their load date and status. Stocks missing from the new load that never
    changed leave the master.
    """
    facts = [name for name in old.columns if name not in _VERSION_COLUMNS]
    # least and greatest version differ where there are several: one grouping, no distinct rows
    version = F.struct(*facts)
    both = old.select(facts).unionByName(new.select(facts)).groupBy("stock_code")
    spread = both.agg(F.min(version).alias("least"), F.max(version).alias("greatest"))
    kept = semi(old, spread.where(~F.col("least").eqNullSafe(F.col("greatest"))))
    stamped = new.select(
        *facts, F.lit(day).alias("update_date"), F.lit("1").alias("stock_status")
    )
    return stamped.unionByName(kept.select(*facts, *_VERSION_COLUMNS))


def mark_failed(securities: DataFrame, failed: DataFrame) -> DataFrame:
    """Status 0 for codes whose prices could not be loaded."""
    codes = failed.select("stock_code").distinct().withColumn("_failed", F.lit(True))
    joined = securities.join(codes, "stock_code", "left")
    status = F.when(F.col("_failed"), F.lit("0")).otherwise(F.col("stock_status"))
    return joined.withColumn("stock_status", status).select(*securities.columns)


def with_validity(securities: DataFrame, key: str = "stock_code", version: str = "update_date") -> DataFrame:
    """Each row with ``valid_from`` and ``valid_to`` (the day of its key's next version, NULL for the newest).

    A version is all rows of a key and date. The window sees the distinct dates of a key only,
    which the calendar bounds. Rows without a date have no interval and are left out.
    """
    dates = securities.where(F.col(version).isNotNull()).select(key, version).distinct()
    following = F.lead(version).over(Window.partitionBy(key).orderBy(version))
    intervals = dates.select(key, version, F.col(version).alias("valid_from"), following.alias("valid_to"))
    return securities.join(intervals, [key, version])


def at_dates(
    asked: DataFrame,
    intervals: DataFrame,
    key: str = "stock_code",
    day: str = "data_date",
    newest: bool = True,
    span_days: int = 366,
) -> DataFrame:
    """The rows of ``asked`` with the version that is valid on their day, NULL columns where none is.

    ``intervals`` has ``valid_from`` (NULL: always) and ``valid_to`` (exclusive, NULL: still), which
    may overlap; where several hold a day, those that began last count, or all with ``newest`` off.
    An interval that ends before it begins holds no day.

    The time line is cut into spans of ``span_days``; an interval is copied to the spans it meets,
    at most as far as days are asked for, so that holding a day becomes an equality of key and
    span, and a key with very many rows is spread over its spans. Only the distinct days asked of
    a key are looked up, by their bounded number, however often they are asked.
    """
    wanted = asked.select(key, day).where(F.col(key).isNotNull() & F.col(day).isNotNull()).distinct()
    ends = wanted.groupBy(key).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))

    def span(value: Column) -> Column:
        return F.floor(F.datediff(value, F.lit(date(1970, 1, 1))) / span_days)

    start = F.greatest(F.coalesce("valid_from", "_first"), F.col("_first"))
    end = F.least(F.coalesce(F.date_sub("valid_to", 1), "_last"), F.col("_last"))
    meeting = intervals.join(ends, key).withColumns({"_start": start, "_end": end}).where("_start <= _end")
    copied = meeting.withColumn("_span", F.explode(F.sequence(span(F.col("_start")), span(F.col("_end")))))
    lookups = wanted.withColumn("_span", span(F.col(day)))
    held = lookups.join(copied, [key, "_span"]).where(F.col(day).between(F.col("_start"), F.col("_end")))
    if newest:
        least = F.coalesce("valid_from", F.make_date(F.lit(1), F.lit(1), F.lit(1)))
        last = held.groupBy(key, day).agg(F.max(least).alias("_began"))
        held = held.join(last, [key, day]).where(least == F.col("_began")).drop("_began")
    found = held.drop("_span", "_start", "_end", "_first", "_last")
    return asked.join(found, [key, day], "left")
