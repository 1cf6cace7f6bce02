"""Joins. Sides are broadcast only by Spark's own size check
(``spark.sql.autoBroadcastJoinThreshold``, again at run time under AQE); beyond it
the same joins shuffle, and AQE splits skewed partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.functions.dates import year_month
from barloom.functions.labels import feed_symbol, price_symbol
from barloom.operators.series import running


def attach_agg(dim: DataFrame, agg: DataFrame, key: str = "stock_code") -> DataFrame:
    """Every row of the dimension with the aggregate of its key, if there is one."""
    return dim.join(agg, key, "left")


def newest_per_key(df: DataFrame, key: str = "stock_code", version: str = "update_date") -> DataFrame:
    return df.groupBy(key).agg(F.max(version).alias(f"newest_{version}"))


def latest_version(df: DataFrame, key: str = "stock_code", version: str = "update_date") -> DataFrame:
    """Rows carrying their key's newest version, ties included.

    The aggregate is combined before its shuffle and the join hashes key and
    version together, so a key with very many versions does not meet in one task.
    """
    newest = newest_per_key(df, key, version).withColumnRenamed(f"newest_{version}", version)
    return df.join(newest, [key, version], "left_semi").select(*df.columns)


def rank_versions(df: DataFrame, key: str = "stock_code", version: str = "update_date") -> DataFrame:
    """:func:`latest_version` as a rank.

    Each task keeps only its own top rank of a key before the shuffle, so this moves far
    fewer rows than the join and is what other operators use.
    """
    window = Window.partitionBy(key).orderBy(F.col(version).desc())
    ranked = df.where(F.col(version).isNotNull()).withColumn("_rank", F.rank().over(window))
    return ranked.where("_rank = 1").drop("_rank")


def with_period_bounds(
    df: DataFrame, key: str = "stock_code", period: Column | None = None, column: str = "data_date"
) -> DataFrame:
    """Each row with its period and the first and last date its key has in it."""
    period = year_month(F.col(column)) if period is None else period
    marked = df.withColumn("data_year_month", period)
    window = Window.partitionBy(key, "data_year_month")
    return marked.withColumns(
        {
            "month_start_date": F.min(column).over(window),
            "month_end_date": F.max(column).over(window),
        }
    )


def natural_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join on all columns the two frames share."""
    common = [name for name in a.columns if name in b.columns]
    if not common:
        raise ValueError("the frames share no column")
    return a.join(b, common, "inner")


def expand_holidays(holidays: DataFrame) -> DataFrame:
    """One row per holiday and day. An interval that ends before it starts has no days."""
    sound = holidays.where(F.col("holiday_start") <= F.col("holiday_end"))
    return sound.withColumn("day", F.explode(F.sequence("holiday_start", "holiday_end")))


def holiday_days(holidays: DataFrame) -> DataFrame:
    """One row per day of any holiday that starts in the day's year, with the end of the earliest one."""
    whole = F.struct("holiday_start", "holiday_end", "holiday_name")
    own_year = expand_holidays(holidays).where(F.year("holiday_start") == F.year("day"))
    return own_year.groupBy("day").agg(F.min(whole).alias("_h")).select("day", "_h.*")


def match_holiday(dates: DataFrame, holidays: DataFrame, column: str = "data_date") -> DataFrame:
    """Each row with the holidays its date lies in, NULL for none.

    Intervals become days, so that the interval condition is an equality.
    """
    days = expand_holidays(holidays).withColumnRenamed("day", column)
    return dates.join(days, column, "left")


def semi(df: DataFrame, keys: DataFrame, key: str = "stock_code") -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def lookup_class(df: DataFrame, securities: DataFrame) -> DataFrame:
    """Codes with their market and the symbols built from it.

    A code whose newest versions name several markets has the last one by name.
    """
    dated = securities.where("update_date IS NOT NULL").groupBy("stock_code")
    markets = dated.agg(F.max_by("stock_class", F.struct("update_date", "stock_class")).alias("stock_class"))
    joined = df.join(markets, "stock_code", "left")
    code, market = F.col("stock_code"), F.col("stock_class")
    return joined.withColumns(
        {"feed_symbol": feed_symbol(code, market), "price_symbol": price_symbol(code, market)}
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str = "stock_code",
    ts: str = "data_date",
    values: Sequence[str] = ("close_price",),
) -> DataFrame:
    """Each left row with the latest right row of its key not after its date.

    Both sides are dates, so the distinct (key, date) pairs to look up are bounded
    by the calendar however often a pair occurs; only these enter the ordered pass.
    """
    payload = F.struct(ts, *values)
    wanted = left.select(key, ts).distinct().withColumn("_bar", F.lit(None).cast(
        right.select(payload.alias("p")).schema["p"].dataType
    ))
    bars = right.select(key, ts, payload.alias("_bar"))
    both = bars.unionByName(wanted).withColumn("_side", F.col("_bar").isNull())
    seen = running(both, (key,), (ts, "_side"), {"_found": ("max", F.col("_bar"))})
    found = seen.where("_side").select(
        key,
        ts,
        F.col(f"_found.{ts}").alias(f"asof_{ts}"),
        *[F.col(f"_found.{name}").alias(f"asof_{name}") for name in values],
    )
    return left.join(found, [key, ts], "left")


def asof_join_instants(
    left: DataFrame,
    right: DataFrame,
    key: str = "stock_code",
    ts: str = "ts",
    values: Sequence[str] = ("price",),
    tolerance: str | None = None,
    bucket: str = "hour",
) -> DataFrame:
    """Each left row with the latest right row of its key not after its instant, and within ``tolerance``
    (an interval, as ``10 minutes``) of it.

    Instants are many, so the series of a key is cut into time buckets (``bucket``, a unit of
    ``date_trunc``): each is ordered for itself, and the last row of those before is carried
    into it, so a key with very many rows is spread over its buckets. Both sides first come down
    to their distinct instants; of right rows of one instant the one with the greatest values counts.
    Left rows without a key or an instant find nothing; right ones without are never found.
    """
    payload = F.struct(ts, *values)
    known = right.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key, ts).agg(F.max(payload).alias("_quote"))
    wanted = left.select(key, ts).where(F.col(key).isNotNull() & F.col(ts).isNotNull()).distinct()
    kind = known.schema["_quote"].dataType
    both = known.unionByName(wanted.withColumn("_quote", F.lit(None).cast(kind))).withColumn("_side", F.col("_quote").isNull())
    seen = running(both, (key,), (ts, "_side"), {"_found": ("max", F.col("_quote"))}, F.date_trunc(bucket, ts))
    near = F.lit(True) if tolerance is None else F.col(f"_found.{ts}") >= F.col(ts) - F.expr(f"INTERVAL {tolerance}")
    found = seen.where("_side").select(
        key,
        ts,
        F.when(near, F.col(f"_found.{ts}")).alias(f"asof_{ts}"),
        *[F.when(near, F.col(f"_found.{name}")).alias(f"asof_{name}") for name in values],
    )
    return left.join(found, [key, ts], "left")
