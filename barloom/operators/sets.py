"""Unions, distinct rows, counts, ordering."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from barloom import fixed_values as fv
from barloom.operators.series import POSITION, with_position


def union_markets(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns a frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).distinct()


def union_today(history: DataFrame, snapshot: DataFrame, day: date) -> DataFrame:
    """History plus today's quotes as bars; the snapshot wins where both have the day."""
    today = snapshot.select(
        "stock_code",
        F.lit(day).alias("data_date"),
        "open_price",
        "high_price",
        "low_price",
        F.col("newest_deal_price").alias("close_price"),
        F.col("accumulation_volume").alias("volume"),
    )
    columns = today.columns
    is_today = F.col("data_date") == F.lit(day)
    earlier = history.where(~is_today).select(columns)
    # only the overlapping day needs the check, so history is not shuffled
    overlap = history.where(is_today).select(columns)
    unreplaced = overlap.join(today.select("stock_code"), "stock_code", "left_anti")
    return earlier.unionByName(unreplaced.select(columns)).unionByName(today)


def distinct_codes(df: DataFrame, key: str = "stock_code") -> DataFrame:
    return df.select(key).distinct()


def dedup(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Drop repeated rows. The date is a column here, so equal bars of two days stay."""
    return df.dropDuplicates(list(keys)) if keys else df.distinct()


def changed_keys(df: DataFrame, key: str = "stock_code") -> DataFrame:
    """Keys with more than one version and how many."""
    return df.groupBy(key).agg(F.count("*").alias("version_count")).where("version_count > 1")


def sort_by(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.orderBy(*columns)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order, as a combining aggregate."""
    rest = [name for name in df.columns if name not in keys]
    row = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*")


def load_counts(checked: DataFrame, by: str) -> DataFrame:
    """Sound and failed rows per load, of rows that say in ``failed_columns`` what failed."""
    failed = F.col("failed_columns").isNotNull()
    return checked.groupBy(by).agg(
        F.count_if(~failed).alias("row_count"), F.count_if(failed).alias("error_count")
    )


def observe_counts(df: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without a second pass."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("row_count")), observation


def _short_prefixes(codes: DataFrame, code: str, most: int) -> DataFrame:
    """Each distinct code with its shortest prefix that no more than ``most`` rows share.

    Such prefixes sort as their codes do. A code of which there are more is its own.
    """
    counts = codes.groupBy(code).agg(F.count("*").alias("n"))
    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(code), F.lit(1))), lambda i: F.left(F.col(code), i))
    spread = counts.select(code, "n", F.explode(parts).alias("_prefix"))
    small = spread.groupBy("_prefix").agg(F.sum("n").alias("n")).where(F.col("n") <= most)
    shortest = spread.join(small.select("_prefix"), "_prefix").groupBy(code).agg(F.min("_prefix").alias("_prefix"))
    return counts.select(code).join(shortest, code, "left").select(code, F.coalesce("_prefix", code).alias("_prefix"))


def chunk_codes(
    df: DataFrame, code: str = "stock_code", size: int = fv.CODES_PER_BATCH, most: int = 10_000
) -> DataFrame:
    """Codes in their order, ``size`` at a time, joined by ``|``.

    Numbers the codes inside groups of at most ``most`` that share a prefix and chains the
    groups by their counts, so that no single task sorts all codes, however alike they are.
    """
    codes = df.select(code).where(F.col(code).isNotNull())
    grouped = codes.join(_short_prefixes(codes, code, most), code)
    numbered = with_position(grouped, (), (code,), bucket=F.col("_prefix")).drop("_prefix")
    batch = F.floor((F.col(POSITION) - 1) / size)
    return numbered.groupBy(batch.alias("batch_no")).agg(
        F.array_join(F.array_sort(F.collect_list(code)), "|").alias("codes"),
        F.count("*").alias("code_count"),
    )


def revenue_growth(revenue: DataFrame) -> DataFrame:
    """Month-on-month, year-on-year and year-to-date figures from monthly revenue.

    Each month is sent to itself, to the following month and to the same month of the
    following year, so that the comparison is one grouping and gaps in the months
    give NULL. ``revenue`` has ``stock_code, ym (yyyymm), gross_revenue``.
    """
    month_no = F.expr("ym div 100") * 12 + F.col("ym") % 100 - 1
    amount = F.col("gross_revenue")
    targets = F.array(
        *[
            F.struct(F.lit(shift).alias("shift"), (month_no + shift).alias("month_no"))
            for shift in (0, 1, 12)
        ]
    )
    sent = revenue.select("stock_code", amount.alias("amount"), F.explode(targets).alias("t"))

    def at(shift: int) -> Column:
        return F.sum(F.when(F.col("t.shift") == shift, F.col("amount")))

    months = sent.groupBy("stock_code", F.col("t.month_no").alias("month_no")).agg(
        at(0).alias("gross_revenue"),
        at(1).alias("last_month_gross_revenue"),
        at(12).alias("last_year_gross_revenue"),
    )
    year = F.expr("month_no div 12")
    to_date = Window.partitionBy("stock_code", year).orderBy("month_no")
    with_totals = months.withColumns(
        {
            "accumulation_revenue": F.sum("gross_revenue").over(to_date),
            "last_year_accumulation_revenue": F.sum("last_year_gross_revenue").over(to_date),
        }
    )

    def change(now: str, then: str) -> Column:
        return F.try_divide(F.col(now) - F.col(then), F.col(then)) * 100

    return with_totals.where(amount.isNotNull()).select(
        "stock_code",
        F.format_string("%d-%02d", year, F.col("month_no") % 12 + 1).alias("revenue_year_month"),
        change("gross_revenue", "last_month_gross_revenue").alias("last_month_revenue_change_ratio"),
        "last_month_gross_revenue",
        change("gross_revenue", "last_year_gross_revenue").alias("last_year_revenue_change_ratio"),
        "last_year_gross_revenue",
        "gross_revenue",
        change("accumulation_revenue", "last_year_accumulation_revenue").alias(
            "prophase_revenue_change_ratio"
        ),
        "last_year_accumulation_revenue",
        "accumulation_revenue",
    )
