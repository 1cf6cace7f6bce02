"""Work-day rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom import fixed_values as fv
from barloom.functions.labels import strip_weekday
from barloom.operators.joins import holiday_days


def next_workday(
    dates: DataFrame, holidays: DataFrame, column: str = "data_date", name: str = "work_date"
) -> DataFrame:
    """Move a date off weekends and holidays, once.

    In a holiday: the day after its end. Else Saturday moves two days, Sunday one. The
    result is not checked again, so a holiday ending on Friday gives a Saturday.
    Holidays count for dates of the year they start in; of several, the earliest does.
    """
    days = holiday_days(holidays).select(
        F.col("day").alias(column), F.col("holiday_end").alias("_holiday_end")
    )
    day = F.col(column)
    weekday = F.weekday(day)
    moved = (
        F.when(F.col("_holiday_end").isNotNull(), F.date_add("_holiday_end", 1))
        .when(weekday == 5, F.date_add(day, 2))
        .when(weekday == 6, F.date_add(day, 1))
        .otherwise(day)
    )
    return dates.join(days, column, "left").withColumn(name, moved).select(*dates.columns, name)


def next_workday_strict(
    dates: DataFrame, holidays: DataFrame, column: str = "data_date", name: str = "work_date"
) -> DataFrame:
    """The first date from each date on that is neither weekend nor holiday.

    Days off that follow each other without a work day between them are one run, found on
    the calendar the holidays cover: its size is that of the calendar, not of the dates.
    """
    free = holiday_days(holidays).select("day")
    # a run can begin or end in a weekend beside the holidays
    near = free.select(F.explode(F.sequence(F.date_sub("day", 2), F.date_add("day", 2))).alias("day"))
    off = free.unionByName(near.where(F.weekday("day") >= 5)).distinct()
    by_day = Window.orderBy("day")
    starts = F.coalesce(F.date_diff("day", F.lag("day").over(by_day)) > 1, F.lit(True))
    runs = off.withColumn("run", F.sum(starts.cast("int")).over(by_day))
    ends = runs.withColumn("end", F.max("day").over(Window.partitionBy("run")))
    days = ends.select(F.col("day").alias(column), F.date_add("end", 1).alias("_next"))
    day = F.col(column)
    weekend = F.when(F.weekday(day) == 5, F.date_add(day, 2)).when(F.weekday(day) == 6, F.date_add(day, 1))
    moved = F.coalesce(F.col("_next"), weekend, day)
    return dates.join(days, column, "left").withColumn(name, moved).select(*dates.columns, name)


def _deadline_rows() -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(kind).alias("company_kind"),
                F.lit(period).alias("report"),
                F.lit(day).alias("month_day"),
            )
            for kind, days in (
                ("general", fv.GENERAL_DEADLINES),
                ("financial", fv.FINANCIAL_DEADLINES),
            )
            for period, day in days.items()
        ]
    )


def filing_deadlines(years: DataFrame, holidays: DataFrame, column: str = "year") -> DataFrame:
    """Filing dates of each year for general and financial companies.

    ``report_year`` is the year reported on: the annual report is due a year later.
    """
    year = F.col(column)
    rows = years.select(year.cast("int").alias("year"), F.explode(_deadline_rows()).alias("r")).select(
        "year",
        "r.company_kind",
        "r.report",
        F.when(F.col("r.report") == "annual", F.col("year") - 1)
        .otherwise(F.col("year"))
        .alias("report_year"),
        F.to_date(F.format_string("%d-%s", F.col("year"), F.col("r.month_day"))).alias("due_date"),
    )
    return next_workday(rows, holidays, "due_date", "filing_date")


def parse_holiday(df: DataFrame, year: Column) -> DataFrame:
    """``M/D(weekday)-M/D(weekday)`` and a year to a holiday with start and end.

    A single day is its own end. Text that is no date gives NULL.
    """
    parts = F.split(strip_weekday(F.col("holiday_range")), "-")

    def day(i: int) -> Column:
        part = F.coalesce(F.get(parts, F.lit(i)), F.get(parts, F.lit(0)))
        text = F.concat(year.cast("string"), F.lit("/"), F.trim(part))
        return F.try_to_date(text, "y/M/d")

    return df.select(
        "holiday_name",
        year.cast("string").alias("holiday_year"),
        day(0).alias("holiday_start"),
        day(1).alias("holiday_end"),
        "holiday_day",
        "holiday_remarks",
    )
