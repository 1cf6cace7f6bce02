"""Date rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from barloom import fixed_values as fv


def week_bounds(day: Column) -> tuple[Column, Column]:
    """Monday and Friday of the ISO week; weekends belong to the week before them."""
    monday = F.date_trunc("week", day).cast("date")
    return monday, F.date_add(monday, 4)


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def week_year(day: Column) -> Column:
    """Year the ISO week counts towards, as text."""
    return F.extract(F.lit("YEAROFWEEK"), day).cast("string")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_key(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year, month)


def month_back(day: Column) -> Column:
    """Key of the calendar month before ``day``."""
    return year_month(F.add_months(day, -1))


def days_back(day: Column, n: int = 30) -> Column:
    """Key of the month ``n`` days before ``day``."""
    return year_month(F.date_sub(day, n))


def roc_year(year: Column) -> Column:
    """Gregorian years become ROC years; small numbers are ROC years already."""
    return F.when(year > fv.ROC_THRESHOLD, year - fv.ROC_OFFSET).otherwise(year)


def to_roc(day: Column) -> Column:
    return F.format_string(
        "%d/%02d/%02d", F.year(day) - fv.ROC_OFFSET, F.month(day), F.day(day)
    )


def from_roc(text: Column) -> Column:
    parts = F.split(text, "/")
    number = [F.get(parts, F.lit(i)).try_cast("int") for i in range(3)]
    written = F.format_string("%04d-%02d-%02d", number[0] + fv.ROC_OFFSET, number[1], number[2])
    return F.when(number[0].isNotNull() & number[1].isNotNull() & number[2].isNotNull(), F.try_to_date(written))


def weekday_class(day: Column) -> Column:
    """Which load a day belongs to: flows Monday to Friday, indices on Sunday."""
    return (
        F.when(F.weekday(day) < 5, "flows")
        .when(F.weekday(day) == 6, "indices")
        .otherwise("none")
    )


def is_holiday_load(day: Column) -> Column:
    return (F.month(day) == 1) & (F.day(day) == 5)


def is_ratio_load(day: Column) -> Column:
    return F.day(day) == 7


def utc_instant(wall: Column) -> Column:
    """Wall-clock time as an instant, whatever the session's time zone."""
    return F.concat(wall.cast("string"), F.lit("Z")).cast("timestamp")


def utc_wall(instant: Column) -> Column:
    """Inverse of :func:`utc_instant`."""
    seconds = (F.unix_micros(instant).cast("decimal(18,0)") / 1000000).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def _second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)


def _clock(text: str) -> int:
    hours, minutes = text.split(":")
    return int(hours) * 3600 + int(minutes) * 60


def in_session(ts: Column) -> Column:
    """Within trading hours, both ends included."""
    return _second_of_day(ts).between(_clock(fv.SESSION_OPEN), _clock(fv.SESSION_CLOSE))


def after_close(ts: Column) -> Column:
    return _second_of_day(ts) >= _clock(fv.SESSION_CLOSE)
