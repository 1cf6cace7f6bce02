"""Loads of landed reports and quotes into their tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from barloom import fixed_values as fv, schemas
from barloom.functions.labels import code_of_label, index_symbol, normalise_label, paren_word, price_symbol
from barloom.functions.prices import change_ratio, price_or_best_bid
from barloom.operators.filters import drop_label, keep_values
from barloom.operators.project import (
    cast_coerce,
    cast_strict,
    conform,
    fill_zero,
    free_cash_flow,
    null_column,
    null_markers,
    rename_select,
    reserve_sum,
    stamp,
    strip_all_commas,
    with_literals,
)
from barloom.operators.reshape import money_report
from barloom.operators.sets import dedup, union_all
from barloom.operators.versions import mark_failed, scd_changed
from barloom.sources import versions
from barloom.sources.sinks import replace


def quote_snapshot(
    raw: DataFrame, ts: datetime | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw quotes (all text) to the snapshot layout.

    A missing last price is taken from the best bid, missing volumes are 0, other
    missing values NULL. Columns named in ``keep`` go through unchanged.
    """
    named = raw.select(
        F.col("c").alias("stock_code"),
        F.col("n").alias("company_name"),
        price_or_best_bid(F.col("z"), F.col("b")).alias("newest_deal_price"),
        F.col("tv").alias("newest_volume"),
        F.col("v").alias("accumulation_volume"),
        F.col("o").alias("open_price"),
        F.col("h").alias("high_price"),
        F.col("l").alias("low_price"),
        F.col("y").alias("yesterday_close_price"),
        *keep,
    )
    kinds = {field.name: field.dataType for field in schemas.QUOTE_SNAPSHOT}
    clean = null_markers(named)
    typed = clean.select(
        [F.col(n) if n in keep else F.col(n).try_cast(kinds[n]).alias(n) for n in clean.columns]
    )
    filled = fill_zero(typed, ["newest_volume", "accumulation_volume"])
    ratio = change_ratio(F.col("newest_deal_price"), F.col("yesterday_close_price"))
    return stamp(filled.withColumn("price_change_ratio", ratio), ts)


def newest_quotes(snapshot: DataFrame, order: Column) -> DataFrame:
    """One row per stock, the latest by ``order``."""
    row = F.max_by(F.struct(*snapshot.columns), order)
    return snapshot.groupBy("stock_code").agg(row.alias("_row")).select("_row.*")


def eod_bar(snapshot: DataFrame, day: date) -> DataFrame:
    """Closing snapshot as that day's bar."""
    renamed = snapshot.select(
        "stock_code",
        F.lit(day).alias("data_date"),
        "high_price",
        "low_price",
        "open_price",
        F.col("newest_deal_price").alias("close_price"),
        F.col("accumulation_volume").alias("volume"),
    )
    return conform(null_column(renamed, "adj_close_price"), schemas.STOCK_PRICE)


def industry_ratios(report: DataFrame, month: str) -> DataFrame:
    """Ratios of the listed industries; report columns are the sheet's own headings."""
    heading = next(iter(fv.INDUSTRY_RATIO_COLUMNS))
    chosen = rename_select(keep_values(report, f"`{heading}`", fv.INDUSTRIES), fv.INDUSTRY_RATIO_COLUMNS)
    labelled = chosen.withColumn("stock_industry", normalise_label(F.col("stock_industry")))
    return with_literals(labelled, {"data_year_month": month})


def dividends(report: DataFrame) -> DataFrame:
    """Dividend report: the remaining columns are known by position."""
    kept = report.drop(*[f"{name}" for name in fv.DIVIDEND_DROPPED])
    named = kept.toDF(*fv.DIVIDEND_NAMES)
    coded = named.withColumn("stock_code", code_of_label(F.col("stock_code")))
    return reserve_sum(coded).select(*fv.DIVIDEND_LAYOUT)


def fx_rates(report: DataFrame, day: date) -> DataFrame:
    """First five columns of the rate sheet with the currency's code."""
    first = report.select(*[F.col(f"`{n}`") for n in report.columns[:5]]).toDF(*fv.FX_COLUMNS)
    coded = first.withColumn("currency_type", paren_word(F.col("currency_type")))
    return null_markers(with_literals(coded, {"data_date": day}))


def monthly_revenue(report: DataFrame, month: str) -> DataFrame:
    """Revenue rows of real companies: totals and rows without a number go."""
    numbers = cast_coerce(report, "當月營收", "double")
    rows = drop_label(numbers, fv.CODE_HEADING, fv.TOTAL_LABEL)
    return rename_select(with_literals(rows, {"revenue_year_month": month}), fv.REVENUE_COLUMNS)


def investor_flows(report: DataFrame, day: date | Column, market: str = "TWSE") -> DataFrame:
    """Daily flow report of one market; numbers come with thousands commas.

    ``day`` is the report's date, or the column that holds it.
    """
    plain = strip_all_commas(report)
    columns = fv.FLOW_HEADINGS[market]
    heading = next(iter(columns))
    when = day if isinstance(day, Column) else F.lit(day)
    coded = plain.withColumns({heading: F.translate(f"`{heading}`", '="', ""), "data_date": when})
    return conform(rename_select(coded, {**columns, "data_date": "data_date"}), schemas.INVESTOR_FLOWS)


def market_flows(reports: Mapping[str, DataFrame], day: date | Column) -> DataFrame:
    """The flow reports of several markets as one frame."""
    return union_all([investor_flows(report, day, market) for market, report in reports.items()])


def investor_money(report: DataFrame, market: str, line: str = "line_no") -> DataFrame:
    """Money report of one market as published: investors by their line, sides by their headings.

    Lines are numbered from 0 in ``line``; subtotals and lines behind the known ones go.
    """
    named = F.lit(None).cast("string")
    for number, name in enumerate(fv.MONEY_ROWS[market]):
        if name:
            named = F.when(F.col(line) == number, name).otherwise(named)
    sides = fv.MONEY_SIDES[market]
    plain = strip_all_commas(report).withColumn("investor", named).where("investor IS NOT NULL")
    numbers = cast_strict(plain, sides)
    chosen = numbers.select(
        F.lit(market).alias("stock_class"), "data_date", "investor", *[F.col(f"`{name}`") for name in sides]
    )
    return conform(money_report(chosen), schemas.INVESTOR_MONEY)


def market_money(reports: Mapping[str, DataFrame], line: str = "line_no") -> DataFrame:
    """The money reports of several markets as one frame."""
    return union_all([investor_money(report, market, line) for market, report in reports.items()])


def security_headings(market: str) -> dict[str, str]:
    """Headings of a market's company list and their columns; one heading names the market."""
    listed = fv.SECURITY_LISTED_HEADING
    return {listed[market] if heading == listed["TWSE"] else heading: name for heading, name in fv.SECURITY_COLUMNS.items()}


def security_master(report: DataFrame, market: str) -> DataFrame:
    """Company list of one market in the common layout."""
    named = rename_select(drop_label(report, fv.CODE_HEADING, fv.CODE_HEADING), security_headings(market))
    return with_literals(named, {"stock_class": market, "stock_class_ch": fv.MARKET_NAMES[market]})


def master_load(reports: Mapping[str, DataFrame], day: date) -> DataFrame:
    """Company lists of the markets as one security master: dates from ``y/M/d``, whole numbers."""
    lists = union_all([security_master(report, market) for market, report in reports.items()])
    dates = {name: F.try_to_date(name, "y/M/d") for name in ("establishment_date", "listed_date")}
    numbers = ("company_capital", "outstanding_principal", "private_equity", "preferred_stock")
    stamped = cast_strict(lists.withColumns(dates), numbers).withColumns(
        {"update_date": F.lit(day), "stock_status": F.lit("1")}
    )
    return conform(stamped, schemas.SECURITIES)


def refresh_master(table: str, new: DataFrame, failed: DataFrame, day: date) -> None:
    """Replace the stored master by one made from it and a new load.

    Changed stocks keep their old versions beside the new ones, and stocks whose prices could
    not be loaded (``failed``) get status 0.
    """
    spark = new.sparkSession
    if versions.finished(spark, table):
        new = scd_changed(versions.read(spark, table), new, day)
    replace(mark_failed(new, failed), table)


def _feed_bars(feed: DataFrame, code: Column) -> DataFrame:
    """Bars of a price feed: feed headings, dates with a time of day, repeated rows."""
    named = feed.select(
        code.alias("stock_code"),
        F.to_date("Date").alias("data_date"),
        F.col("High").alias("high_price"),
        F.col("Low").alias("low_price"),
        F.col("Open").alias("open_price"),
        F.col("Close").alias("close_price"),
        F.col("Volume").alias("volume"),
        F.col("`Adj Close`").alias("adj_close_price"),
    )
    return dedup(conform(named, schemas.STOCK_PRICE))


def price_load(feed: DataFrame, securities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars of the securities from a feed of symbols, and the codes the feed has no bar of.

    ``securities`` has one row per ``stock_code`` with its ``stock_class``.
    """
    symbol = price_symbol(F.col("stock_code"), F.col("stock_class"))
    wanted = securities.select("stock_code", symbol.alias("Symbol"))
    prices = _feed_bars(feed.join(wanted, "Symbol"), F.col("stock_code"))
    failed = wanted.join(feed.select("Symbol").distinct(), "Symbol", "left_anti").select("stock_code")
    return prices, failed


def index_load(feed: DataFrame) -> DataFrame:
    """Bars of indices; codes are the symbols without their caret."""
    return _feed_bars(feed, index_symbol(F.col("Symbol")))


def cash_flow_report(report: DataFrame, season: str) -> DataFrame:
    """Published cash flows of one season: columns are known by position, code and name first."""
    named = strip_all_commas(report.toDF("stock_code", "stock_name", *fv.CASH_FLOW_MEASURES))
    numbers = cast_strict(drop_label(named, "stock_code", fv.CODE_HEADING), fv.CASH_FLOW_MEASURES)
    dated = with_literals(numbers, {"cash_flows_year": season})
    return free_cash_flow(dated).select("stock_code", "cash_flows_year", *fv.CASH_FLOW_MEASURES)
