"""Institutional investor flows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from barloom import fixed_values as fv
from barloom.functions.prices import positive_flag
from barloom.operators.filters import having_any, recent_days
from barloom.operators.joins import attach_agg, rank_versions
from barloom.operators.series import POSITION, with_last_marked

INVESTOR_CLASSES = ("foreign_investor", "investment_trust", "dealer", "institutional_investors")


def recent_activity(flows: DataFrame, as_of: date | str, n: int = fv.RECENT_DAYS) -> DataFrame:
    """:func:`flow_sums` and :func:`count_positive` of the recent days, from one grouping."""
    recent = recent_days(flows, as_of, n)
    both = recent.select(*recent.columns, *[x.alias(f"_{name}") for name, x in _class_amounts().items()])
    return both.groupBy("stock_code").agg(
        *[(F.sum(name) / 1000).alias(name) for name in fv.FLOW_VOLUMES],
        *[_buy_count(f"_{name}").alias(f"{name}_buy_count") for name in INVESTOR_CLASSES],
    )


def flow_sums(flows: DataFrame, as_of: date | str, n: int = fv.RECENT_DAYS) -> DataFrame:
    """Flows per stock over the recent days, in thousands of shares."""
    recent = recent_days(flows, as_of, n)
    return recent.groupBy("stock_code").agg(
        *[(F.sum(name) / 1000).alias(name) for name in fv.FLOW_VOLUMES]
    )


def flow_ratio(
    securities: DataFrame,
    flows: DataFrame,
    as_of: date | str,
    n: int = fv.RECENT_DAYS,
    newest: bool = True,
    sums: DataFrame | None = None,
) -> DataFrame:
    """Recent flows relative to company capital, per mille; NULL without flows or capital.

    ``newest=False`` keeps one row per version of a security. ``sums`` are the flow sums,
    where they are known already.
    """
    base = rank_versions(securities) if newest else securities
    capital = F.col("company_capital") / 1000
    joined = attach_agg(
        base.select("stock_code", "company_name_ch", capital.alias("_capital")),
        flow_sums(flows, as_of, n) if sums is None else sums,
        "stock_code",
    )
    return joined.select(
        "stock_code",
        "company_name_ch",
        *[
            (F.try_divide(F.col(name), F.col("_capital")) * 1000).alias(
                name.replace("_vol_amount", "_ratio")
            )
            for name in fv.FLOW_VOLUMES
        ],
    )


def _class_amounts() -> dict[str, Column]:
    """Daily flow of the four investor classes: dealers join their hedges, foreign
    investors their dealers."""
    return {
        "foreign_investor": F.col("foreign_investor_dealer_vol_amount") + F.col("foreign_investor_vol_amount"),
        "investment_trust": F.col("investment_trust_vol_amount"),
        "dealer": F.col("dealer_vol_amount") + F.col("dealer_hedge_vol_amount"),
        "institutional_investors": F.col("institutional_investors_vol_amount"),
    }


def class_flows(flows: DataFrame) -> DataFrame:
    """Daily flow of the four investor classes."""
    amounts = [amount.alias(name) for name, amount in _class_amounts().items()]
    return flows.select("stock_code", "data_date", *amounts)


def _buy_count(name: str) -> Column:
    return F.sum(positive_flag(F.col(name))).cast("bigint")


def count_positive(flows: DataFrame) -> DataFrame:
    """Buying days per stock and investor class."""
    counts = [_buy_count(name).alias(f"{name}_buy_count") for name in INVESTOR_CLASSES]
    return class_flows(flows).groupBy("stock_code").agg(*counts)


def flow_positive_days(
    flows: DataFrame, as_of: date | str, days: int = fv.POSITIVE_DAYS, n: int = fv.RECENT_DAYS
) -> DataFrame:
    """Stocks bought by any class on exactly ``days`` of the recent calendar days."""
    counts = count_positive(recent_days(flows, as_of, n))
    return having_any(counts, [f"{name}_buy_count" for name in INVESTOR_CLASSES], days)


def flow_streak(flows: DataFrame, days: int = fv.POSITIVE_DAYS) -> DataFrame:
    """Length of the unbroken run of buying days each row stands in, per class.

    Counts the stock's own rows (trading days). Keeps rows where at least one class
    has bought for ``days`` rows or more.
    """
    marks = {f"_broken_{name}": ~F.coalesce(F.col(name) > 0, F.lit(False)) for name in INVESTOR_CLASSES}
    marked = with_last_marked(class_flows(flows), marks)
    streaks = {name: F.col(POSITION) - F.col(f"_broken_{name}") for name in INVESTOR_CLASSES}
    result = marked.select(
        "stock_code",
        "data_date",
        *[streak.cast("bigint").alias(f"{name}_streak") for name, streak in streaks.items()],
    )
    return result.where(F.greatest(*[f"{name}_streak" for name in INVESTOR_CLASSES]) >= days)
