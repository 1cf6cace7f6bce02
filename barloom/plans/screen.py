"""Stock screen: indicators of stocks with recent investor buying."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from barloom import fixed_values as fv
from barloom.operators.filters import having_any
from barloom.operators.flows import INVESTOR_CLASSES, flow_ratio, recent_activity
from barloom.operators.indicators import indicators
from barloom.operators.joins import natural_join, semi
from barloom.operators.signals import kd_overbought, kd_oversold
from barloom.session import work_folder


def screen(
    prices: DataFrame,
    flows: DataFrame,
    securities: DataFrame,
    side: str,
    as_of: date | str,
    n: int = fv.RECENT_DAYS,
) -> DataFrame:
    """Bars with indicators, flow ratios, buying-day counts and the side's flag.

    Only stocks with enough buying days can be in the answer. They are few and cheap to
    find: one grouping of the recent flows gives them with their sums, and that small list
    is stored, since prices, securities and the answer all read it.
    """
    if side not in ("long", "short"):
        raise ValueError(f"side must be long or short, not {side!r}")
    spark = prices.sparkSession
    counts = [f"{name}_buy_count" for name in INVESTOR_CLASSES]
    active = having_any(recent_activity(flows, as_of, n), counts, fv.POSITIVE_DAYS)
    place = work_folder(spark, "active")
    active.write.parquet(place)
    active = spark.read.schema(active.schema).parquet(place)
    ratios = flow_ratio(semi(securities, active), flows, as_of, n, sums=active.drop(*counts))
    lines = indicators(semi(prices, active))
    flagged = kd_oversold(lines) if side == "long" else kd_overbought(lines)
    return natural_join(flagged, natural_join(ratios, active.select("stock_code", *counts)))
