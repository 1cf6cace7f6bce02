"""Price expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from barloom import fixed_values as fv


def price_or_best_bid(last: Column, bids: Column) -> Column:
    """Last price, or the first step of the bid ladder where it is ``-``."""
    return F.when(last == fv.MISSING_MARKER, F.split_part(bids, F.lit("_"), F.lit(1))).otherwise(
        last
    )


def change_ratio(last: Column, previous: Column) -> Column:
    """Percent change to two digits, half to even; NULL on a zero base."""
    percent = F.try_divide(last - previous, previous) * 100
    return F.rint(percent * 100) / 100


def positive_flag(value: Column) -> Column:
    return F.when(value > 0, 1).otherwise(0)


def sum_components(columns: Sequence[str]) -> Column:
    """Sum that is NULL as soon as one component is."""
    return reduce(lambda a, b: a + b, [F.col(f"`{name}`") for name in columns])
