"""Signals read from indicator columns, and what followed them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from barloom import fixed_values as fv
from barloom.operators.indicators import priced, with_sma
from barloom.operators.series import CHUNK_ROWS, chunked, own_rows


def crossed(gap: Column, previous_gap: Column, side: str) -> Column:
    """Whether a difference of two lines changed to above (long) or below (short) zero."""
    if side == "long":
        return (previous_gap <= 0) & (gap > 0)
    if side == "short":
        return (previous_gap >= 0) & (gap < 0)
    raise ValueError(f"side must be long or short, not {side!r}")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def kd_oversold(frame: DataFrame, level: float = fv.OVERSOLD_LEVEL) -> DataFrame:
    """``buy_flag``: k above d while both are at or below the level. No crossing test."""
    k, d = F.col("k"), F.col("d")
    return frame.withColumn("buy_flag", _flag((k > d) & (k <= level) & (d <= level)))


def kd_overbought(frame: DataFrame, level: float = fv.OVERBOUGHT_LEVEL) -> DataFrame:
    """``sell_flag``: the mirror image of :func:`kd_oversold`."""
    k, d = F.col("k"), F.col("d")
    return frame.withColumn("sell_flag", _flag((k < d) & (k >= level) & (d >= level)))


def kd_crossed(side: str, level: float | None = None) -> Column:
    """k crosses d: upwards at or below 20 (long), downwards at or above 80 (short)."""
    k, d = F.col("k"), F.col("d")
    cross = crossed(k - d, F.col("k_prev") - F.col("d_prev"), side)
    if side == "long":
        level = fv.OVERSOLD_LEVEL if level is None else level
        return cross & (k <= level) & (d <= level)
    level = fv.OVERBOUGHT_LEVEL if level is None else level
    return cross & (k >= level) & (d >= level)


def macd_crossed(side: str, gap: float = fv.MACD_CROSS_GAP) -> Column:
    """MACD crosses its signal line by at least ``gap``: upwards while both are negative
    (long), downwards while both are positive (short)."""
    line, signal = F.col("MACD"), F.col("MACDsignal")
    hist = line - signal
    cross = crossed(hist, F.col("MACD_prev") - F.col("MACDsignal_prev"), side)
    zone = (line < 0) & (signal < 0) if side == "long" else (line > 0) & (signal > 0)
    return cross & zone & (F.abs(hist) >= gap)


def ma_crossed(fast: int, slow: int, side: str) -> Column:
    """The short average crosses the long one."""
    gap = F.col(f"ma{fast}") - F.col(f"ma{slow}")
    return crossed(gap, F.col(f"ma{fast}_prev") - F.col(f"ma{slow}_prev"), side)


def rsi_crossed(side: str, levels: Sequence[float] = fv.RSI_LEVELS) -> Column:
    """RSI rises through the lower level (long) or falls through the upper one (short)."""
    level = levels[0] if side == "long" else levels[1]
    return crossed(F.col("rsi") - level, F.col("rsi_prev") - level, side)


def kd_cross(frame: DataFrame, side: str, level: float | None = None) -> DataFrame:
    """Rows of one side; like the other crosses this needs the ``_prev`` columns."""
    return frame.where(kd_crossed(side, level))


def with_side(frame: DataFrame, long: Column, short: Column) -> DataFrame:
    """Rows of either side with their ``side``, in one pass over the frame."""
    side = F.when(long, "long").when(short, "short")
    return frame.withColumn("side", side).where("side IS NOT NULL")


def forward_return(
    signals: DataFrame,
    horizons: Sequence[int] = fv.FORWARD_HORIZONS,
    flag: str = "signal",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Percent gain of the close after a signal, ``return_<h>`` for h bars later.

    ``signals`` holds every bar, with a 0/1 ``flag``; only flagged rows remain.
    """
    rows, window = chunked(signals, after=max(horizons), chunk_rows=chunk_rows)
    return own_rows(_with_returns(rows, horizons, window).where(F.col(flag) == 1))


def _with_returns(rows: DataFrame, horizons: Sequence[int], window: WindowSpec) -> DataFrame:
    close = F.col("close_price")
    gains = {h: F.try_divide(F.lead(close, h).over(window) - close, close) * 100 for h in horizons}
    return rows.withColumns({f"return_{h}": gain for h, gain in gains.items()})


def ma_cross_returns(
    prices: DataFrame,
    fast: int,
    slow: int,
    side: str,
    horizons: Sequence[int] = fv.FORWARD_HORIZONS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Crosses of two averages and what followed them: averages and returns share one chunking."""
    rows, window = chunked(
        priced(prices, "close_price"), before=slow + 1, after=max(horizons), chunk_rows=chunk_rows
    )
    rows = with_sma(rows, (fast, slow), window)
    rows = rows.withColumns({f"ma{n}_prev": F.lag(f"ma{n}").over(window) for n in (fast, slow)})
    return own_rows(_with_returns(rows, horizons, window).where(ma_crossed(fast, slow, side)))
