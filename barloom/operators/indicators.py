"""Technical indicators per stock over daily bars.

Fixed-length frames (averages, bands, highest and lowest) are window
expressions. The recursive averages (EMA, and what is built on it) run in one
Arrow grouped map per chunk of a series. A chunk after the first starts its
recursion early enough that the unknown starting value has faded below double
precision when its own rows begin, so chunks need not wait for each other.

Input bars are unique per stock and day. A bar without a price that an indicator reads is
no bar for it: such rows are left out before anything is counted or averaged.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, WindowSpec, functions as F, types as T

from barloom import fixed_values as fv
from barloom.operators.series import CHUNK, CHUNK_ROWS, OWN, POSITION, chunked, own_rows

_FADED = 75.0  # e^-75 is far below the 2^-53 of a double
_NEAR_ZERO = 1e-14  # sums of average moves below this count as no move


def priced(prices: DataFrame, *names: str) -> DataFrame:
    """Rows that have all of the named prices."""
    for name in names:
        prices = prices.where(F.col(name).isNotNull())
    return prices


# ---------------------------------------------------------------- frames
def _trailing(window: WindowSpec, n: int) -> WindowSpec:
    return window.rowsBetween(-(n - 1), 0)


def _full(n: int, value: Column) -> Column:
    """NULL until a series has ``n`` rows."""
    return F.when(F.col(POSITION) >= n, value)


def _trailing_sums(
    df: DataFrame, value: str, periods: Sequence[int], window: WindowSpec
) -> tuple[DataFrame, dict[int, str]]:
    """Sums over the last n rows. A period that is a multiple of a shorter one adds
    up a few lagged shorter sums instead of reading all n rows again."""
    names: dict[int, str] = {}
    for n in sorted(set(periods)):
        name = f"_sum_{value}_{n}"
        base = max((p for p in names if n % p == 0), default=None)
        if base is None:
            total = F.sum(value).over(_trailing(window, n))
        else:
            total = F.col(names[base])
            for step in range(1, n // base):
                total = total + F.lag(names[base], base * step).over(window)
        df = df.withColumn(name, total)
        names[n] = name
    return df, names


def with_sma(df: DataFrame, periods: Sequence[int], window: WindowSpec) -> DataFrame:
    df, sums = _trailing_sums(df, "close_price", periods, window)
    averages = {f"ma{n}": _full(n, F.col(sums[n]) / n) for n in periods}
    return df.withColumns(averages).drop(*sums.values())


def _with_bbands(df: DataFrame, n: int, width: float, window: WindowSpec) -> DataFrame:
    frame = _trailing(window, n)
    middle = _full(n, F.avg("close_price").over(frame))
    spread = _full(n, F.stddev_pop("close_price").over(frame)) * width
    return (
        df.withColumns({"middle": middle, "_spread": spread})
        .withColumns(
            {"upper": F.col("middle") + F.col("_spread"), "lower": F.col("middle") - F.col("_spread")}
        )
        .drop("_spread")
    )


def _with_fast_k(df: DataFrame, n: int, window: WindowSpec) -> DataFrame:
    frame = _trailing(window, n)
    df = df.withColumns(
        {"_low": F.min("low_price").over(frame), "_high": F.max("high_price").over(frame)}
    )
    span = F.col("_high") - F.col("_low")
    fast_k = F.when(span == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col("close_price") - F.col("_low"), span) * 100
    )
    return df.withColumn("_fast_k", _full(n, fast_k)).drop("_low", "_high")


# ------------------------------------------------------------- recursion
def fade_rows(*alphas: float) -> int:
    """Rows after which the starting values of a chain of averages have faded."""
    return sum(math.ceil(_FADED / -math.log1p(-alpha)) if alpha < 1 else 1 for alpha in alphas)


def _ema_alpha(n: int) -> float:
    return 2.0 / (n + 1)


def _smooth(values: np.ndarray, n: int, alpha: float, from_start: bool) -> np.ndarray:
    """Exponential average; at the start of a series seeded by the mean of n values."""
    lead = n - 1 if from_start else 0
    if len(values) <= lead:
        return np.full(len(values), np.nan)
    tail = values[lead:].astype(float)
    if lead:
        tail[0] = values[:n].mean()
    smooth = pd.Series(tail).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    return np.concatenate([np.full(lead, np.nan), smooth])


def _after(skip: int, values: np.ndarray, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Apply ``part`` to the values behind the first ``skip``, which become NaN."""
    skip = min(skip, len(values))
    return np.concatenate([np.full(skip, np.nan), part(values[skip:])])


def _stoch_lines(fast_k: np.ndarray, periods: Sequence[int], from_start: bool):
    fast, slow, signal = periods
    lead_k, lead_d = (fast - 1, fast + slow - 2) if from_start else (0, 0)
    k = _after(lead_k, fast_k, lambda x: _smooth(x, slow, _ema_alpha(slow), from_start))
    d = _after(lead_d, k, lambda x: _smooth(x, signal, _ema_alpha(signal), from_start))
    return {"k": np.where(np.isnan(d), np.nan, k), "d": d}


def _macd_lines(close: np.ndarray, periods: Sequence[int], from_start: bool):
    fast, slow, signal = periods
    slow_line = _smooth(close, slow, _ema_alpha(slow), from_start)
    # both lines start on the same row, so the fast one skips the rows it does not need
    skip, lead = (slow - fast, slow - 1) if from_start else (0, 0)
    fast_line = _after(skip, close, lambda x: _smooth(x, fast, _ema_alpha(fast), from_start))
    line = fast_line - slow_line
    trigger = _after(lead, line, lambda x: _smooth(x, signal, _ema_alpha(signal), from_start))
    return {
        "MACD": np.where(np.isnan(trigger), np.nan, line),
        "MACDsignal": trigger,
        "MACDhist": line - trigger,
    }


def _rsi_line(close: np.ndarray, n: int, from_start: bool):
    moves = np.diff(close)
    gain = _smooth(np.maximum(moves, 0.0), n, 1.0 / n, from_start)
    loss = _smooth(np.maximum(-moves, 0.0), n, 1.0 / n, from_start)
    total = gain + loss
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(total < _NEAR_ZERO, 0.0, 100.0 * gain / total)
    line = np.where(np.isnan(total), np.nan, ratio)
    return {"rsi": np.concatenate([[np.nan], line])[: len(close)]}


Lines = Callable[[pa.Table, bool], dict[str, np.ndarray]]


def _recursive(
    rows: DataFrame,
    keys: Sequence[str],
    names: Sequence[str],
    lines: Lines,
    previous: bool,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Run ``lines`` once per chunk and keep the chunk's own rows."""
    helpers = (POSITION, CHUNK, OWN, *drop)
    kept = [field for field in rows.schema if field.name not in helpers]
    wanted = [*names, *(f"{name}_prev" for name in names if previous)]
    schema = T.StructType([*kept, *[T.StructField(name, T.DoubleType(), True) for name in wanted]])

    def per_chunk(table: pa.Table) -> pa.Table:
        table = table.sort_by(POSITION)
        from_start = table.column(POSITION)[0].as_py() == 1
        columns = lines(table, from_start)
        own = table.column(OWN).combine_chunks()
        result = table.drop_columns([name for name in helpers if name in table.column_names])
        for name in names:
            result = result.append_column(name, pa.array(columns[name], from_pandas=True))
        if previous:
            for name in names:
                shifted = np.concatenate([[np.nan], columns[name][:-1]])
                result = result.append_column(f"{name}_prev", pa.array(shifted, from_pandas=True))
        return result.filter(own)

    return rows.groupBy(*keys, CHUNK).applyInArrow(per_chunk, schema)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(float)


# ------------------------------------------------------------ operators
KEYS, ORDER = ("stock_code",), ("data_date",)


def sma(
    prices: DataFrame,
    periods: Sequence[int] = fv.SMA_PERIODS,
    previous: bool = False,
    keep_position: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Simple moving averages ``ma<n>``; with ``previous`` also the row before's."""
    closes = priced(prices, "close_price")
    rows, window = chunked(closes, KEYS, ORDER, before=max(periods), chunk_rows=chunk_rows)
    rows = with_sma(rows, periods, window)
    if previous:
        rows = rows.withColumns({f"ma{n}_prev": F.lag(f"ma{n}").over(window) for n in periods})
    return own_rows(rows, keep_position)


def bbands(
    prices: DataFrame,
    n: int = fv.BBANDS_PERIOD,
    width: float = fv.BBANDS_WIDTH,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Bollinger bands with the population deviation: ``upper middle lower``."""
    closes = priced(prices, "close_price")
    rows, window = chunked(closes, KEYS, ORDER, before=n, chunk_rows=chunk_rows)
    return own_rows(_with_bbands(rows, n, width, window))


def ema(
    prices: DataFrame,
    n: int,
    value: str = "close_price",
    name: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Exponential average seeded by the mean of the first n values."""
    name = name or f"ema{n}"
    alpha = _ema_alpha(n)
    rows, _ = chunked(priced(prices, value), KEYS, ORDER, before=fade_rows(alpha), chunk_rows=chunk_rows)

    def lines(table: pa.Table, from_start: bool) -> dict[str, np.ndarray]:
        return {name: _smooth(_numbers(table, value), n, alpha, from_start)}

    return _recursive(rows, KEYS, [name], lines, previous=False)


def stoch(
    prices: DataFrame,
    periods: Sequence[int] = fv.STOCH_PERIODS,
    previous: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Slow stochastic ``k`` and ``d``; a flat price range counts as 0."""
    fast, slow, signal = periods
    before = fast + fade_rows(_ema_alpha(slow), _ema_alpha(signal))
    bars = priced(prices, "close_price", "high_price", "low_price")
    rows, window = chunked(bars, KEYS, ORDER, before=before, chunk_rows=chunk_rows)
    rows = _with_fast_k(rows, fast, window)

    def lines(table: pa.Table, from_start: bool) -> dict[str, np.ndarray]:
        return _stoch_lines(_numbers(table, "_fast_k"), periods, from_start)

    return _recursive(rows, KEYS, ["k", "d"], lines, previous, drop=["_fast_k"])


def macd(
    prices: DataFrame,
    periods: Sequence[int] = fv.MACD_PERIODS,
    previous: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``MACD MACDsignal MACDhist``."""
    before = fade_rows(_ema_alpha(max(periods[:2])), _ema_alpha(periods[2]))
    rows, _ = chunked(priced(prices, "close_price"), KEYS, ORDER, before=before, chunk_rows=chunk_rows)

    def lines(table: pa.Table, from_start: bool) -> dict[str, np.ndarray]:
        return _macd_lines(_numbers(table, "close_price"), periods, from_start)

    return _recursive(rows, KEYS, ["MACD", "MACDsignal", "MACDhist"], lines, previous)


def rsi(
    prices: DataFrame,
    n: int = fv.RSI_PERIOD,
    previous: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Relative strength with Wilder's smoothing."""
    before = 1 + fade_rows(1.0 / n)
    rows, _ = chunked(priced(prices, "close_price"), KEYS, ORDER, before=before, chunk_rows=chunk_rows)

    def lines(table: pa.Table, from_start: bool) -> dict[str, np.ndarray]:
        return _rsi_line(_numbers(table, "close_price"), n, from_start)

    return _recursive(rows, KEYS, ["rsi"], lines, previous)


def indicators(
    prices: DataFrame, previous: bool = False, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """All averages, stochastic, MACD and bands in one pass over the chunks."""
    fast, slow, signal = fv.STOCH_PERIODS
    before = max(
        max(fv.SMA_PERIODS),
        fast + fade_rows(_ema_alpha(slow), _ema_alpha(signal)),
        fade_rows(_ema_alpha(fv.MACD_PERIODS[1]), _ema_alpha(fv.MACD_PERIODS[2])),
    )
    bars = priced(prices, "close_price", "high_price", "low_price")
    rows, window = chunked(bars, KEYS, ORDER, before=before, chunk_rows=chunk_rows)
    rows = with_sma(rows, fv.SMA_PERIODS, window)
    rows = _with_bbands(rows, fv.BBANDS_PERIOD, fv.BBANDS_WIDTH, window)
    rows = _with_fast_k(rows, fast, window)

    def lines(table: pa.Table, from_start: bool) -> dict[str, np.ndarray]:
        return {
            **_stoch_lines(_numbers(table, "_fast_k"), fv.STOCH_PERIODS, from_start),
            **_macd_lines(_numbers(table, "close_price"), fv.MACD_PERIODS, from_start),
        }

    names = ["k", "d", "MACD", "MACDsignal", "MACDhist"]
    return _recursive(rows, KEYS, names, lines, previous, drop=["_fast_k"])
