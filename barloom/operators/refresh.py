"""Indicators kept up by the day: a stored state per stock, advanced by new bars.

The state of a stock has its last ``TAIL`` bars, as many as the longest average reads, the number
of its bars, and the last values of its recursive averages. New bars of a day and the states of
their stocks meet by stock; stocks without new bars are not read, and of the stored states only the
hashed buckets of the day's stocks are written again. So the work follows the day and not the history.

While a stock has ``TAIL`` bars or fewer its state holds all of them, and its lines are made from
the first one on; afterwards the recursions go on from their last values. Bars not after a
state's last day are known already and are left out, so a repeated day changes nothing. As for
all indicators, bars without a price are no bars.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from barloom import fixed_values as fv
from barloom.operators.indicators import _after, _ema_alpha, _smooth, ema, indicators, priced
from barloom.operators.series import POSITION, with_position
from barloom.session import work_folder
from barloom.sources import buckets

TAIL = max(fv.SMA_PERIODS)
LINES = (*(f"ma{n}" for n in fv.SMA_PERIODS), "k", "d", "MACD", "MACDsignal", "MACDhist", "upper", "middle", "lower")
_RECURSIVE = ("k", "d", "fast", "slow", "signal")
_BAR = T.StructType([T.StructField("data_date", T.DateType()), *(T.StructField(x, T.DoubleType()) for x in ("close_price", "high_price", "low_price"))])
STATE = T.StructType(
    [T.StructField("last_date", T.DateType()), T.StructField("position", T.LongType()), T.StructField("tail", T.ArrayType(_BAR))]
    + [T.StructField(x, T.DoubleType()) for x in _RECURSIVE]
)


def _bars(prices: DataFrame) -> DataFrame:
    return priced(prices, "close_price", "high_price", "low_price")


def state_of(prices: DataFrame) -> DataFrame:
    """The states of all stocks after a whole history, made by the chunked operators: one row per stock."""
    bars = _bars(prices)
    numbered = with_position(bars.select("stock_code", "data_date", "close_price", "high_price", "low_price"))
    sizes = numbered.groupBy("stock_code").agg(F.max(POSITION).alias("position"), F.max("data_date").alias("last_date"))
    last = numbered.join(sizes, "stock_code").where(F.col(POSITION) > F.col("position") - TAIL)
    bar = F.struct(*(F.col(x.name).cast(x.dataType).alias(x.name) for x in _BAR))
    tails = last.groupBy("stock_code", "position", "last_date").agg(F.array_sort(F.collect_list(bar)).alias("tail"))
    lines = indicators(bars).select("stock_code", F.col("data_date").alias("last_date"), "k", "d", "MACD", "MACDsignal")
    slow = ema(bars, fv.MACD_PERIODS[1], name="slow").select("stock_code", F.col("data_date").alias("last_date"), "slow")
    known = tails.join(lines, ["stock_code", "last_date"]).join(slow, ["stock_code", "last_date"])
    # the starts of the two lines have faded from their difference when it is first read
    values = {"k": F.col("k"), "d": F.col("d"), "fast": F.col("slow") + F.col("MACD"), "slow": F.col("slow"), "signal": F.col("MACDsignal")}
    return known.select("stock_code", "last_date", "position", "tail", *(F.when(F.col("position") > TAIL, v).alias(n) for n, v in values.items()))


def _sliding(values: np.ndarray, n: int) -> np.ndarray:
    """One row per full frame of n values."""
    return np.lib.stride_tricks.sliding_window_view(values, n) if len(values) >= n else np.zeros((0, n))


def _at_ends(values: np.ndarray, size: int) -> np.ndarray:
    """Values of full frames at the last row of each; NaN before the first full frame."""
    return np.concatenate([np.full(size - len(values), np.nan), values])


def _continued(last: float, values: np.ndarray, alpha: float) -> np.ndarray:
    found = np.empty(len(values))
    for i, value in enumerate(values):
        last += (value - last) * alpha
        found[i] = last
    return found


def _recursions(close: np.ndarray, fast_k: np.ndarray, new: int, known: dict[str, float] | None) -> dict[str, np.ndarray]:
    """The recursive averages at the last ``new`` rows: from the first row on, or on from their known values."""
    fast, slow, signal = fv.MACD_PERIODS
    first, smooth, second = fv.STOCH_PERIODS
    if known is None:
        lines = {"slow": _smooth(close, slow, _ema_alpha(slow), True)}
        lines["fast"] = _after(slow - fast, close, lambda x: _smooth(x, fast, _ema_alpha(fast), True))
        lines["signal"] = _after(slow - 1, lines["fast"] - lines["slow"], lambda x: _smooth(x, signal, _ema_alpha(signal), True))
        lines["k"] = _after(first - 1, fast_k, lambda x: _smooth(x, smooth, _ema_alpha(smooth), True))
        lines["d"] = _after(first + smooth - 2, lines["k"], lambda x: _smooth(x, second, _ema_alpha(second), True))
        return {name: line[len(line) - new :] for name, line in lines.items()}
    own, rates = close[len(close) - new :], fast_k[len(fast_k) - new :]
    lines = {"slow": _continued(known["slow"], own, _ema_alpha(slow)), "fast": _continued(known["fast"], own, _ema_alpha(fast))}
    lines["signal"] = _continued(known["signal"], lines["fast"] - lines["slow"], _ema_alpha(signal))
    lines["k"] = _continued(known["k"], rates, _ema_alpha(smooth))
    lines["d"] = _continued(known["d"], lines["k"], _ema_alpha(second))
    return lines


def _advanced(new: pa.Table, old: pa.Table) -> pa.Table:
    """Lines of a stock's new bars, and its state beside the last of them."""
    new = new.sort_by("data_date")
    state = old.to_pylist()[0] if old.num_rows else {"last_date": None, "position": 0, "tail": [], **dict.fromkeys(_RECURSIVE)}
    if state["last_date"] is not None:
        new = new.filter(pa.array([day > state["last_date"] for day in new["data_date"].to_pylist()], pa.bool_()))
    count, size = new.num_rows, state["position"] + new.num_rows
    own = {x: new[x].to_numpy(zero_copy_only=False).astype(float) for x in ("close_price", "high_price", "low_price")}
    whole = {x: np.concatenate([np.array([bar[x] for bar in state["tail"]], float), values]) for x, values in own.items()}
    close = whole["close_price"]

    lines = {f"ma{n}": _at_ends(_sliding(close, n).mean(1), len(close)) for n in fv.SMA_PERIODS}
    frames = _sliding(close, fv.BBANDS_PERIOD)
    middle, spread = frames.mean(1), frames.std(1) * fv.BBANDS_WIDTH
    lines |= {name: _at_ends(v, len(close)) for name, v in (("upper", middle + spread), ("middle", middle), ("lower", middle - spread))}
    n = fv.STOCH_PERIODS[0]
    low, high = _at_ends(_sliding(whole["low_price"], n).min(1, initial=np.inf), len(close)), _at_ends(_sliding(whole["high_price"], n).max(1, initial=-np.inf), len(close))
    span = high - low
    with np.errstate(divide="ignore", invalid="ignore"):
        fast_k = np.where(span == 0, 0.0, (close - low) / span * 100)
    values = _recursions(close, fast_k, count, state if state["position"] > TAIL else None)
    macd = values["fast"] - values["slow"]
    lines = {name: line[len(line) - count :] for name, line in lines.items()} | {
        "k": np.where(np.isnan(values["d"]), np.nan, values["k"]),
        "d": values["d"],
        "MACD": np.where(np.isnan(values["signal"]), np.nan, macd),
        "MACDsignal": values["signal"],
        "MACDhist": macd - values["signal"],
    }
    for name in LINES:
        new = new.append_column(name, pa.array(lines[name], pa.float64(), from_pandas=True))
    if not count:
        return new.append_column("state", pa.nulls(0, _STATE_ARROW))
    bars = [*state["tail"], *new.select(["data_date", "close_price", "high_price", "low_price"]).to_pylist()][-TAIL:]
    after = {"last_date": bars[-1]["data_date"], "position": size, "tail": bars}
    after |= {name: float(values[name][-1]) if size > TAIL else None for name in _RECURSIVE}
    return new.append_column("state", pa.array([None] * (count - 1) + [after], _STATE_ARROW))


_STATE_ARROW = pa.struct(
    [("last_date", pa.date32()), ("position", pa.int64())]
    + [("tail", pa.list_(pa.struct([("data_date", pa.date32()), *((x, pa.float64()) for x in ("close_price", "high_price", "low_price"))])))]
    + [(x, pa.float64()) for x in _RECURSIVE]
)


def advance(states: DataFrame, bars: DataFrame) -> DataFrame:
    """The new bars with all lines, and beside the last bar of each stock its new state."""
    new = _bars(bars)
    own = states.join(new.select("stock_code").distinct(), "stock_code", "left_semi")
    schema = T.StructType([*new.schema, *(T.StructField(x, T.DoubleType()) for x in LINES), T.StructField("state", STATE)])
    return new.groupBy("stock_code").cogroup(own.groupBy("stock_code")).applyInArrow(_advanced, schema)


def start(prices: DataFrame, table: str, number: int = 0) -> None:
    """Store the states after a whole history as write ``number`` of a table."""
    _store(state_of(prices), table, number)


def refresh(spark: SparkSession, table: str, bars: DataFrame, number: int) -> DataFrame:
    """Lines of a day's bars; the stored states advance by them, as write ``number``, which may be repeated."""
    before = buckets.read(spark, table, number - 1)
    found = work_folder(spark, "refreshed")
    advance(before, bars).write.parquet(found)
    rows = spark.read.parquet(found)
    _store(rows.where("state IS NOT NULL").select("stock_code", "state.*"), table, number)
    return rows.drop("state")


def _store(states: DataFrame, table: str, number: int) -> None:
    def newest(both: DataFrame) -> DataFrame:
        names = [x for x in both.columns if x != "bucket"]
        return both.groupBy("stock_code").agg(F.max_by(F.struct(*names), "position").alias("s")).select("s.*")

    buckets.merge(states, table, number, "stock_code", newest)
