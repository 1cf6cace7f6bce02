"""Chunked and bucketed series work against plain windows and plain Python."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window, functions as F

from barloom.operators import indicators as I, joins, signals
from barloom.operators.series import POSITION, chunked, own_rows, with_position
from barloom.operators.sets import chunk_codes


@pytest.fixture(scope="module")
def prices(spark):
    """One stock with most of the rows, gaps in its calendar, and small ones."""
    rng = random.Random(7)
    rows = []
    for code, n in (("hot", 3000), ("mid", 400), ("tiny", 5)):
        day, price = date(1990, 1, 1), 100.0
        for _ in range(n):
            day += timedelta(days=rng.choice((1, 1, 1, 3, 90 if code == "mid" else 1)))
            price = max(1.0, price * (1 + rng.uniform(-0.05, 0.05)))
            high, low = price * (1 + rng.random() * 0.02), price * (1 - rng.random() * 0.02)
            rows.append((code, day, price, high, low))
    frame = spark.createDataFrame(
        rows, "stock_code string, data_date date, close_price double, high_price double, low_price double"
    )
    return frame.repartition(5).cache()


def test_positions(prices):
    window = Window.partitionBy("stock_code").orderBy("data_date")
    both = with_position(prices).withColumn("plain", F.row_number().over(window))
    assert both.where(F.col("plain") != F.col(POSITION)).count() == 0
    assert both.count() == 3405


@pytest.mark.parametrize("chunk_rows", [1, 7, 100, 5000])
def test_frames_see_their_neighbours(prices, chunk_rows):
    rows, window = chunked(prices, before=12, after=3, chunk_rows=chunk_rows)
    ours = own_rows(
        rows.withColumns(
            {
                "back": F.sum("close_price").over(window.rowsBetween(-12, 0)),
                "ahead": F.lead("close_price", 3).over(window),
            }
        )
    )
    plain = Window.partitionBy("stock_code").orderBy("data_date")
    expected = prices.withColumns(
        {
            "back0": F.sum("close_price").over(plain.rowsBetween(-12, 0)),
            "ahead0": F.lead("close_price", 3).over(plain),
        }
    )
    joined = ours.join(expected, ["stock_code", "data_date"])
    assert joined.count() == 3405
    assert joined.where("abs(back - back0) > 1e-9 OR NOT (ahead <=> ahead0)").count() == 0


def test_no_chunk_holds_a_whole_hot_stock(prices):
    rows, _ = chunked(prices, before=50, chunk_rows=200)
    largest = rows.groupBy("stock_code", "_chunk").count().agg(F.max("count")).first()[0]
    assert largest <= 250


@pytest.mark.parametrize("run", [I.indicators, I.rsi, lambda p, **k: I.ema(p, 26, **k), I.bbands, I.sma])
def test_chunks_do_not_change_indicators(prices, run):
    whole, cut = run(prices), run(prices, chunk_rows=300)
    lines = [name for name in whole.columns if name not in prices.columns]
    joined = whole.alias("a").join(cut.alias("b"), ["stock_code", "data_date"])
    assert joined.count() == 3405
    for name in lines:
        a, b = F.col(f"a.{name}"), F.col(f"b.{name}")
        assert joined.where((a.isNull() != b.isNull()) | (F.abs(a - b) > 1e-9)).count() == 0, name


def _ema(values, n):
    out = [None] * len(values)
    if len(values) >= n:
        out[n - 1] = sum(values[:n]) / n
        for i in range(n, len(values)):
            out[i] = out[i - 1] + (values[i] - out[i - 1]) * 2 / (n + 1)
    return out


def test_ema_and_rsi_by_hand(prices):
    rows = prices.where("stock_code = 'mid'").orderBy("data_date").collect()
    closes = [r.close_price for r in rows]
    expected = _ema(closes, 26)
    found = I.ema(prices, 26).where("stock_code = 'mid'").orderBy("data_date").collect()
    for row, want in zip(found, expected):
        assert (row.ema26 is None) == (want is None)
        assert want is None or abs(row.ema26 - want) < 1e-9

    moves = [b - a for a, b in zip(closes, closes[1:])]
    gain = sum(max(m, 0) for m in moves[:14]) / 14
    loss = sum(max(-m, 0) for m in moves[:14]) / 14
    for m in moves[14:]:
        gain, loss = (gain * 13 + max(m, 0)) / 14, (loss * 13 + max(-m, 0)) / 14
    last = I.rsi(prices).where("stock_code = 'mid'").orderBy(F.desc("data_date")).first()
    assert abs(last.rsi - 100 * gain / (gain + loss)) < 1e-9


def test_ema_as_array_fold(spark, prices):
    """The recursion once more, as an SQL fold over the collected series."""
    fold = (
        prices.where("stock_code = 'mid'")
        .groupBy("stock_code")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("data_date", "close_price"))), lambda s: s.close_price).alias("xs"))
        .select(
            F.expr(
                "aggregate(slice(xs, 27, size(xs)), aggregate(slice(xs, 1, 26), 0D, (a, x) -> a + x) / 26,"
                " (e, x) -> e + (x - e) * 2 / 27)"
            )
        )
        .first()[0]
    )
    last = I.ema(prices, 26).where("stock_code = 'mid'").orderBy(F.desc("data_date")).first().ema26
    assert abs(fold - last) < 1e-9


def test_previous_columns(prices):
    lines = I.stoch(prices, previous=True, chunk_rows=250)
    window = Window.partitionBy("stock_code").orderBy("data_date")
    checked = lines.withColumn("plain", F.lag("k").over(window))
    assert checked.where("NOT (plain <=> k_prev) AND abs(plain - k_prev) > 1e-9").count() == 0
    assert checked.where("(plain IS NULL) != (k_prev IS NULL)").count() == 0


def test_crosses_need_a_change_of_side(spark):
    frame = spark.createDataFrame(
        [(15.0, 10.0, 9.0, 12.0), (15.0, 10.0, 13.0, 12.0), (85.0, 90.0, 95.0, 91.0)],
        "k double, d double, k_prev double, d_prev double",
    )
    assert signals.kd_cross(frame, "long").count() == 1
    assert signals.kd_cross(frame, "short").count() == 1
    with pytest.raises(ValueError):
        signals.kd_cross(frame, "up")


def test_forward_return_over_chunks(prices):
    flagged = prices.withColumn("signal", F.when(F.month("data_date") == 3, 1).otherwise(0))
    a = signals.forward_return(flagged).select("stock_code", "data_date", "return_20")
    b = signals.forward_return(flagged, chunk_rows=50).select("stock_code", "data_date", "return_20")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() > 0


def test_asof_against_plain_python(spark, prices):
    rng = random.Random(3)
    wanted = [(rng.choice(("hot", "mid", "none")), date(1989, 12, 1) + timedelta(days=rng.randrange(6000))) for _ in range(500)]
    # a third of all rows ask for one and the same day
    wanted += [("hot", date(1995, 5, 5))] * 250
    left = spark.createDataFrame([(*w, i) for i, w in enumerate(wanted)], "stock_code string, data_date date, i int")
    found = {r.i: (r.asof_data_date, r.asof_close_price) for r in joins.asof_join(left, prices).collect()}
    series = {}
    for r in prices.collect():
        series.setdefault(r.stock_code, []).append((r.data_date, r.close_price))
    assert len(found) == len(wanted)
    for i, (code, day) in enumerate(wanted):
        before = [p for p in series.get(code, []) if p[0] <= day]
        assert found[i] == (max(before) if before else (None, None))


def test_code_batches_are_full(spark):
    codes = spark.range(1234).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("stock_code"))
    rows = chunk_codes(codes.repartition(6)).orderBy("batch_no").collect()
    assert [r.code_count for r in rows] == [50] * 24 + [34]
    assert "|".join(r.codes for r in rows) == "|".join(f"{i:04d}" for i in range(1234))


def test_codes_alike_in_long_prefixes(spark):
    names = [f"tse_{'x' * (i % 3)}{i:05d}" for i in range(700)] + ["tse_"] * 30 + ["", "t"]
    codes = spark.createDataFrame([(n,) for n in names], "stock_code string").repartition(5)
    for most in (7, 100, 10_000):
        rows = chunk_codes(codes, most=most).orderBy("batch_no").collect()
        assert "|".join(r.codes for r in rows) == "|".join(sorted(names))
