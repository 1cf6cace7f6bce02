"""Indicators advanced by the day against the whole run."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators import indicators as I, refresh as R
from barloom.session import work_folder
from barloom.sources import buckets


@pytest.fixture(scope="module")
def prices(spark):
    rng = random.Random(5)
    rows = []
    for code, n in (("long", 900), ("edge", 241), ("even", 240), ("young", 30), ("new", 12), ("flat", 300)):
        price = 50.0
        for i in range(n):
            price = price if code == "flat" else max(1.0, price * (1 + rng.uniform(-0.05, 0.05)))
            high, low = (price, price) if code == "flat" else (price * 1.01, price * 0.98)
            rows.append((code, date(2024, 12, 31) - timedelta(days=n - 1 - i), price, high, low, i))
    rows.append(("long", date(2023, 1, 1) - timedelta(days=900), None, 1.0, 1.0, 0))
    frame = spark.createDataFrame(rows, "stock_code string, data_date date, close_price double, high_price double, low_price double, volume int")
    return frame.repartition(4).cache()


def differing(a, b):
    both = a.alias("a").join(b.alias("b"), ["stock_code", "data_date"], "full")
    bad = [F.col(f"a.{x}").isNull() != F.col(f"b.{x}").isNull() for x in R.LINES]
    bad += [F.coalesce(F.abs(F.col(f"a.{x}") - F.col(f"b.{x}")) > 1e-7, F.lit(False)) for x in R.LINES]
    return both.where(F.greatest(*(x.cast("int") for x in bad)) == 1).count() + both.where("a.volume IS NULL OR b.volume IS NULL").count()


def test_state_and_days_equal_the_whole_run(spark, prices):
    table = work_folder(spark, "states")
    last = date(2024, 12, 31)
    days = [last - timedelta(days=n) for n in (9, 3, 2, 1, 0)]
    R.start(prices.where(F.col("data_date") < F.lit(days[0])), table)
    lines, start = [], days[0]
    for number, day in enumerate(days, 1):
        new = prices.where(F.col("data_date").between(F.lit(start), F.lit(day)))
        for _ in range(2):  # a repeated day
            found = R.refresh(spark, table, new, number)
        lines.append(found)
        # days that are known already change nothing
        assert R.advance(buckets.read(spark, table), new).count() == 0
        start = day + timedelta(days=1)
    whole = I.indicators(prices).where(F.col("data_date") >= F.lit(days[0]))
    ours = lines[0]
    for more in lines[1:]:
        ours = ours.unionByName(more)
    assert ours.count() == whole.count() > 50 and differing(ours, whole) == 0
    again = {r.stock_code: r.position for r in R.state_of(prices).collect()}
    assert {r.stock_code: r.position for r in buckets.read(spark, table).collect()} == again


def test_only_the_days_stocks_are_read_and_written(spark, prices):
    states = R.state_of(prices)
    new = spark.createDataFrame([("long", date(2025, 1, 1), 50.0, 51.0, 49.0, 1), ("born", date(2025, 1, 1), 5.0, 5.0, 5.0, 1)], prices.schema)
    rows = R.advance(states, new).collect()
    assert {(r.stock_code, r.state.position) for r in rows} == {("long", 901), ("born", 1)}
    assert all(len(r.state.tail) <= R.TAIL for r in rows)
    assert R.advance(states, new.limit(0)).count() == 0
