"""Versions by date and as-of joins on instants against plain Python."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators import joins, versions as V

DAY = date(1999, 1, 1)


@pytest.mark.parametrize("newest,span", [(True, 366), (False, 366), (True, 10)])
def test_overlapping_and_open_intervals(spark, newest, span):
    rng = random.Random(span + newest)
    intervals = []
    for i in range(300):
        start = DAY + timedelta(days=rng.randrange(1500)) if rng.random() < 0.9 else None
        end = (start or DAY) + timedelta(days=rng.randrange(-40, 900)) if rng.random() < 0.8 else None
        intervals.append((rng.choice(["hot", "hot", "a", "b"]), start, end, i))
    asked = [(rng.choice(["hot", "a", "none", None]), DAY + timedelta(days=rng.randrange(-100, 2600)), n) for n in range(400)]
    asked += [("hot", DAY + timedelta(days=700), 1000 + n) for n in range(200)] + [("a", None, 2000)]
    frame = spark.createDataFrame(asked, "stock_code string, data_date date, n int")
    known = spark.createDataFrame(intervals, "stock_code string, valid_from date, valid_to date, i int")
    found = {}
    for r in V.at_dates(frame, known, newest=newest, span_days=span).collect():
        found.setdefault(r.n, set()).add(r.i)
    assert len(found) == len(asked)
    for code, day, n in asked:
        held = [(s or date.min, i) for c, s, e, i in intervals if c == code and day and (s is None or s <= day) and (e is None or day < e) and not (s and e and s >= e)]
        best = max((s for s, _ in held), default=None)
        assert found[n] == ({i for s, i in held if s == best or not newest} or {None})


def test_validity_ends_with_the_next_version(spark):
    rows = [("a", date(2020, 1, 1), "x"), ("a", date(2020, 1, 1), "y"), ("a", date(2021, 5, 1), "z"), ("b", date(2020, 3, 1), "w"), ("b", None, "v")]
    frame = V.with_validity(spark.createDataFrame(rows, "stock_code string, update_date date, name string"))
    found = {r.name: (r.valid_from, r.valid_to) for r in frame.collect()}
    first = (date(2020, 1, 1), date(2021, 5, 1))
    assert found == {"x": first, "y": first, "z": (date(2021, 5, 1), None), "w": (date(2020, 3, 1), None)}


@pytest.mark.parametrize("tolerance,bucket", [(None, "hour"), ("90 seconds", "minute"), ("2 hours", "day")])
def test_asof_on_instants(spark, tolerance, bucket):
    rng = random.Random(len(bucket))
    start = datetime(2024, 1, 2, 9)

    def moment():
        return start + timedelta(milliseconds=rng.randrange(0, 6 * 3600 * 1000, 250))

    quotes = [(rng.choice(["hot", "hot", "hot", "b"]), moment(), float(i)) for i in range(2000)]
    quotes += [("hot", start, float(i)) for i in range(500)] + [(None, start, 1.0), ("hot", None, 1.0)]
    asked = [(rng.choice(["hot", "b", "none"]), moment(), n) for n in range(400)] + [("hot", start, 1000 + n) for n in range(300)]
    asked += [(None, start, 5000), ("hot", None, 5001), ("hot", start - timedelta(seconds=1), 5002)]
    left = spark.createDataFrame(asked, "stock_code string, ts timestamp_ntz, n int")
    right = spark.createDataFrame(quotes, "stock_code string, ts timestamp_ntz, price double").repartition(4)
    found = {r.n: (r.asof_ts, r.asof_price) for r in joins.asof_join_instants(left, right, tolerance=tolerance, bucket=bucket).collect()}
    width = {None: timedelta.max, "90 seconds": timedelta(seconds=90), "2 hours": timedelta(hours=2)}[tolerance]
    assert len(found) == len(asked)
    for code, ts, n in asked:
        before = [(t, p) for c, t, p in quotes if code and ts and t and c == code and t <= ts]
        best = max(before, default=(None, None))
        assert found[n] == (best if best[0] and ts - best[0] <= width else (None, None))


def test_a_hot_stock_is_spread_over_its_buckets(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("stock_code"), (F.timestamp_seconds(F.col("id") * 7)).cast("timestamp_ntz").alias("ts"), F.col("id").cast("double").alias("price"))
    sizes = rows.groupBy("stock_code", F.date_trunc("hour", "ts")).count()
    assert sizes.agg(F.max("count")).first()[0] < 600
    assert joins.asof_join_instants(rows, rows).where("asof_price <> price").count() == 0
