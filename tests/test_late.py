"""Bars of a stream with late quotes against the bars of all quotes at once."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from barloom.session import work_folder
from barloom.sources import versions
from barloom.streaming import late as L, quotes as Q

START = datetime(2024, 1, 2, 22, tzinfo=timezone.utc)
KIND = "stock_code string, ts timestamp, price double, volume bigint"


def made(seed, count=300):
    rng = random.Random(seed)
    rows = [(rng.choice("aab"), START + timedelta(seconds=rng.randrange(4 * 3600)), rng.choice([None, float(i)]), i) for i in range(count)]
    return rows + [("c", None, 1.0, 1)]


def bars(frame, reached):
    whole = Q.bars_of(frame.where("ts IS NOT NULL"))
    closed = F.col("window_start") + F.expr("INTERVAL 5 MINUTES") <= F.lit(reached - timedelta(minutes=10)).cast("timestamp_ntz")
    return sorted(map(tuple, whole.where(closed).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_streamed_and_corrected_bars_are_those_of_all_quotes(spark, seed):
    folder, rows = work_folder(spark, "late"), made(seed)
    rng = random.Random(seed)
    rows.sort(key=lambda r: (r[1] or START) + timedelta(minutes=rng.choice([0, 0, 0, 45])))  # some arrive late
    parts = [rows[i : i + 75] for i in range(0, len(rows), 75)]
    seen = []
    for number, part in enumerate(parts):
        for _ in range(2 if number == 2 else 1):  # a repeated batch
            L.take_batch(spark.createDataFrame(part, KIND), folder, number)
        seen += part
        if number == 1:
            L.correct(spark, folder)
    whole = spark.createDataFrame(seen, KIND)
    reached = max(r[1] for r in seen if r[1])
    late = L.late_quotes(spark, folder).count()
    assert late > 10
    before = sorted(map(tuple, L.read_bars(spark, folder).collect()), key=str)
    expected = bars(whole, reached)
    assert before != expected  # late quotes are missing
    rebuilt = L.correct(spark, folder)
    assert 0 < rebuilt <= late
    assert sorted(map(tuple, L.read_bars(spark, folder).collect()), key=str) == expected
    assert L.correct(spark, folder) == 0


def test_batches_without_quotes(spark):
    folder = work_folder(spark, "late")
    empty = spark.createDataFrame([], KIND)
    L.take_batch(empty, folder, 0)
    L.take_batch(spark.createDataFrame([("a", START, 1.0, 1), ("a", START + timedelta(hours=1), 2.0, 2)], KIND), folder, 1)
    L.take_batch(empty, folder, 2)
    assert [r.close_price for r in L.read_bars(spark, folder).collect()] == [1.0]
    assert versions.finished(spark, f"{folder}/seen") == [0, 1, 2] and L.late_quotes(spark, folder).count() == 0
