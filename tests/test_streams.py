"""Streams in several batches against the batch result."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from barloom.session import work_folder
from barloom import schemas
from barloom.operators.project import conform
from barloom.sources import buckets, readers, sinks, versions
from barloom.streaming import quotes as Q

RAW = "c string, n string, z string, tv string, v string, o string, h string, l string, y string, b string, ts timestamp_ntz"


def _land(spark, folder, rows):
    full = [(c, "n", z, "-", v, "-", "-", "-", "10", "9.5_", ts) for c, z, v, ts in rows]
    spark.createDataFrame(full, RAW).coalesce(1).write.mode("append").parquet(folder)


def _stream(spark, folder):
    schema = spark.createDataFrame([], RAW).schema
    return Q.read_stream(spark, folder, schema, maxFilesPerTrigger=1)


NOON = datetime(2024, 1, 2, 12, 0)


def test_snapshot_over_several_batches_and_restarts(spark):
    landed, table, state = (work_folder(spark, n) for n in ("in", "table", "state"))
    _land(spark, landed, [("a", "10", "1", NOON), ("b", "20", "1", NOON)])
    Q.stream_snapshot(_stream(spark, landed), table, state, trigger=Q.AVAILABLE).awaitTermination()
    assert {r.stock_code: r.newest_deal_price for r in Q.read_snapshot(spark, table).collect()} == {"a": 10.0, "b": 20.0}

    _land(spark, landed, [("a", "-", "2", NOON + timedelta(minutes=5))])
    _land(spark, landed, [("a", "99", "0", NOON - timedelta(minutes=5)), ("c", "7", "-", NOON)])
    Q.stream_snapshot(_stream(spark, landed), table, state, trigger=Q.AVAILABLE).awaitTermination()
    rows = {r.stock_code: r for r in Q.read_snapshot(spark, table).collect()}
    # the newest quote wins, also over one that arrives later; b stays
    assert {k: r.newest_deal_price for k, r in rows.items()} == {"a": 9.5, "b": 20.0, "c": 7.0}
    assert rows["c"].accumulation_volume == 0


def test_versions_stay_few_and_the_close_is_a_bar(spark):
    landed, table, state, prices = (work_folder(spark, n) for n in ("in", "table", "state", "prices"))
    for hour in range(7, 16):
        _land(spark, landed, [("a", str(hour), str(hour), NOON.replace(hour=hour))])
    Q.stream_snapshot(_stream(spark, landed), table, state, trigger=Q.AVAILABLE, session_only=True).awaitTermination()
    assert len(versions.finished(spark, table)) == versions.KEPT
    for _ in range(2):
        Q.close_day(spark, table, prices, NOON.date())
    (bar,) = readers.read_prices(spark, prices, NOON.date(), NOON.date()).collect()
    assert (bar.stock_code, bar.data_date, bar.close_price, bar.volume) == ("a", NOON.date(), 13.0, 13)


def test_a_table_may_be_made_from_itself(spark):
    table = work_folder(spark, "replaced")
    sinks.replace(spark.range(5), table)
    for _ in range(5):
        sinks.replace(versions.read(spark, table).unionAll(spark.range(1)), table)
    assert versions.read(spark, table).count() == 10
    assert len(versions.finished(spark, table)) == versions.KEPT


def test_a_range_opens_its_years_only(spark):
    path = work_folder(spark, "prices")
    days = spark.range(900).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("data_date"))
    sinks.append(conform(days, schemas.STOCK_PRICE), path)
    found = readers.read_prices(spark, path, "2021-03-01", "2021-04-30")
    assert found.count() == 61
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "data_year" in filters and ">= 2021" in filters and "<= 2021" in filters


def test_end_of_day_bars_wait_for_the_watermark(spark):
    landed, out, state = (work_folder(spark, n) for n in ("in", "out", "state"))
    day = [("a", str(p), str(v), NOON + timedelta(minutes=i)) for i, (p, v) in enumerate(((10, 1), (12, 5), (9, 8), (11, 9)))]
    _land(spark, landed, day)
    bars = Q.stream_eod(Q.typed_quotes(_stream(spark, landed)))
    Q.run_to_table(bars, out, state).awaitTermination()
    assert spark.read.schema(bars.schema).parquet(out).count() == 0
    _land(spark, landed, [("z", "1", "1", NOON + timedelta(days=1))])
    Q.run_to_table(Q.stream_eod(Q.typed_quotes(_stream(spark, landed))), out, state).awaitTermination()
    rows = spark.read.schema(bars.schema).parquet(out).collect()
    assert [(r.stock_code, r.data_date.day, r.open_price, r.high_price, r.low_price, r.close_price, r.volume) for r in rows] == [
        ("a", 2, 10.0, 12.0, 9.0, 11.0, 9)
    ]


def test_repeated_polls_in_different_batches(spark):
    landed, out, state = (work_folder(spark, n) for n in ("in", "out", "state"))
    for _ in range(3):
        _land(spark, landed, [("a", "10", "1", NOON), ("a", "11", "2", NOON + timedelta(minutes=1))])
    once = Q.stream_dedup(Q.typed_quotes(_stream(spark, landed)))
    Q.run_to_table(once, out, state).awaitTermination()
    assert sorted(r.price for r in spark.read.parquet(out).collect()) == [10.0, 11.0]


def test_repeated_day_adds_nothing(spark):
    path = work_folder(spark, "days")
    rows = spark.range(10).select(F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("data_date"))
    sinks.upsert_days(rows, path)
    sinks.upsert_days(rows.where("data_date = '2024-01-02'").withColumn("id", F.col("id") + 100), path)
    found = sorted(r.id for r in spark.read.parquet(path).collect())
    assert found == sorted([i for i in range(10) if i % 3 != 1] + [i + 100 for i in range(10) if i % 3 == 1])


def test_a_batch_rewrites_the_buckets_of_its_stocks_only(spark):
    table = work_folder(spark, "bucketed")

    def newest(both):
        return both.groupBy("code").agg(F.max_by("v", "t").alias("v"), F.max("t").alias("t"))

    def frame(rows):
        return spark.createDataFrame(rows, "code string, v string, t int")

    rows = {f"s{i}": (f"s{i}", "old", 0) for i in range(500)}
    assert len(buckets.merge(frame(list(rows.values())), table, 0, "code", newest)) == buckets.BUCKETS
    for number in range(1, 7):
        new = [(f"s{number}", f"v{number}", number), (f"n{number}", "new", number), ("s9", "late", -1)]
        for _ in range(2):  # a repeated batch
            changed = buckets.merge(frame(new), table, number, "code", newest)
        assert len(changed) <= 3
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/data/{number}")
        status = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(where)
        assert sum("bucket=" in str(x.getPath()) for x in status) == len(changed)
        rows |= {r[0]: r for r in new[:2]}
        assert sorted(map(tuple, buckets.read(spark, table).collect())) == sorted(rows.values())
    # an empty batch changes nothing; readers of the kept writes still see theirs
    assert buckets.merge(frame([]), table, 7, "code", newest) == []
    assert sorted(map(tuple, buckets.read(spark, table).collect())) == sorted(rows.values())
    numbers = versions.finished(spark, table)
    assert numbers == [5, 6, 7] and buckets.read(spark, table, 5).where("code = 'n6'").count() == 0
    assert buckets.merge(frame([]), f"{table}-new", 0, "code", newest) == [] and buckets.read(spark, f"{table}-new").count() == 0
