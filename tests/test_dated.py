"""Table of days: loads replace whole days, are seen at once, and leave nothing half done."""

import pytest
from pyspark.sql import functions as F

from barloom.session import work_folder
from barloom.sources import dated


def frame(spark, rows):
    return spark.createDataFrame(rows, "data_date string, id int").withColumn("data_date", F.col("data_date").cast("date"))


def content(df):
    return sorted(((str(r.data_date) if r.data_date else None), r.id) for r in df.collect())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


FIRST = [("2022-12-30", 1), ("2022-12-31", 2), ("2023-01-02", 3), ("2023-01-02", 3), ("2023-01-03", 4), ("2024-02-29", 5)]


@pytest.fixture
def table(spark):
    path = work_folder(spark, "dated")
    assert dated.put_days(frame(spark, FIRST), path) == [2022, 2023, 2024]
    return path


def test_days_of_two_years_are_replaced_together(spark, table):
    assert content(dated.read_days(spark, table)) == FIRST
    before = dated.read_days(spark, table)
    load = [("2022-12-31", 20), ("2023-01-02", 30), ("2023-06-01", 31)]
    for number in (1, 1):  # a repeated load replaces itself
        assert dated.put_days(frame(spark, load), table, number=number) == [2022, 2023]
    after = [("2022-12-30", 1), ("2022-12-31", 20), ("2023-01-02", 30), ("2023-01-03", 4), ("2023-06-01", 31), ("2024-02-29", 5)]
    assert content(dated.read_days(spark, table)) == after
    assert content(before) == FIRST and content(dated.read_days(spark, table, number=0)) == FIRST
    files = dated.read_days(spark, table).inputFiles()
    assert {f.split("/data/")[1].split("/")[0] for f in files if "bucket=2024" in f} == {"0"}
    assert {f.split("/data/")[1].split("/")[0] for f in files if "bucket=2022" in f or "bucket=2023" in f} == {"1"}


def test_a_failed_load_leaves_the_table(spark, table):
    load = frame(spark, [("2023-01-02", 30), ("2024-02-29", 50)])
    bad = load.withColumn("id", F.when(F.col("id") == 50, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        dated.put_days(bad, table)
    assert content(dated.read_days(spark, table)) == FIRST
    dated.put_days(load, table)
    assert content(dated.read_days(spark, table)) == [*FIRST[:2], ("2023-01-02", 30), ("2023-01-03", 4), ("2024-02-29", 50)]


def test_bounds_open_their_years_only(spark, table):
    found = dated.read_days(spark, table, "2022-12-31", "2023-01-02")
    assert content(found) == FIRST[1:4]
    assert not [f for f in found.inputFiles() if "bucket=2024" in f]
    assert content(dated.read_days(spark, table, first="2023-01-03")) == FIRST[4:]
    assert content(dated.read_days(spark, table, last="2022-12-30")) == FIRST[:1]
    assert content(dated.read_days(spark, table, "2030-01-01")) == []


def test_rows_without_a_date_and_empty_loads(spark, table):
    assert dated.put_days(frame(spark, []), table) == []
    assert content(dated.read_days(spark, table)) == FIRST
    dated.put_days(frame(spark, [(None, 7), (None, 8)]), table)
    dated.put_days(frame(spark, [(None, 9), ("2024-02-29", 6)]), table)
    rows = [tuple(r) for r in dated.read_days(spark, table).select(F.col("data_date").cast("string"), "id").collect()]
    assert in_order(rows) == in_order([*FIRST[:5], ("2024-02-29", 6), (None, 9)])
    assert content(dated.read_days(spark, table, "1900-01-01")) == [*FIRST[:5], ("2024-02-29", 6)]
    empty = work_folder(spark, "dated-empty")
    dated.put_days(frame(spark, []), empty)
    assert dated.read_days(spark, empty).count() == 0


def test_a_load_may_read_the_table_it_changes(spark, table):
    for _ in range(5):  # more loads than versions are kept
        old = dated.read_days(spark, table, "2023-01-01", "2023-12-31")
        dated.put_days(old.withColumn("id", F.col("id") + 10), table)
    assert content(dated.read_days(spark, table)) == [*FIRST[:2], *[("2023-01-02", 53)] * 2, ("2023-01-03", 54), ("2024-02-29", 5)]
