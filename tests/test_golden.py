"""Hand-computed rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom import fixed_values as fv, schemas
from barloom.functions import dates as D, labels as L, prices as P
from barloom.operators import bars, filters, flows, indicators, joins, project, sets, signals, versions, workdays
from barloom.operators.terms import keyword_range, term_assoc, token_array
from barloom.plans import loads, statements
from barloom.sources import readers


def value(spark, column, **inputs):
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in inputs.items())
    row = spark.createDataFrame([tuple(inputs.values())], schema or "x string")
    return row.select(column).first()[0]


def days(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "d string").select(F.to_date("d").alias("data_date"))


def prices(spark, closes, code="1", start=date(2020, 1, 1), high=None, low=None):
    rows = [
        (code, i, float(c), float(high[i] if high else c + 1), float(low[i] if low else c - 1))
        for i, c in enumerate(closes)
    ]
    frame = spark.createDataFrame(rows, "stock_code string, i int, close_price double, high_price double, low_price double")
    return frame.withColumn("data_date", F.date_add(F.lit(start), F.col("i"))).drop("i")


def test_iso_year_edges(spark):
    found = days(spark, "2020-12-31", "2021-01-01", "2021-01-03", "2021-01-04").select(
        D.week_year(F.col("data_date")), D.iso_week(F.col("data_date"))
    )
    assert [tuple(r) for r in found.collect()] == [("2020", 53)] * 3 + [("2021", 1)]


def test_sunday_belongs_to_the_week_before(spark):
    row = days(spark, "2021-09-26").select(*D.week_bounds(F.col("data_date"))).first()
    assert tuple(row) == (date(2021, 9, 20), date(2021, 9, 24))


def test_bars_skip_nulls_and_null_codes(spark):
    rows = [
        ("a", date(2021, 9, 20), None, 3.0, 1.0, 2.0, None),
        ("a", date(2021, 9, 21), 5.0, 6.0, 4.0, None, None),
        (None, date(2021, 9, 21), 5.0, 6.0, 4.0, 5.0, 1),
    ]
    frame = spark.createDataFrame(
        rows,
        "stock_code string, data_date date, open_price double, high_price double, low_price double, "
        "close_price double, volume bigint",
    )
    week = bars.bars_week(frame).collect()
    assert len(week) == 1
    assert (week[0].open_price, week[0].close_price, week[0].high_price, week[0].volume) == (5.0, 2.0, 6.0, 0)
    month = bars.bars_month(frame, "2021-09").first()
    assert (month.month_start_date, month.month_end_date) == (date(2021, 9, 20), date(2021, 9, 21))


def test_equal_bars_of_two_days_stay(spark):
    frame = days(spark, "2021-01-04", "2021-01-05", "2021-01-05").withColumn("close_price", F.lit(1.0))
    assert sets.dedup(frame).count() == 2


def test_warm_up_rows(spark):
    frame = indicators.indicators(prices(spark, [100 + (i * 7) % 13 for i in range(40)]))
    rows = frame.orderBy("data_date").collect()

    def first(name):
        return next(i for i, row in enumerate(rows) if row[name] is not None)

    assert [first(n) for n in ("ma5", "upper", "k", "d", "MACD", "MACDsignal")] == [4, 19, 12, 12, 33, 33]
    assert all(row.ma240 is None for row in rows)


def test_short_series_have_no_lines(spark):
    frame = indicators.indicators(prices(spark, [1.0, 2.0, 3.0]))
    assert frame.where("ma5 IS NOT NULL OR k IS NOT NULL OR MACD IS NOT NULL").count() == 0
    assert indicators.rsi(prices(spark, [5.0])).first().rsi is None


def test_flat_range_counts_as_zero(spark):
    flat = [10.0] * 20
    rows = indicators.stoch(prices(spark, flat, high=flat, low=flat)).orderBy("data_date").collect()
    assert rows[-1].k == 0.0 and rows[-1].d == 0.0
    assert indicators.rsi(prices(spark, flat)).agg(F.max("rsi")).first()[0] == 0.0


def test_kd_flag(spark):
    frame = spark.createDataFrame([(15.0, 10.0), (25.0, 10.0), (10.0, 15.0), (None, None)], "k double, d double")
    assert [r.buy_flag for r in signals.kd_oversold(frame).collect()] == [1, 0, 0, 0]


def test_quote_fallback_and_change_ratio(spark):
    assert value(spark, P.price_or_best_bid(F.col("z"), F.col("b")), z="-", b="12.5_12.4_") == "12.5"
    assert value(spark, P.price_or_best_bid(F.col("z"), F.col("b")), z=None, b="12.5_") is None
    ratio = P.change_ratio(F.col("a"), F.col("b"))
    assert value(spark, ratio, a=102.0, b=100.0) == 2.0
    assert value(spark, ratio, a=102.0, b=0.0) is None
    assert value(spark, ratio, a=100.125, b=100.0) == 0.12  # half to even


def test_labels(spark):
    t = F.col("t")
    assert value(spark, L.strip_commas(t), t="1,234") == "1234"
    assert value(spark, L.strip_quote_eq(t), t='="0050"') == "0050"
    assert value(spark, L.paren_word(t), t="x (USD)") == "USD"
    assert value(spark, L.paren_word(t), t="x") is None
    assert value(spark, L.code_of_label(t), t="2330 - abc") == "2330"
    assert value(spark, L.index_symbol(t), t="^TWII") == "TWII"
    assert value(spark, L.index_symbol(t), t="000001.SS") == "000001.SS"
    assert value(spark, L.strip_weekday(t), t="2/8(一)-2/16(二)") == "2/8-2/16"
    assert value(spark, L.normalise_label(t), t="買賣超(元)") == "買賣差額"
    assert value(spark, L.side_of_label(t), t="賣出金額") == "sell_money_amount"
    assert value(spark, L.slash_date(t), t="2021/9/3") == date(2021, 9, 3)
    assert value(spark, L.slash_date(t), t="n/a") is None
    assert value(spark, L.feed_symbol(t, F.lit("TWSE")), t="2330") == "tse_2330.tw"
    assert value(spark, L.feed_symbol(t, F.lit("other")), t="2330") == ""


def test_roc_and_month_keys(spark):
    day = F.lit(date(2021, 9, 3))
    assert value(spark, D.to_roc(day), t="") == "110/09/03"
    assert value(spark, D.from_roc(F.col("t")), t="110/09/03") == date(2021, 9, 3)
    assert value(spark, D.month_key(F.lit(2021), F.lit(12)), t="") == "2021-12"
    assert value(spark, D.month_back(F.lit(date(2021, 1, 31))), t="") == "2020-12"
    assert value(spark, D.utc_wall(D.utc_instant(F.col("t").cast("timestamp_ntz"))), t="2024-03-10 02:30:00.25") == datetime(
        2024, 3, 10, 2, 30, 0, 250000
    )


def test_workdays(spark):
    holidays = spark.createDataFrame(
        [("h", date(2021, 9, 18), date(2021, 9, 21)), ("other year", date(2020, 12, 30), date(2021, 1, 3))],
        "holiday_name string, holiday_start date, holiday_end date",
    )
    found = workdays.next_workday(
        days(spark, "2021-09-11", "2021-09-12", "2021-09-20", "2021-09-18", "2021-09-22", "2021-01-02"), holidays
    )
    assert {r.data_date: r.work_date for r in found.collect()} == {
        date(2021, 9, 11): date(2021, 9, 13),
        date(2021, 9, 12): date(2021, 9, 13),
        date(2021, 9, 20): date(2021, 9, 22),
        date(2021, 9, 18): date(2021, 9, 22),
        date(2021, 9, 22): date(2021, 9, 22),
        date(2021, 1, 2): date(2021, 1, 4),  # holidays of the year before do not count
    }


def test_workdays_of_odd_holidays(spark):
    holidays = spark.createDataFrame(
        [
            ("late", date(2023, 12, 30), date(2024, 1, 2)),
            ("new", date(2024, 1, 1), date(2024, 1, 3)),
            ("inverted", date(2024, 12, 30), date(2024, 1, 2)),
            ("friday", date(2024, 5, 2), date(2024, 5, 3)),
            ("monday", date(2024, 5, 6), date(2024, 5, 6)),
        ],
        "holiday_name string, holiday_start date, holiday_end date",
    )
    wanted = days(spark, "2024-01-02", "2024-06-12", "2024-05-02", "2024-05-04", "2024-05-06", "2024-06-15")
    found = {r.data_date: r.work_date for r in workdays.next_workday(wanted, holidays).collect()}
    assert found == {
        date(2024, 1, 2): date(2024, 1, 4),  # the holiday of its own year, though another began earlier
        date(2024, 6, 12): date(2024, 6, 12),
        date(2024, 5, 2): date(2024, 5, 4),  # not checked again
        date(2024, 5, 4): date(2024, 5, 6),
        date(2024, 5, 6): date(2024, 5, 7),
        date(2024, 6, 15): date(2024, 6, 17),
    }
    strict = {r.data_date: r.work_date for r in workdays.next_workday_strict(wanted, holidays).collect()}
    assert strict == found | {date(2024, 5, 2): date(2024, 5, 7), date(2024, 5, 4): date(2024, 5, 7)}


def test_filing_deadlines(spark):
    none = spark.createDataFrame([], "holiday_name string, holiday_start date, holiday_end date")
    rows = workdays.filing_deadlines(spark.createDataFrame([(2021,)], "year int"), none).collect()
    by = {(r.company_kind, r.report): r for r in rows}
    assert by["general", "q1"].filing_date == date(2021, 5, 17)  # 15 May 2021 is a Saturday
    assert by["financial", "annual"].report_year == 2020
    assert len(rows) == 8


def test_holiday_parse(spark):
    rows = spark.createDataFrame(
        [("x", "2/8(一)-2/16(二)", "9", ""), ("y", "1/1(一)", "1", ""), ("z", "soon", "1", "")],
        "holiday_name string, holiday_range string, holiday_day string, holiday_remarks string",
    )
    row, one, none = workdays.parse_holiday(rows, F.lit(2021)).orderBy("holiday_name").collect()
    assert (one.holiday_start, one.holiday_end) == (date(2021, 1, 1), date(2021, 1, 1))
    assert none.holiday_start is None and none.holiday_end is None
    assert (row.holiday_start, row.holiday_end, row.holiday_year) == (date(2021, 2, 8), date(2021, 2, 16), "2021")


def _flows(spark, rows):
    names = ["stock_code", "data_date", *fv.FLOW_VOLUMES]
    full = [(code, date(2024, 1, d), v, v, v, v, v, v) for code, d, v in rows]
    return spark.createDataFrame(full, "stock_code string, data_date date, " + ", ".join(f"{n} bigint" for n in names[2:]))


def test_exactly_three_positive_days(spark):
    frame = _flows(
        spark,
        [("four", d, 5) for d in (27, 28, 29, 30)]
        + [("three", d, 5 if d != 28 else -5) for d in (27, 28, 29, 30)]
        + [("old", d, 5) for d in (20, 21, 22)],
    )
    assert [r.stock_code for r in flows.flow_positive_days(frame, "2024-01-30").collect()] == ["three"]


def test_ratio_without_capital_or_flows(spark):
    securities = spark.createDataFrame(
        [("a", "A", 0), ("b", "B", 2000), ("c", "C", 1000)],
        "stock_code string, company_name_ch string, company_capital bigint",
    ).withColumn("update_date", F.lit(date(2024, 1, 1)))
    rows = flows.flow_ratio(securities, _flows(spark, [("a", 30, 5), ("b", 30, 4)]), "2024-01-30").collect()
    assert {r.stock_code: r.dealer_ratio for r in rows} == {"a": None, "b": 2.0, "c": None}


def test_streaks(spark):
    frame = _flows(spark, [("a", d, v) for d, v in ((1, 1), (2, 1), (5, 1), (6, 0), (7, 1), (8, 1))])
    rows = flows.flow_streak(frame, days=2).orderBy("data_date").collect()
    assert [(r.data_date.day, r.dealer_streak) for r in rows] == [(2, 2), (5, 3), (8, 2)]


def test_changed_security_keeps_its_old_version(spark):
    old = spark.createDataFrame([("A", "x"), ("B", "x")], "stock_code string, name string").withColumns(
        {"update_date": F.lit(date(2021, 1, 1)), "stock_status": F.lit("1")}
    )
    new = spark.createDataFrame([("A", "y"), ("B", "x")], "stock_code string, name string")
    merged = versions.scd_changed(old, new, date(2021, 9, 23))
    assert sorted((r.stock_code, r.name, r.update_date.year * 100 + r.update_date.month) for r in merged.collect()) == [
        ("A", "x", 202101),
        ("A", "y", 202109),
        ("B", "x", 202109),
    ]
    failed = spark.createDataFrame([("B",), ("B",)], "stock_code string")
    status = {(r.stock_code, r.name): r.stock_status for r in versions.mark_failed(merged, failed).collect()}
    assert status == {("A", "x"): "1", ("A", "y"): "1", ("B", "x"): "0"}


def test_history_and_today(spark):
    history = spark.createDataFrame(
        [("a", date(2021, 9, 22), 1.0), ("a", date(2021, 9, 23), 1.0), ("b", date(2021, 9, 23), 1.0)],
        "stock_code string, data_date date, close_price double",
    )
    history = history.withColumns(
        {**{n: F.col("close_price") for n in ("open_price", "high_price", "low_price")}, "volume": F.lit(1).cast("bigint")}
    )
    snapshot = spark.createDataFrame(
        [("a", 9.0)], "stock_code string, newest_deal_price double"
    ).withColumns({**{n: F.lit(9.0) for n in ("open_price", "high_price", "low_price")}, "accumulation_volume": F.lit(7).cast("bigint")})
    rows = sets.union_today(history, snapshot, date(2021, 9, 23)).collect()
    assert sorted((r.stock_code, r.data_date.day, r.close_price) for r in rows) == [
        ("a", 22, 1.0),
        ("a", 23, 9.0),
        ("b", 23, 1.0),
    ]


def test_statement_classes(spark):
    rows = [("1", "bank", 5, 7, None, 11), ("2", "insurance", None, None, 40, None), ("3", "general", None, None, 50, None)]
    frame = spark.createDataFrame(
        rows, "stock_code string, industry_class string, `利息淨收益` bigint, `利息以外淨損益` bigint, `營業收入` bigint, `營業費用` bigint"
    ).withColumn("report_year", F.lit("2021Q2"))
    with pytest.raises(ValueError, match="lacks the headings"):
        statements.unify_statements(frame, "income")
    needed = [*statements.headings("income"), *statements.headings("balance")]
    frame = frame.withColumns({n: F.lit(None).cast("bigint") for n in needed if n not in frame.columns})
    renamed = frame.withColumnRenamed("營業收入", "營業收入合計")
    with pytest.raises(ValueError, match="營業收入"):
        statements.unify_statements(renamed, "income")
    income = {r.stock_code: r for r in statements.unify_statements(frame, "income").collect()}
    assert [income[c].gross_revenue for c in "123"] == [12, 40, 50]
    assert income["1"].operating_expenses == 11 and income["1"].operating_costs is None
    assert statements.unify_statements(frame, "income", "0").count() == 1
    assert statements.unify_statements(frame, "balance").columns[1:12] == list(fv.BALANCE_COLUMNS.values())


def test_strict_and_coerced_casts(spark):
    frame = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    with pytest.raises(Exception, match="v is no bigint: x"):
        project.cast_strict(frame, ["v"]).collect()
    assert project.cast_coerce(frame, "v").count() == 1
    good, bad = readers.dead_letter(frame, {"v": "int"})
    assert (good.count(), [r.v for r in bad.collect()]) == (2, ["x"])
    rows = {r.landed.v: (r.v, r.failed_columns) for r in readers.checked(frame, {"v": "int"}).collect()}
    assert rows == {"1": (1, None), "x": (None, "v"), None: (None, None)}


def test_null_closes_are_no_bars(spark):
    rows = [("a", date(2024, 1, i + 1), p) for i, p in enumerate((10.0, 10.0, 10.0, None, 10.0, 20.0))]
    prices = spark.createDataFrame(rows, "stock_code string, data_date date, close_price double")
    found = {r.data_date.day: r.ma5 for r in indicators.sma(prices, (5,)).collect()}
    assert found == {1: None, 2: None, 3: None, 5: None, 6: 12.0}
    found = {r.data_date.day: r.ema2 for r in indicators.ema(prices, 2).collect()}
    assert set(found) == {1, 2, 3, 5, 6} and found[5] == 10.0


def test_filters(spark):
    frame = days(spark, "2021-12-01", "2021-12-31", "2022-01-01")
    assert filters.in_month(frame, "2021-12").count() == 2
    assert filters.year_of(frame, "data_date", 2022).count() == 1
    assert filters.recent_days(frame, "2022-01-01", 1).count() == 2
    labels = spark.createDataFrame([("合計",), ("a",), (None,)], "v string")
    assert filters.drop_label(labels, "v", "合計").count() == 2


def test_quotes_payload(spark):
    payload = '{"msgArray":[{"c":"2330","z":"-","b":"12.5_12.4_","v":"-","y":"10"}],"other":1}'
    raw = readers.parse_quotes(spark.createDataFrame([(payload,), ("{}",)], "p string"), "p")
    assert raw.count() == 2
    row = loads.quote_snapshot(raw.where("c IS NOT NULL"), datetime(2021, 9, 23)).first()
    assert (row.newest_deal_price, row.price_change_ratio, row.accumulation_volume) == (12.5, 25.0, 0)
    assert row.open_price is None
    bar = loads.eod_bar(loads.quote_snapshot(raw), date(2021, 9, 23))
    assert bar.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.STOCK_PRICE]


def test_clean_csv(spark):
    frame = spark.createDataFrame([("a", None, 1), ("b", None, None)], "x string, y string, z int")
    cleaned = readers.clean_csv(frame)
    assert cleaned.columns == ["x", "z"] and cleaned.count() == 1


def test_words(spark):
    frame = spark.createDataFrame([("大盤漲ab c，é台",), ("Plain X-ray",), (None,)], "text string")
    found = [r[0] for r in frame.select(token_array(F.col("text"))).collect()]
    assert found == [["大盤", "盤漲", "ab", "c", "é", "台"], ["plain", "x", "ray"], None]


def test_association(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c"), (4, "c a")], "doc_id bigint, text string")
    found = {r.term: (r.doc_count, r.both_count, round(r.phi, 6)) for r in term_assoc(docs, "A").collect()}
    assert found == {"b": (2, 2, round((4 * 2 - 3 * 2) / ((3 * 1) ** 0.5 * (2 * 2) ** 0.5), 6)), "c": (2, 1, -0.57735)}
    assert [r.doc_id for r in keyword_range(docs, "a", 2, 2, page_size=1).collect()] == [2]


def test_natural_join_needs_common_columns(spark):
    with pytest.raises(ValueError):
        joins.natural_join(spark.range(1).toDF("a"), spark.range(1).toDF("b"))
