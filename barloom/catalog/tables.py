"""Sources, sinks, filters, joins, versions, unions and loads."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from barloom import fixed_values as fv, schemas
from barloom.catalog.base import (
    AS_OF,
    BARS,
    Catalog,
    FLOWS,
    HOLIDAYS,
    NEWEST,
    QUOTES,
    REVENUE,
    SECURITIES,
    SIGNED,
)
from barloom.functions import labels as L
from barloom.functions.dates import utc_wall
from barloom.operators import filters as FI, joins as J, project as pr, reshape, sets as ST, versions as V
from barloom.plans import loads, views
from barloom.session import work_folder
from barloom.sources import dated, readers, sinks, versions

catalog = Catalog()
query = catalog.query

_BAR_SQL = "stock_code, data_date, open_price, high_price, low_price, close_price, volume"


# ----------------------------------------------------------------- sources
@query(
    "src_price_range",
    f"WITH {BARS} SELECT {_BAR_SQL} FROM bars WHERE data_date BETWEEN '1995-01-01' AND '1996-06-30'",
)
def src_price_range(spark, d):
    stored = work_folder(spark, "stock_price")
    sinks.append(pr.conform(views.bars(spark, d), schemas.STOCK_PRICE), stored)
    prices = readers.read_prices(spark, stored, "1995-01-01", "1996-06-30")
    return prices.select(*[name.strip() for name in _BAR_SQL.split(",")])


@query(
    "src_json_quotes",
    f"""WITH {QUOTES} SELECT ts, c, CAST(NULL AS STRING) AS n, z, CAST(NULL AS STRING) AS tv, v,
    CAST(NULL AS STRING) AS o, CAST(NULL AS STRING) AS h, CAST(NULL AS STRING) AS l, CAST(NULL AS STRING) AS y, b
    FROM quotes""",
)
def src_json_quotes(spark, d):
    payload = F.to_json(F.struct(F.array(F.struct("c", "z", "b", "v")).alias("msgArray")))
    return readers.parse_quotes(views.quotes(spark, d).select("ts", payload.alias("payload")), "payload")


@query(
    "src_csv_clean",
    """SELECT CAST(c_custkey AS STRING) AS code, c_name AS name, CAST(round(c_acctbal * 100) AS BIGINT) AS cents
    FROM customer WHERE c_custkey % 7 <> 0""",
)
def src_csv_clean(spark, d):
    """Reports of one file per nation: title, heading, rows, footnote."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey").alias("report")
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string")
    line = F.concat_ws(",", key.cast("string"), F.col("c_name"), F.lit(""), F.when(key % 7 != 0, cents).otherwise(""))
    rows = views.table(spark, d, "customer").select(nation, key.alias("line"), line.alias("value"))
    folder = _land_reports(rows, ("Customers", "code,name,unused,cents"), ("end of report",))
    landed = readers.report_rows(readers.report_lines(spark, folder)).drop("file", "line_no")
    return pr.cast_strict(readers.clean_csv(landed), ["cents"])


def _land_reports(rows, above, below=()):
    """Write ``report, line, value`` as one text file per report, lines above and below the rows."""
    spark = rows.sparkSession
    reports = rows.select("report").distinct()
    last = (1 << 62) + 1
    around = [(n - len(above), text) for n, text in enumerate(above)] + [(last + n, text) for n, text in enumerate(below)]
    framed = [reports.select("report", F.lit(n).cast("bigint").alias("line"), F.lit(text).alias("value")) for n, text in around]
    whole = ST.union_all([rows.withColumn("line", F.col("line") + 1), *framed])
    folder = work_folder(spark, "reports")
    ordered = whole.repartition("report").sortWithinPartitions("report", "line").select("report", "value")
    ordered.write.partitionBy("report").text(folder)
    return folder


@query(
    "src_quoted_csv",
    "SELECT CAST(o_orderkey AS STRING) AS code, CAST(round(o_totalprice * 100) AS BIGINT) AS amount FROM orders",
)
def src_quoted_csv(spark, d):
    """Reports of one file per month: title, unquoted heading, rows, an empty line."""
    amount = F.format_number(F.round(F.col("o_totalprice") * 100).cast("bigint"), 0)
    line = F.format_string('"%s","%s"', F.col("o_orderkey"), amount)
    month = F.date_format("o_orderdate", "yyyy-MM").alias("report")
    rows = views.table(spark, d, "orders").select(month, F.col("o_orderkey").alias("line"), line.alias("value"))
    lines = readers.report_lines(spark, _land_reports(rows, ("Orders", "code,amount"), ("",)))
    parsed = readers.report_rows(lines).drop("file", "line_no")
    return pr.cast_strict(pr.strip_all_commas(parsed), ["amount"])


@query(
    "src_multi_file_union",
    """SELECT CAST(c_custkey AS STRING) AS stock_code, CAST(c_acctbal AS DOUBLE) AS amount, c_name AS remark
    FROM customer UNION ALL SELECT CAST(s_suppkey AS STRING), s_acctbal, NULL FROM supplier""",
)
def src_multi_file_union(spark, d):
    listed = views.table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("stock_code"),
        F.col("c_name").alias("remark"),
        F.col("c_acctbal").alias("amount"),
    )
    other = views.table(spark, d, "supplier").select(
        F.col("s_acctbal").alias("amount"), F.col("s_suppkey").cast("string").alias("stock_code")
    )
    return readers.union_feeds(listed, other)


@query("src_repeated_header", "SELECT CAST(c_custkey AS STRING) AS stock_code, c_name FROM customer")
def src_repeated_header(spark, d):
    rows = views.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("stock_code"), "c_name")
    headers = views.table(spark, d, "region").select(
        F.lit(fv.CODE_HEADING).alias("stock_code"), F.col("r_name").alias("c_name")
    )
    return readers.drop_header_rows(rows.unionByName(headers), "stock_code")


@query(
    "src_dead_letter",
    f"""WITH {QUOTES} SELECT c, ts, CASE WHEN z <> '-' THEN CAST(z AS DOUBLE) END AS z,
    CASE WHEN z = '-' THEN 'z' END AS failed_columns FROM quotes""",
)
def src_dead_letter(spark, d):
    return readers.checked(views.quotes(spark, d).select("c", "ts", "z"), {"z": "double"}).drop("landed")


# ------------------------------------------------------------------- sinks
@query("sink_append", f"WITH {FLOWS} SELECT * FROM flows")
def sink_append(spark, d):
    stored = work_folder(spark, "flows")
    rows = views.flows(spark, d)
    middle = F.to_date(F.lit("2024-01-16"))
    sinks.append(rows.where(F.col("data_date") < middle), stored)
    sinks.append(rows.where(F.col("data_date") >= middle), stored)
    return spark.read.parquet(stored).select(*rows.columns)


@query("sink_snapshot_replace", f"WITH {NEWEST} SELECT * FROM newest")
def sink_snapshot_replace(spark, d):
    stored = work_folder(spark, "securities")
    rows = views.securities(spark, d)
    sinks.replace(rows, stored)
    sinks.replace(J.rank_versions(versions.read(spark, stored)), stored)
    return versions.read(spark, stored)


@query("sink_partition_overwrite", f"WITH {FLOWS} SELECT * FROM flows")
def sink_partition_overwrite(spark, d):
    stored = work_folder(spark, "flows")
    rows = views.flows(spark, d)
    dated.put_days(rows, stored)
    dated.put_days(FI.recent_days(rows, AS_OF), stored)
    return dated.read_days(spark, stored).select(*rows.columns)


@query(
    "table_append_reload_read",
    f"""WITH {BARS}, days AS (SELECT DISTINCT data_date FROM bars WHERE year(data_date) = 1996 AND month(data_date) = 6)
    SELECT stock_code, data_date, open_price, high_price, low_price,
      CASE WHEN data_date IN (SELECT data_date FROM days) THEN -close_price ELSE close_price END AS close_price, volume
    FROM bars WHERE data_date BETWEEN '1996-05-01' AND '1997-01-31'""",
)
def table_append_reload_read(spark, d):
    stored = work_folder(spark, "stock_price")
    prices = pr.conform(views.bars(spark, d), schemas.STOCK_PRICE)
    june = F.col("data_date").between("1996-06-01", "1996-06-30")
    sinks.append(prices.where(F.col("data_date") < "1996-06-15"), stored)
    sinks.append(prices.where(F.col("data_date") >= "1996-06-15"), stored)
    for _ in range(2):  # a repeated load adds nothing
        sinks.upsert_days(prices.where(june).withColumn("close_price", -F.col("close_price")), stored)
    found = readers.read_prices(spark, stored, "1996-05-01", "1997-01-31")
    return found.select(*[name.strip() for name in _BAR_SQL.split(",")])


@query(
    "sink_txt_vs_csv",
    """SELECT 'post' AS kind, 'txt' AS fmt, conv_id AS post_id, length(text) AS n_chars FROM conversations WHERE turn = 0
    UNION ALL SELECT 'comment', 'txt', conv_id, length(text) FROM conversations WHERE turn > 0
    UNION ALL SELECT 'post', 'csv', conv_id, length(text) FROM conversations WHERE turn = 0
    UNION ALL SELECT 'comment', 'csv', conv_id, length(text) FROM conversations WHERE turn > 0""",
)
def sink_txt_vs_csv(spark, d):
    rows = views.table(spark, d, "conversations").withColumnRenamed("conv_id", "post_id")
    posts, comments = rows.where("turn = 0").select("post_id", "text"), rows.where("turn > 0").drop("turn")
    read = []
    for fmt in ("txt", "csv"):
        folder = work_folder(spark, f"posts-{fmt}")
        sinks.export(posts, comments, folder, fmt)
        if fmt == "txt":
            whole = spark.read.schema("value string, post_id bigint").text(f"{folder}/posts", wholetext=True)
            # the writer ends each file with a line break of its own
            written = whole.select("post_id", F.expr("left(value, char_length(value) - 1)").alias("text"))
        else:
            written = _read_csv(spark, f"{folder}/posts", "post_id bigint, text string")
        answers = _read_csv(spark, f"{folder}/comments", ", ".join(
            f"{name} {'bigint' if name == 'post_id' else 'string'}"
            for name in (comments.columns if fmt == "csv" else [*comments.columns[1:], "post_id"])
        ))
        for kind, frame in (("post", written), ("comment", answers)):
            read.append(
                frame.select(
                    F.lit(kind).alias("kind"),
                    F.lit(fmt).alias("fmt"),
                    "post_id",
                    F.char_length("text").cast("bigint").alias("n_chars"),
                )
            )
    return ST.union_all(read)


def _read_csv(spark, path, schema):
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', emptyValue="")


# ----------------------------------------------------------------- filters
@query("filter_between", f"WITH {BARS} SELECT {_BAR_SQL} FROM bars WHERE data_date BETWEEN '1996-03-04' AND '1996-03-29'")
def filter_between(spark, d):
    return FI.between_dates(views.bars(spark, d), "1996-03-04", "1996-03-29")


@query("filter_month", f"WITH {BARS} SELECT {_BAR_SQL} FROM bars WHERE substr(CAST(data_date AS STRING), 1, 7) = '1996-12'")
def filter_month(spark, d):
    return FI.in_month(views.bars(spark, d), "1996-12")


@query("filter_recent_days", f"WITH {FLOWS} SELECT * FROM flows WHERE date_diff('day', data_date, DATE '{AS_OF}') <= 3")
def filter_recent_days(spark, d):
    return FI.recent_days(views.flows(spark, d), AS_OF)


_SEGMENTS = ("BUILDING", "MACHINERY")


@query("filter_in_list", f"WITH {SECURITIES} SELECT * FROM securities WHERE industry IN {_SEGMENTS}")
def filter_in_list(spark, d):
    return FI.keep_values(views.securities(spark, d), "industry", _SEGMENTS)


@query("filter_neq_label", f"WITH {SECURITIES} SELECT * FROM securities WHERE industry <> 'FURNITURE'")
def filter_neq_label(spark, d):
    return FI.drop_label(views.securities(spark, d), "industry", "FURNITURE")


@query(
    "filter_not_null",
    f"WITH {QUOTES} SELECT c, ts, CAST(nullif(v, '-') AS BIGINT) AS v FROM quotes WHERE v <> '-'",
)
def filter_not_null(spark, d):
    rows = views.quotes(spark, d).select("c", "ts", F.col("v").try_cast("bigint").alias("v"))
    return FI.not_null(rows, "v")


@query("filter_prefix_like", f"WITH {HOLIDAYS} SELECT * FROM holidays WHERE CAST(holiday_start AS STRING) LIKE '1997%'")
def filter_prefix_like(spark, d):
    return FI.year_of(views.holidays(spark, d), "holiday_start", 1997)


@query("filter_status", f"WITH {SECURITIES} SELECT DISTINCT stock_code, stock_class FROM securities WHERE stock_status = 'O'")
def filter_status(spark, d):
    return FI.active_only(views.securities(spark, d), status="O")


# ------------------------------------------------------------------- joins
@query(
    "join_left_fact_agg",
    f"""WITH {SECURITIES}, {REVENUE}, a AS (SELECT stock_code, CAST(sum(gross_revenue) AS BIGINT) AS total
      FROM revenue WHERE ym >= 199601 GROUP BY stock_code)
    SELECT s.stock_code, s.update_date, s.industry, a.total FROM securities s
    LEFT JOIN a ON a.stock_code = s.stock_code""",
)
def join_left_fact_agg(spark, d):
    totals = views.revenue(spark, d).where("ym >= 199601").groupBy("stock_code").agg(
        F.sum("gross_revenue").alias("total")
    )
    dim = views.securities(spark, d).select("stock_code", "update_date", "industry")
    return J.attach_agg(dim, totals)


@query("join_latest_version", f"WITH {NEWEST} SELECT * FROM newest")
def join_latest_version(spark, d):
    return J.latest_version(views.securities(spark, d))


@query("rank_latest_version", f"WITH {NEWEST} SELECT * FROM newest")
def rank_latest_version(spark, d):
    return J.rank_versions(views.securities(spark, d))


@query(
    "join_left_self_bounds",
    f"""WITH {BARS}, m AS (SELECT stock_code, strftime(data_date, '%Y-%m') AS data_year_month,
      min(data_date) AS month_start_date, max(data_date) AS month_end_date FROM bars
      GROUP BY stock_code, strftime(data_date, '%Y-%m'))
    SELECT b.stock_code, b.data_date, b.close_price, m.data_year_month, month_start_date, month_end_date
    FROM bars b LEFT JOIN m ON m.stock_code = b.stock_code
      AND m.data_year_month = strftime(b.data_date, '%Y-%m')""",
)
def join_left_self_bounds(spark, d):
    return J.with_period_bounds(views.bars(spark, d).select("stock_code", "data_date", "close_price"))


@query(
    "join_natural_inner",
    f"""WITH {FLOWS}, {NEWEST}, a AS (SELECT stock_code, data_date, institutional_investors_vol_amount FROM flows),
    b AS (SELECT DISTINCT stock_code, company_name_ch FROM newest) SELECT * FROM a NATURAL JOIN b""",
)
def join_natural_inner(spark, d):
    flows = views.flows(spark, d).select("stock_code", "data_date", "institutional_investors_vol_amount")
    names = J.rank_versions(views.securities(spark, d)).select("stock_code", "company_name_ch").distinct()
    return J.natural_join(flows, names)


@query(
    "join_range_holiday",
    f"""WITH {HOLIDAYS}, days AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS data_date FROM orders)
    SELECT o_orderkey, data_date, holiday_name, holiday_start, holiday_end FROM days
    LEFT JOIN holidays ON data_date BETWEEN holiday_start AND holiday_end""",
)
def join_range_holiday(spark, d):
    days = views.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("data_date"))
    return J.match_holiday(days, views.holidays(spark, d))


@query("join_semi_codes", f"WITH {FLOWS}, {BARS} SELECT * FROM flows WHERE stock_code IN (SELECT stock_code FROM bars)")
def join_semi_codes(spark, d):
    return J.semi(views.flows(spark, d), ST.distinct_codes(views.bars(spark, d)))


@query(
    "join_lookup_scalar",
    f"""WITH {FLOWS}, {NEWEST}, m AS (SELECT DISTINCT stock_code, stock_class FROM newest),
    j AS (SELECT f.stock_code, f.data_date, m.stock_class FROM flows f LEFT JOIN m ON m.stock_code = f.stock_code)
    SELECT *, CASE WHEN stock_class = 'TWSE' THEN concat('tse_', stock_code, '.tw')
      WHEN stock_class = 'OTC' THEN concat('otc_', stock_code, '.tw') ELSE '' END AS feed_symbol,
      concat(stock_code, CASE WHEN stock_class = 'TWSE' THEN '.TW' ELSE '.TWO' END) AS price_symbol FROM j""",
)
def join_lookup_scalar(spark, d):
    codes = views.flows(spark, d).select("stock_code", "data_date")
    return J.lookup_class(codes, views.securities(spark, d))


@query(
    "join_asof_prev_trade",
    f"""WITH {BARS}, {SECURITIES}, l AS (SELECT stock_code, update_date AS data_date, industry FROM securities)
    SELECT l.stock_code, l.data_date, l.industry, b.data_date AS asof_data_date, b.close_price AS asof_close_price
    FROM l ASOF LEFT JOIN bars b ON l.stock_code = b.stock_code AND l.data_date >= b.data_date""",
)
def join_asof_prev_trade(spark, d):
    dates = views.securities(spark, d).select(
        "stock_code", F.col("update_date").alias("data_date"), "industry"
    )
    return J.asof_join(dates, views.stored_bars(spark, d))


_EVENT_SIDES = """l AS (SELECT event_id, CAST(user_id % 7 AS STRING) AS stock_code, ts FROM events WHERE event_type IN ('click', 'error')),
r AS (SELECT CAST(user_id % 7 AS STRING) AS stock_code, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS ts, max(value) AS price FROM events
  WHERE event_type IN ('view', 'signup') GROUP BY user_id % 7, date_trunc('minute', ts))"""


@query(
    "join_asof_instants",
    f"""WITH {_EVENT_SIDES}
    SELECT l.event_id, l.stock_code, l.ts, CASE WHEN r.ts >= l.ts - INTERVAL 20 MINUTE THEN r.ts END AS asof_ts,
      CASE WHEN r.ts >= l.ts - INTERVAL 20 MINUTE THEN r.price END AS asof_price
    FROM l ASOF LEFT JOIN r ON l.stock_code = r.stock_code AND l.ts >= r.ts""",
)
def join_asof_instants(spark, d):
    events = views.table(spark, d, "events").withColumn("stock_code", (F.col("user_id") % 7).cast("string"))
    asked = events.where(F.col("event_type").isin("click", "error")).select("event_id", "stock_code", "ts")
    quoted = events.where(F.col("event_type").isin("view", "signup"))
    # several quotes of a stock in one minute
    quoted = quoted.select("stock_code", F.date_trunc("minute", "ts").cast(events.schema["ts"].dataType).alias("ts"), F.col("value").alias("price"))
    return J.asof_join_instants(asked, quoted, tolerance="20 minutes")


_ASKED = """asked AS (SELECT o_orderkey AS order_key, CAST(o_custkey AS STRING) AS stock_code,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 - 450 AS INTEGER) AS data_date FROM orders)"""


def _asked(spark, d):
    orders = views.table(spark, d, "orders")
    day = F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 900 - 450).cast("int"))
    return orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").cast("string").alias("stock_code"), day.alias("data_date"))


@query(
    "master_at_date",
    f"""WITH {SECURITIES}, {_ASKED}, dates AS (SELECT DISTINCT stock_code, update_date FROM securities),
    spans AS (SELECT stock_code, update_date, lead(update_date) OVER (PARTITION BY stock_code ORDER BY update_date) AS valid_to FROM dates),
    valid AS (SELECT s.*, s.update_date AS valid_from, valid_to FROM securities s JOIN spans USING (stock_code, update_date))
    SELECT a.*, v.* EXCLUDE (stock_code) FROM asked a LEFT JOIN valid v
    ON a.stock_code = v.stock_code AND a.data_date >= valid_from AND (valid_to IS NULL OR a.data_date < valid_to)""",
)
def master_at_date(spark, d):
    return V.at_dates(_asked(spark, d), V.with_validity(views.securities(spark, d)))


_OVERLAPPING = """overlapping AS (SELECT CAST(o_custkey AS STRING) AS stock_code, o_orderstatus AS stock_status,
  CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS valid_from,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 1200 - 30 AS INTEGER) END AS valid_to FROM orders)"""


@query(
    "master_at_date_overlaps",
    f"""WITH {_ASKED}, {_OVERLAPPING}, held AS (SELECT a.*, o.stock_status, o.valid_from, o.valid_to,
      rank() OVER (PARTITION BY order_key ORDER BY coalesce(valid_from, DATE '0001-01-01') DESC) AS place
      FROM asked a JOIN overlapping o ON a.stock_code = o.stock_code AND (valid_from IS NULL OR data_date >= valid_from)
      AND (valid_to IS NULL OR data_date < valid_to) AND (valid_from IS NULL OR valid_to IS NULL OR valid_from < valid_to))
    SELECT a.*, h.stock_status, h.valid_from, h.valid_to FROM asked a LEFT JOIN held h ON h.order_key = a.order_key AND h.place = 1""",
)
def master_at_date_overlaps(spark, d):
    orders, day, n = views.table(spark, d, "orders"), F.to_date("o_orderdate"), F.col("o_orderkey")
    intervals = orders.select(
        F.col("o_custkey").cast("string").alias("stock_code"),
        F.col("o_orderstatus").alias("stock_status"),
        F.when(n % 11 != 0, day).alias("valid_from"),
        F.when(n % 7 != 0, F.date_add(day, (n % 1200 - 30).cast("int"))).alias("valid_to"),
    )
    return V.at_dates(_asked(spark, d), intervals)


# ------------------------------------------------- distinct rows and counts
@query("distinct_codes", f"WITH {BARS} SELECT DISTINCT stock_code FROM bars")
def distinct_codes(spark, d):
    return ST.distinct_codes(views.ticks(spark, d).select(F.col("code").cast("string").alias("stock_code")))


@query(
    "dedup_rows",
    "SELECT DISTINCT CAST(user_id AS STRING) AS stock_code, CAST(ts AS DATE) AS data_date, event_type FROM events",
)
def dedup_rows(spark, d):
    rows = views.signed_flows(spark, d).select("stock_code", "data_date", "event_type")
    return ST.dedup(rows, ["stock_code", "data_date", "event_type"])


@query(
    "group_count_changed",
    f"""WITH {SECURITIES} SELECT stock_code, count(*) AS version_count FROM
    (SELECT DISTINCT stock_code, stock_status FROM securities) q GROUP BY stock_code HAVING count(*) > 1""",
)
def group_count_changed(spark, d):
    return ST.changed_keys(views.securities(spark, d).select("stock_code", "stock_status").distinct())


@query(
    "max_per_group",
    f"WITH {SECURITIES} SELECT stock_code, max(update_date) AS newest_update_date FROM securities GROUP BY stock_code",
)
def max_per_group(spark, d):
    return J.newest_per_key(views.securities(spark, d))


@query(
    "run_counts",
    f"""WITH {QUOTES} SELECT CAST(ts AS DATE) AS data_date, count(*) FILTER (WHERE z <> '-') AS row_count,
    count(*) FILTER (WHERE z = '-') AS error_count FROM quotes GROUP BY CAST(ts AS DATE)""",
)
def run_counts(spark, d):
    rows = views.quotes(spark, d).select(F.to_date("ts").alias("data_date"), "z")
    return ST.load_counts(readers.checked(rows, {"z": "double"}), "data_date")


@query("load_row_count", f"WITH {FLOWS} SELECT 'flows' AS load_name, count(*) AS row_count FROM flows")
def load_row_count(spark, d):
    counted, observation = ST.observe_counts(views.flows(spark, d), "flows")
    sinks.append(counted, work_folder(spark, "flows"))  # counted while it is written
    names = views.table(spark, d, "region").select(F.lit("flows").alias("load_name")).distinct()
    return names.withColumn("row_count", F.lit(observation.get["row_count"]).cast("bigint"))


@query("sort_by_date", f"WITH {HOLIDAYS} SELECT * FROM holidays ORDER BY holiday_start")
def sort_by_date(spark, d):
    return ST.sort_by(views.holidays(spark, d), "holiday_start")


@query(
    "first_match",
    f"""WITH {HOLIDAYS}, m AS (SELECT CAST(o_orderdate AS DATE) AS data_date, holiday_name, holiday_start, holiday_end,
      row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY holiday_start, holiday_name) AS rn
      FROM orders JOIN holidays ON CAST(o_orderdate AS DATE) BETWEEN holiday_start AND holiday_end)
    SELECT data_date, holiday_name, holiday_start, holiday_end FROM m WHERE rn = 1""",
)
def first_match(spark, d):
    days = views.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("data_date")).distinct()
    matched = J.match_holiday(days, views.holidays(spark, d)).where("holiday_name IS NOT NULL")
    return ST.first_by(matched, ["data_date"], ["holiday_start", "holiday_name"])


@query(
    "str_concat_symbol",
    f"""WITH {NEWEST} SELECT stock_code, CASE WHEN stock_class = 'TWSE' THEN concat('tse_', stock_code, '.tw')
    WHEN stock_class = 'OTC' THEN concat('otc_', stock_code, '.tw') ELSE '' END AS feed_symbol FROM newest""",
)
def str_concat_symbol(spark, d):
    rows = J.rank_versions(views.securities(spark, d))
    symbol = L.feed_symbol(F.col("stock_code"), F.col("stock_class"))
    return rows.select("stock_code", symbol.alias("feed_symbol"))


@query(
    "str_chunk_join",
    f"""WITH {NEWEST}, s AS (SELECT CASE WHEN stock_class = 'TWSE' THEN concat('tse_', stock_code, '.tw')
      ELSE concat('otc_', stock_code, '.tw') END AS symbol FROM newest),
    n AS (SELECT symbol, (row_number() OVER (ORDER BY symbol) - 1) // 50 AS batch_no FROM s)
    SELECT CAST(batch_no AS BIGINT) AS batch_no, string_agg(symbol, '|' ORDER BY symbol) AS codes,
      count(*) AS code_count FROM n GROUP BY batch_no""",
)
def str_chunk_join(spark, d):
    rows = J.rank_versions(views.securities(spark, d))
    symbols = rows.select(L.feed_symbol(F.col("stock_code"), F.col("stock_class")).alias("symbol"))
    return ST.chunk_codes(symbols, "symbol", most=100)


# ------------------------------------------------------------------ unions
_TODAY = date(1998, 6, 1)


@query(
    "union_history_today",
    f"""WITH {BARS}, today AS (SELECT CAST(p_partkey % 40 AS STRING) AS stock_code, DATE '{_TODAY}' AS data_date,
      CAST(min(p_size) AS DOUBLE) AS open_price, CAST(max(p_size) AS DOUBLE) AS high_price,
      CAST(min(p_size) AS DOUBLE) AS low_price, CAST(max(p_size) AS DOUBLE) AS close_price,
      CAST(count(*) AS BIGINT) AS volume FROM part GROUP BY p_partkey % 40)
    SELECT {_BAR_SQL} FROM today UNION ALL SELECT {_BAR_SQL} FROM bars b WHERE NOT (b.data_date = DATE '{_TODAY}'
      AND b.stock_code IN (SELECT stock_code FROM today))""",
)
def union_history_today(spark, d):
    size = F.col("p_size").cast("double")
    snapshot = views.table(spark, d, "part").groupBy(
        (F.col("p_partkey") % 40).cast("string").alias("stock_code")
    ).agg(
        F.min(size).alias("open_price"),
        F.max(size).alias("high_price"),
        F.min(size).alias("low_price"),
        F.max(size).alias("newest_deal_price"),
        F.count("*").alias("accumulation_volume"),
    )
    return ST.union_today(views.bars(spark, d), snapshot, _TODAY)


_OLD = """old AS (SELECT stock_code, company_name_ch, stock_class, stock_status, update_date FROM newest)"""


@query(
    "union_versions",
    f"""WITH {SECURITIES} SELECT DISTINCT stock_code, industry, stock_class FROM securities
    UNION SELECT DISTINCT CAST(s_suppkey AS STRING), 'SUPPLIER', 'OTC' FROM supplier""",
)
def union_versions(spark, d):
    old = views.securities(spark, d).select("stock_code", "industry", "stock_class")
    new = views.table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("stock_code"),
        F.lit("SUPPLIER").alias("industry"),
        F.lit("OTC").alias("stock_class"),
    )
    return ST.union_versions(old, new)


# ------------------------------------------------ versions and load chains
_LOAD_DAY = date(2021, 9, 23)
_SCD = f"""fresh AS (SELECT stock_code, company_name_ch, CASE WHEN CAST(stock_code AS BIGINT) % 4 = 0 THEN 'MOVED'
  ELSE stock_class END AS stock_class FROM newest),
versions AS (SELECT stock_code, company_name_ch, stock_class FROM old UNION
  SELECT stock_code, company_name_ch, stock_class FROM fresh),
changed AS (SELECT stock_code FROM versions GROUP BY stock_code HAVING count(*) > 1),
merged AS (SELECT stock_code, company_name_ch, stock_class, DATE '{_LOAD_DAY}' AS update_date, '1' AS stock_status
  FROM fresh UNION ALL SELECT stock_code, company_name_ch, stock_class, update_date, stock_status FROM old
  WHERE stock_code IN (SELECT stock_code FROM changed))"""


def _scd(spark, d):
    newest = J.rank_versions(views.securities(spark, d))
    old = newest.select("stock_code", "company_name_ch", "stock_class", "stock_status", "update_date")
    moved = F.when(F.col("stock_code").cast("bigint") % 4 == 0, "MOVED").otherwise(F.col("stock_class"))
    fresh = newest.select("stock_code", "company_name_ch", moved.alias("stock_class"))
    return V.scd_changed(old, fresh, _LOAD_DAY)


@query("scd_changed_securities", f"WITH {NEWEST}, {_OLD}, {_SCD} SELECT * FROM merged")
def scd_changed_securities(spark, d):
    return _scd(spark, d)


@query(
    "scd_mark_failed",
    f"""WITH {NEWEST}, {_OLD}, {_SCD} SELECT stock_code, company_name_ch, stock_class, update_date,
    CASE WHEN stock_code IN (SELECT CAST(s_suppkey AS STRING) FROM supplier) THEN '0' ELSE stock_status END
      AS stock_status FROM merged""",
)
def scd_mark_failed(spark, d):
    failed = views.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("stock_code"))
    return V.mark_failed(_scd(spark, d), failed)


_INVESTORS = dict(zip(("view", "signup", "purchase", "error", "click"), fv.MONEY_INVESTORS))
_PIVOT = ", ".join(
    f"CAST(sum(amount) FILTER (WHERE investor = '{name}') AS BIGINT) AS {name}" for name in fv.MONEY_INVESTORS
)


_MONEY_SQL = f"""WITH {SIGNED}, {NEWEST}, m AS (SELECT DISTINCT stock_code, stock_class FROM newest),
    e AS (SELECT stock_class, data_date, CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _INVESTORS.items())} END
      AS investor, n FROM signed JOIN m USING (stock_code)),
    i AS (SELECT * FROM e UNION ALL SELECT stock_class, data_date, 'buy_sell_diff_total', n FROM e),
    l AS (SELECT stock_class, data_date, investor, '買進金額' AS side, greatest(n, 0) AS amount FROM i
      UNION ALL SELECT stock_class, data_date, investor, '賣出金額', greatest(-n, 0) FROM i
      UNION ALL SELECT stock_class, data_date, investor, '買賣差額', n FROM i)
    SELECT data_date, stock_class, CASE side WHEN '買進金額' THEN 'buy_money_amount'
      WHEN '賣出金額' THEN 'sell_money_amount' ELSE 'diff_money_amount' END AS buy_sell_type,
      side AS buy_sell_type_ch, {_PIVOT} FROM l GROUP BY data_date, stock_class, side"""


def newest_markets(spark, d):
    return J.rank_versions(views.securities(spark, d)).select("stock_code", "stock_class").distinct()


def _money(spark, d):
    """Bought, sold and net amounts by market, day and investor."""
    # per stock, day and kind before the join, so that it moves sums instead of events
    amount = F.col("amount")
    daily = views.signed_flows(spark, d).groupBy("stock_code", "data_date", "event_type").agg(
        F.sum(F.greatest(amount, F.lit(0))).alias("buy"),
        F.sum(F.greatest(-amount, F.lit(0))).alias("sell"),
        F.sum(amount).alias("diff"),
    )
    names = F.create_map(*[F.lit(text) for pair in _INVESTORS.items() for text in pair])
    investors = F.explode(F.array(names[F.col("event_type")], F.lit("buy_sell_diff_total")))
    return (
        daily.join(newest_markets(spark, d), "stock_code")
        .select("stock_class", "data_date", investors.alias("investor"), "buy", "sell", "diff")
        .groupBy("stock_class", "data_date", "investor")
        .agg(F.sum("buy").alias("buy"), F.sum("sell").alias("sell"), F.sum("diff").alias("diff"))
    )


@query("reshape_transpose_money", _MONEY_SQL)
def reshape_transpose_money(spark, d):
    sides = dict(zip(("buy", "sell", "diff"), fv.MONEY_SIDES["OTC"]))
    return reshape.money_report(_money(spark, d).withColumnsRenamed(sides))


def _published_money(money, market):
    """Amounts as a market publishes them: numbered lines, subtotals among them, commas in numbers."""
    known = {name: number for number, name in enumerate(fv.MONEY_ROWS[market]) if name}
    lines = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    own = money.where(F.col("stock_class") == market).withColumn("line_no", lines[F.col("investor")])
    subtotals = [number for number, name in enumerate(fv.MONEY_ROWS[market]) if not name]
    more = F.filter(F.array(*[F.lit(number) for number in (*subtotals, 99)]), lambda x: F.col("line_no") == 1)
    rows = own.unionByName(own.withColumn("line_no", F.explode(more)))
    return rows.select(
        "data_date",
        "line_no",
        F.col("investor").alias(fv.MONEY_HEADING),
        *[F.format_number(name, 0).alias(side) for name, side in zip(("buy", "sell", "diff"), fv.MONEY_SIDES[market])],
    )


@query("market_money_load", _MONEY_SQL)
def market_money_load(spark, d):
    money = _money(spark, d)
    return loads.market_money({market: _published_money(money, market) for market in fv.MONEY_ROWS})


_FLOW_KINDS = {
    "foreign_investor": "foreign_investor_vol_amount",
    "foreign_investor_dealer": "foreign_investor_dealer_vol_amount",
    "investment_trust": "investment_trust_vol_amount",
    "dealer": "dealer_vol_amount",
    "dealer_hedge": "dealer_hedge_vol_amount",
}


@query(
    "market_flow_load",
    f"""WITH {FLOWS}, {NEWEST}, m AS (SELECT DISTINCT stock_code, stock_class FROM newest)
    SELECT stock_code, {", ".join(
        f"greatest({net}, 0) AS {kind}_buy_amount, greatest(-{net}, 0) AS {kind}_sell_amount, {net}"
        for kind, net in _FLOW_KINDS.items()
    )}, institutional_investors_vol_amount, data_date FROM flows JOIN m USING (stock_code)""",
)
def market_flow_load(spark, d):
    flows = views.flows(spark, d).join(newest_markets(spark, d), "stock_code")
    sides = {}
    for kind, net in _FLOW_KINDS.items():
        sides[f"{kind}_buy_amount"] = F.greatest(F.col(net), F.lit(0))
        sides[f"{kind}_sell_amount"] = F.greatest(-F.col(net), F.lit(0))
    whole = flows.withColumns(sides)

    def published(market):
        heading, *rest = fv.FLOW_HEADINGS[market].items()
        code = F.concat(F.lit('="'), "stock_code", F.lit('"'))
        numbers = [F.format_number(name, 0).alias(old) for old, name in rest]
        return whole.where(F.col("stock_class") == market).select(code.alias(heading[0]), *numbers, "data_date")

    return loads.market_flows({market: published(market) for market in fv.FLOW_HEADINGS}, F.col("data_date"))


_STAMP = datetime(2021, 9, 23, 13, 40, tzinfo=timezone.utc)
_SNAPSHOT = f"""full_quotes AS (SELECT c, ts, CASE WHEN c = '7' THEN NULL ELSE z END AS z, b, v FROM quotes),
priced AS (SELECT c AS stock_code, ts, concat('n', c) AS company_name,
  CASE WHEN z = '-' THEN split_part(b, '_', 1) ELSE z END AS price, b, v, CAST(split_part(b, '_', 1) AS DOUBLE) AS bid
  FROM full_quotes),
snapshot AS (SELECT stock_code, company_name, CAST(price AS DOUBLE) AS newest_deal_price, CAST(0 AS BIGINT) AS newest_volume,
  CAST(coalesce(nullif(v, '-'), '0') AS BIGINT) AS accumulation_volume, bid AS open_price, bid AS high_price,
  CAST(NULL AS DOUBLE) AS low_price, CAST(floor(bid) AS DOUBLE) AS yesterday_close_price,
  round_even((CAST(price AS DOUBLE) - floor(bid)) / nullif(floor(bid), 0) * 100 * 100, 0) / 100 AS price_change_ratio,
  TIMESTAMP '2021-09-23 13:40:00' AS insert_time, ts FROM priced)"""


def _raw_quotes(spark, d):
    """Quotes with all ten fields, as text and with missing markers."""
    bid = F.split_part("b", F.lit("_"), F.lit(1))
    return views.quotes(spark, d).select(
        "c",
        F.concat(F.lit("n"), "c").alias("n"),
        F.when(F.col("c") != "7", F.col("z")).alias("z"),
        F.lit("-").alias("tv"),
        "v",
        bid.alias("o"),
        bid.alias("h"),
        F.lit("-").alias("l"),
        F.floor(bid.cast("double")).cast("string").alias("y"),
        "b",
        "ts",
    )


_SNAPSHOT_NAMES = ", ".join(schemas.QUOTE_SNAPSHOT.fieldNames())


@query("quote_snapshot", f"WITH {QUOTES}, {_SNAPSHOT} SELECT ts, {_SNAPSHOT_NAMES} FROM snapshot")
def quote_snapshot(spark, d):
    rows = loads.quote_snapshot(_raw_quotes(spark, d), _STAMP, keep=["ts"])
    return rows.withColumn("insert_time", utc_wall(F.col("insert_time")))


@query(
    "eod_bar_from_snapshot",
    f"""WITH {QUOTES}, {_SNAPSHOT}, ranked AS (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY ts DESC) AS rn
      FROM snapshot)
    SELECT stock_code, DATE '2021-09-23' AS data_date, high_price, low_price, open_price,
      newest_deal_price AS close_price, accumulation_volume AS volume, CAST(NULL AS DOUBLE) AS adj_close_price
    FROM ranked WHERE rn = 1""",
)
def eod_bar_from_snapshot(spark, d):
    rows = loads.quote_snapshot(_raw_quotes(spark, d), _STAMP, keep=["ts"])
    stored = work_folder(spark, "stock_price")
    sinks.append(loads.eod_bar(loads.newest_quotes(rows, F.struct("ts")), date(2021, 9, 23)), stored)
    return readers.read_prices(spark, stored).select(*schemas.STOCK_PRICE.fieldNames())


@query(
    "industry_ratio_load",
    """WITH t AS (SELECT p_type, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS s,
      CAST(sum(p_size) AS BIGINT) AS i FROM part GROUP BY p_type)
    SELECT CASE i % 3 WHEN 0 THEN '大盤' ELSE '半導體類' END AS stock_industry, CAST(s AS DOUBLE) AS "PER",
      CAST(n AS DOUBLE) AS "yield", CAST(s - n AS DOUBLE) AS "PBR", '2021-08' AS data_year_month
    FROM t WHERE i % 3 < 2""",
)
def industry_ratio_load(spark, d):
    grouped = views.table(spark, d, "part").groupBy("p_type").agg(
        F.count("*").alias("n"), F.sum("p_size").alias("s")
    )
    place = (F.col("s") % 3).cast("int")
    names = F.array(F.lit("大 盤 "), F.lit("半導體類"), F.lit("註解"))
    report = grouped.select(
        F.element_at(names, place + 1).alias("P/E RATIO AND YIELD OF LISTED STOCKS"),
        F.col("s").cast("double").alias("Unnamed: 5"),
        F.col("n").cast("double").alias("Unnamed: 7"),
        (F.col("s") - F.col("n")).cast("double").alias("Unnamed: 9"),
        F.lit("x").alias("Unnamed: 10"),
    )
    return loads.industry_ratios(report, "2021-08")


@query(
    "fx_load",
    """SELECT CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE r_name END AS currency_type,
      CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE CAST(n_nationkey AS STRING) END AS bank_note_buying_rate,
      CAST(n_nationkey + 1 AS STRING) AS bank_note_selling_rate, CAST(n_nationkey + 2 AS STRING) AS spot_buying_rate,
      CAST(n_nationkey + 3 AS STRING) AS spot_selling_rate, DATE '2021-09-23' AS data_date
    FROM (SELECT n_nationkey, regexp_extract(r_name, '\\w+') AS r_name FROM nation
      JOIN region ON n_regionkey = r_regionkey) q""",
)
def fx_load(spark, d):
    n = F.col("n_nationkey")
    word = F.regexp_extract("r_name", r"\w+", 0)
    rows = views.table(spark, d, "nation").join(
        views.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    report = rows.select(
        F.when(n % 4 == 0, word).otherwise(F.concat(F.lit("x ("), word, F.lit(")"))).alias("幣別"),
        F.when(n % 3 == 0, "-").otherwise(n.cast("string")).alias("買入"),
        (n + 1).cast("string").alias("賣出"),
        (n + 2).cast("string").alias("即期買入"),
        (n + 3).cast("string").alias("即期賣出"),
        F.lit("查詢").alias("遠期匯率"),
    )
    return loads.fx_rates(report, date(2021, 9, 23))


@query(
    "monthly_revenue_load",
    """SELECT CAST(c_custkey AS STRING) AS stock_code, c_name AS company_name_ch, '2021-08' AS revenue_year_month,
      CAST(c_custkey % 5 AS DOUBLE) AS last_month_revenue_change_ratio, c_custkey * 2 AS last_month_gross_revenue,
      CAST(c_custkey % 7 AS DOUBLE) AS last_year_revenue_change_ratio, c_custkey * 3 AS last_year_gross_revenue,
      CAST(c_custkey AS DOUBLE) AS gross_revenue, CAST(c_custkey % 9 AS DOUBLE) AS prophase_revenue_change_ratio,
      c_custkey * 4 AS last_year_accumulation_revenue, c_custkey * 5 AS accumulation_revenue
    FROM customer WHERE c_custkey % 10 <> 0""",
)
def monthly_revenue_load(spark, d):
    key = F.col("c_custkey")
    report = views.table(spark, d, "customer").select(
        key.cast("string").alias("公司代號"),
        F.col("c_name").alias("公司名稱"),
        (key % 5).cast("double").alias("上月比較增減(%)"),
        (key * 2).alias("上月營收"),
        (key % 7).cast("double").alias("去年同月增減(%)"),
        (key * 3).alias("去年當月營收"),
        F.when(key % 10 == 0, "不適用").otherwise(key.cast("string")).alias("當月營收"),
        (key % 9).cast("double").alias("前期比較增減(%)"),
        (key * 4).alias("去年累計營收"),
        (key * 5).alias("當月累計營收"),
    )
    total = views.table(spark, d, "region").select(
        F.lit(fv.TOTAL_LABEL).alias("公司代號"), F.lit("1").alias("當月營收")
    )
    return loads.monthly_revenue(ST.union_all([report, total]), "2021-08")


_FLOW_NAMES = list(fv.FLOW_COLUMNS.values())[1:]


@query(
    "investor_flow_load",
    f"""SELECT lpad(CAST(c_custkey AS STRING), 6, '0') AS stock_code,
    {', '.join(f'c_custkey * {1000 + i} AS {name}' for i, name in enumerate(_FLOW_NAMES))},
    DATE '2021-09-23' AS data_date FROM customer""",
)
def investor_flow_load(spark, d):
    key = F.col("c_custkey")
    headings = list(fv.FLOW_COLUMNS)
    code = F.concat(F.lit('="'), F.lpad(key.cast("string"), 6, "0"), F.lit('"'))
    report = views.table(spark, d, "customer").select(
        code.alias(headings[0]),
        *[F.format_number(key * (1000 + i), 0).alias(name) for i, name in enumerate(headings[1:])],
    )
    return loads.investor_flows(report, date(2021, 9, 23))
