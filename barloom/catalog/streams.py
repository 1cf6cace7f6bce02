"""Streaming queries, run to the end of the available input."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from barloom import schemas
from barloom.catalog.base import Catalog, QUOTES
from barloom.functions.dates import utc_wall
from barloom.plans import views
from barloom.session import work_folder
from barloom.sources import readers
from barloom.streaming import late as L, quotes as Q

catalog = Catalog()
query = catalog.query

_TYPED = f"""{QUOTES}, typed AS (SELECT c AS stock_code, ts,
  CAST(CASE WHEN z = '-' THEN split_part(b, '_', 1) ELSE z END AS DOUBLE) AS price,
  CAST(nullif(v, '-') AS BIGINT) AS volume FROM quotes)"""
# windows still open when the input ends are not in the result
_CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"
_OHLC = """max(price) AS high_price, min(price) AS low_price, arg_min(price, ts) AS open_price,
arg_max(price, ts) AS close_price, max(volume) AS volume"""


def _event_stream(spark, d):
    schema = views.table(spark, d, "events").schema
    return views.quotes_of(Q.read_stream(spark, d, schema, pathGlobFilter="events.parquet"))


def _finish(spark, stream, name):
    out, checkpoint = work_folder(spark, name), work_folder(spark, f"{name}-state")
    Q.run_to_table(stream, out, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


_STAMP = datetime(2021, 9, 23, 13, 40, tzinfo=timezone.utc)


@query(
    "stream_quote_snapshot",
    f"""WITH {_TYPED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY ts DESC) AS rn FROM typed)
    SELECT stock_code, CAST(NULL AS STRING) AS company_name, price AS newest_deal_price, CAST(0 AS BIGINT) AS newest_volume,
      coalesce(volume, 0) AS accumulation_volume, CAST(NULL AS DOUBLE) AS open_price, CAST(NULL AS DOUBLE) AS high_price,
      CAST(NULL AS DOUBLE) AS low_price, CAST(NULL AS DOUBLE) AS yesterday_close_price,
      CAST(NULL AS DOUBLE) AS price_change_ratio, TIMESTAMP '2021-09-23 13:40:00' AS insert_time FROM ranked WHERE rn = 1""",
)
def stream_quote_snapshot(spark, d):
    raw = _event_stream(spark, d)
    missing = [name for name in schemas.RAW_QUOTE.fieldNames() if name not in raw.columns]
    full = raw.withColumns({name: F.lit(None).cast("string") for name in missing})
    table, checkpoint = work_folder(spark, "snapshot"), work_folder(spark, "snapshot-state")
    Q.stream_snapshot(full, table, checkpoint, ts=_STAMP, trigger=Q.AVAILABLE).awaitTermination()
    newest = Q.read_snapshot(spark, table).drop("ts")
    return newest.withColumn("insert_time", utc_wall(F.col("insert_time")))


@query(
    "stream_session_close",
    f"""WITH {_TYPED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY ts DESC) AS rn FROM typed
      WHERE CAST(ts AS TIME) BETWEEN TIME '09:00:00' AND TIME '13:40:00')
    SELECT stock_code, DATE '2024-01-30' AS data_date, CAST(NULL AS DOUBLE) AS high_price, CAST(NULL AS DOUBLE) AS low_price,
      CAST(NULL AS DOUBLE) AS open_price, price AS close_price, coalesce(volume, 0) AS volume,
      CAST(NULL AS DOUBLE) AS adj_close_price FROM ranked WHERE rn = 1 AND CAST(ts AS DATE) = '2024-01-30'""",
)
def stream_session_close(spark, d):
    raw = _event_stream(spark, d)
    missing = [name for name in schemas.RAW_QUOTE.fieldNames() if name not in raw.columns]
    full = raw.withColumns({name: F.lit(None).cast("string") for name in missing})
    table, prices = work_folder(spark, "snapshot"), work_folder(spark, "stock_price")
    stream = Q.stream_snapshot(
        full, table, work_folder(spark, "snapshot-state"), ts=_STAMP, trigger=Q.AVAILABLE, session_only=True
    )
    stream.awaitTermination()
    Q.close_day(spark, table, prices, date(2024, 1, 30))
    return readers.read_prices(spark, prices, date(2024, 1, 30), date(2024, 1, 30)).drop("data_year")


@query(
    "stream_eod_close",
    f"""WITH {_TYPED}, day AS (SELECT *, CAST(ts AS DATE) AS data_date FROM typed)
    SELECT stock_code, data_date, {_OHLC}, CAST(NULL AS DOUBLE) AS adj_close_price FROM day
    WHERE data_date + INTERVAL 1 DAY <= {_CLOSED} GROUP BY stock_code, data_date""",
)
def stream_eod_close(spark, d):
    return _finish(spark, Q.stream_eod(Q.typed_quotes(_event_stream(spark, d))), "eod")


@query(
    "stream_bars_tumbling",
    f"""WITH {_TYPED}, w AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start FROM typed)
    SELECT stock_code, window_start, {_OHLC} FROM w
    WHERE window_start + INTERVAL 5 MINUTE <= {_CLOSED} GROUP BY stock_code, window_start""",
)
def stream_bars_tumbling(spark, d):
    return _finish(spark, Q.stream_bars(Q.typed_quotes(_event_stream(spark, d))), "bars")


@query(
    "stream_bars_corrected",
    f"""WITH {_TYPED}, w AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start FROM typed)
    SELECT stock_code, window_start, {_OHLC} FROM w
    WHERE window_start + INTERVAL 5 MINUTE <= {_CLOSED} GROUP BY stock_code, window_start""",
)
def stream_bars_corrected(spark, d):
    # the quotes of every fifth event land later than all others
    landed, folder = work_folder(spark, "landed"), work_folder(spark, "late")
    events = views.table(spark, d, "events")
    for late in (False, True):
        events.where((F.col("event_id") % 5 == 0) == F.lit(late)).write.mode("append").parquet(landed)
        quotes = Q.typed_quotes(views.quotes_of(Q.read_stream(spark, landed, events.schema)))
        L.stream(quotes, folder, f"{folder}/state").awaitTermination()
    L.correct(spark, folder)
    return L.read_bars(spark, folder)


@query("stream_dedup", f"WITH {_TYPED} SELECT DISTINCT stock_code, ts, price, volume FROM typed")
def stream_dedup(spark, d):
    # every quote is polled twice
    polls = F.explode(F.array(F.lit(1), F.lit(2)))
    polled = Q.typed_quotes(_event_stream(spark, d)).select("*", polls.alias("poll")).drop("poll")
    once = _finish(spark, Q.stream_dedup(polled, ("stock_code", "ts", "price", "volume")), "dedup")
    return once.withColumn("ts", utc_wall(F.col("ts")))
