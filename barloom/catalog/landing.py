"""Whole loads: from reports and feeds as published to the stored tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from barloom import fixed_values as fv
from barloom.catalog.base import BARS, Catalog, NEWEST
from barloom.catalog.cleaning import company_list
from barloom.catalog.tables import newest_markets
from barloom.functions.labels import price_symbol
from barloom.plans import loads, views
from barloom.session import work_folder
from barloom.sources import versions

catalog = Catalog()
query = catalog.query

_FIRST, _SECOND = date(2021, 9, 17), date(2021, 9, 24)
_MASTER = """{name} AS (SELECT CAST(c_custkey AS STRING) AS stock_code, c_name AS company_name, c_name AS company_name_ch,
  upper(c_name) AS company_name_en, {industry} AS industry,
  make_date(1950 + c_custkey % 50, 1 + c_custkey % 12, 1 + c_custkey % 28) AS establishment_date,
  make_date(1970 + c_custkey % 50, 1 + c_custkey % 12, 1 + c_custkey % 28) AS listed_date,
  CAST(round(abs(c_acctbal) * 1000) AS BIGINT) AS company_capital, c_custkey * 10 AS outstanding_principal,
  CAST(0 AS BIGINT) AS private_equity, CAST(0 AS BIGINT) AS preferred_stock,
  concat('http://', CAST(c_custkey AS STRING), '.example') AS company_url,
  CASE WHEN c_custkey % 2 = 0 THEN 'TWSE' ELSE 'OTC' END AS stock_class,
  CASE WHEN c_custkey % 2 = 0 THEN '上市' ELSE '上櫃' END AS stock_class_ch,
  DATE '{day}' AS update_date, '1' AS stock_status FROM customer WHERE {where})"""
_OLD = _MASTER.format(name="old", industry="c_mktsegment", day=_FIRST, where="c_custkey % 11 <> 0")
_NEW = _MASTER.format(
    name="fresh",
    industry="CASE WHEN c_custkey % 5 = 0 THEN 'MOVED' ELSE c_mktsegment END",
    day=_SECOND,
    where="c_custkey % 13 <> 0",
)


def _reports(spark, d, second=False):
    """Company lists of both markets as published on one of two days."""
    key, industry = F.col("公司代號").try_cast("long"), F.col("產業類別")

    def published(market):
        rows = company_list(spark, d, market)
        if not second:
            return rows.where(key.isNull() | (key % 11 != 0))
        moved = rows.withColumn("產業類別", F.when(key % 5 == 0, "MOVED").otherwise(industry))
        return moved.where(key.isNull() | (key % 13 != 0))

    return {market: published(market) for market in fv.MARKET_NAMES}


@query("master_load", f"WITH {_OLD} SELECT * FROM old")
def master_load(spark, d):
    return loads.master_load(_reports(spark, d), _FIRST)


@query(
    "master_refresh",
    f"""WITH {_OLD}, {_NEW}, changed AS (SELECT o.stock_code FROM old o JOIN fresh f USING (stock_code)
      WHERE o.industry <> f.industry),
    merged AS (SELECT * FROM fresh UNION ALL SELECT * FROM old WHERE stock_code IN (SELECT stock_code FROM changed))
    SELECT * REPLACE (CASE WHEN stock_code IN (SELECT CAST(s_suppkey AS STRING) FROM supplier) THEN '0'
      ELSE stock_status END AS stock_status) FROM merged""",
)
def master_refresh(spark, d):
    table = work_folder(spark, "securities")
    none = spark.createDataFrame([], "stock_code string")
    loads.refresh_master(table, loads.master_load(_reports(spark, d), _FIRST), none, _FIRST)
    failed = views.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("stock_code"))
    loads.refresh_master(table, loads.master_load(_reports(spark, d, second=True), _SECOND), failed, _SECOND)
    return versions.read(spark, table)


def _feed(bars, symbol):
    """Bars as a price feed gives them, every row twice."""
    noon = F.concat(F.date_format("data_date", "yyyy-MM-dd"), F.lit(" 12:30:00")).cast("timestamp_ntz")
    rows = bars.select(
        symbol.alias("Symbol"),
        noon.alias("Date"),
        F.col("high_price").alias("High"),
        F.col("low_price").alias("Low"),
        F.col("open_price").alias("Open"),
        F.col("close_price").alias("Close"),
        F.col("volume").alias("Volume"),
        F.col("close_price").alias("Adj Close"),
    )
    return rows.unionAll(rows)


_FEED_SQL = "data_date, high_price, low_price, open_price, close_price, volume, close_price AS adj_close_price"


@query(
    "price_load",
    f"""WITH {BARS}, {NEWEST}, m AS (SELECT DISTINCT stock_code, stock_class FROM newest)
    SELECT stock_code, {_FEED_SQL}, false AS failed FROM bars JOIN m USING (stock_code)
    UNION ALL SELECT stock_code, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true FROM m
    WHERE stock_code NOT IN (SELECT stock_code FROM bars)""",
)
def price_load(spark, d):
    markets = newest_markets(spark, d)
    bars = views.bars(spark, d).join(markets, "stock_code")
    feed = _feed(bars, price_symbol(F.col("stock_code"), F.col("stock_class")))
    prices, failed = loads.price_load(feed, markets)
    marked = failed.withColumn("failed", F.lit(True))
    return prices.withColumn("failed", F.lit(False)).unionByName(marked, allowMissingColumns=True)


@query("index_load", f"WITH {BARS} SELECT concat('I', stock_code) AS stock_code, {_FEED_SQL} FROM bars")
def index_load(spark, d):
    caret = F.when(F.col("stock_code").cast("int") % 2 == 0, "^I").otherwise("I")
    return loads.index_load(_feed(views.bars(spark, d), F.concat(caret, "stock_code")))


@query(
    "cash_flow_load",
    """SELECT CAST(c_custkey AS STRING) AS stock_code, '2021Q2' AS cash_flows_year,
    CAST(round(c_acctbal * 100) AS BIGINT) AS operating_cash_flows, -c_custkey * 1000 AS investing_cash_flows,
    c_custkey * 2000 AS financing_cash_flows, CAST(3 AS BIGINT) AS others_cash_flows, c_custkey AS net_cash_flow,
    CAST(round(c_acctbal * 100) AS BIGINT) - c_custkey * 1000 AS free_cash_flow, CAST(5 AS BIGINT) AS beginning_balance,
    c_custkey + 5 AS ending_balance FROM customer""",
)
def cash_flow_load(spark, d):
    key = F.col("c_custkey")
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    figures = [cents, -key * 1000, key * 2000, F.lit(3), key, F.lit(0), F.lit(5), key + 5]
    texts = [F.format_number(figure, 0).alias(f"c{i}") for i, figure in enumerate(figures)]
    report = views.table(spark, d, "customer").select(
        key.cast("string").alias(fv.CODE_HEADING), F.col("c_name").alias("公司名稱"), *texts
    )
    return loads.cash_flow_report(report, "2021Q2")
