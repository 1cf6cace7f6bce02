"""Registry of queries and the SQL that states what each must return."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Catalog:
    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(run: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = run
            if sql is not None:
                self.sql[name] = sql
            return run

        return register


# Sums of doubles differ in their last bits between engines, so results are compared on
# a grid. Its steps are powers of two: prices are short decimal fractions, which often
# lie exactly between two steps of a decimal grid but never of a binary one.
GRID = 4096
FINE_GRID = 1 << 24


def on_grid(value: Column, grid: int = GRID) -> Column:
    return F.round(value * grid) / grid


def on_grid_sql(value: str, grid: int = GRID) -> str:
    return f"round(({value}) * {grid}) / {grid}"


def gridded(*names: str, grid: int = GRID) -> list[Column]:
    return [on_grid(F.col(name), grid).alias(name) for name in names]


def gridded_sql(*names: str, grid: int = GRID) -> str:
    return ", ".join(f"{on_grid_sql(name, grid)} AS {name}" for name in names)


AS_OF = "2024-01-30"

BARS = """bars AS (
SELECT code AS stock_code, d AS data_date,
       max(CASE WHEN ra = 1 THEN p END) AS open_price, max(p) AS high_price, min(p) AS low_price,
       max(CASE WHEN rz = 1 THEN p END) AS close_price, CAST(sum(q) AS BIGINT) AS volume
FROM (SELECT code, d, p, q,
             row_number() OVER (PARTITION BY code, d ORDER BY ok, ln, pk, p, q) AS ra,
             row_number() OVER (PARTITION BY code, d
                                ORDER BY ok DESC, ln DESC, pk DESC, p DESC, q DESC) AS rz
      FROM (SELECT CAST(CAST(floor(l_suppkey / 20.0) AS BIGINT) AS STRING) AS code,
                   CAST(l_shipdate AS DATE) AS d, l_orderkey AS ok, l_linenumber AS ln,
                   l_partkey AS pk, l_quantity AS q, l_extendedprice / l_quantity AS p
            FROM lineitem) x) y
GROUP BY code, d)"""

SIGNED = """signed AS (
SELECT CAST(user_id AS STRING) AS stock_code, CAST(ts AS DATE) AS data_date, event_type,
       CAST(round(value * 100) AS BIGINT) * (CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END) AS n
FROM events)"""

FLOWS = SIGNED + """, flows AS (
SELECT stock_code, data_date,
  CAST(sum(CASE WHEN event_type = 'view' THEN n ELSE 0 END) AS BIGINT) AS foreign_investor_vol_amount,
  CAST(sum(CASE WHEN event_type = 'signup' THEN n ELSE 0 END) AS BIGINT)
    AS foreign_investor_dealer_vol_amount,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN n ELSE 0 END) AS BIGINT) AS investment_trust_vol_amount,
  CAST(sum(CASE WHEN event_type = 'error' THEN n ELSE 0 END) AS BIGINT) AS dealer_vol_amount,
  CAST(sum(CASE WHEN event_type = 'click' THEN n ELSE 0 END) AS BIGINT) AS dealer_hedge_vol_amount,
  CAST(sum(n) AS BIGINT) AS institutional_investors_vol_amount
FROM signed GROUP BY stock_code, data_date)"""

SECURITIES = """securities AS (
SELECT CAST(c_custkey AS STRING) AS stock_code, c_name AS company_name_ch, c_mktsegment AS industry,
       CASE WHEN c_custkey % 50 = 0 THEN 0
            ELSE CAST(round(abs(c_acctbal) * 1000) AS BIGINT) END AS company_capital,
       CASE WHEN c_custkey % 2 = 0 THEN 'TWSE' ELSE 'OTC' END AS stock_class,
       o_orderstatus AS stock_status, CAST(o_orderdate AS DATE) AS update_date
FROM customer JOIN orders ON c_custkey = o_custkey)"""

NEWEST = SECURITIES + """, newest AS (
SELECT s.* FROM securities s,
  (SELECT stock_code, max(update_date) AS newest_update_date FROM securities GROUP BY stock_code) m
WHERE s.stock_code = m.stock_code AND s.update_date = m.newest_update_date)"""

HOLIDAYS = """holidays AS (
SELECT n_name AS holiday_name, DATE '1995-01-02' + n_nationkey * 97 AS holiday_start,
       DATE '1995-01-02' + (n_nationkey * 97 + n_nationkey % 5) AS holiday_end
FROM nation
UNION ALL SELECT concat('late ', n_name), make_date(1992 + n_nationkey, 12, 30), make_date(1993 + n_nationkey, 1, 2)
FROM nation WHERE n_nationkey < 7
UNION ALL SELECT concat('new ', n_name), make_date(1993 + n_nationkey, 1, 1), make_date(1993 + n_nationkey, 1, 3)
FROM nation WHERE n_nationkey < 7
UNION ALL SELECT concat('odd ', n_name), DATE '1992-03-05' + n_nationkey * 89, DATE '1992-03-02' + n_nationkey * 89
FROM nation WHERE n_nationkey % 3 = 0)"""

REVENUE = """revenue AS (
SELECT CAST(o_custkey AS STRING) AS stock_code, year(o_orderdate) * 100 + month(o_orderdate) AS ym,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS gross_revenue
FROM orders GROUP BY CAST(o_custkey AS STRING), year(o_orderdate) * 100 + month(o_orderdate))"""

QUOTES = """quotes AS (
SELECT CAST(user_id AS STRING) AS c, ts,
       CASE WHEN event_type = 'error' THEN '-' ELSE CAST(value AS STRING) END AS z,
       concat(CAST(value AS STRING), '_', CAST(event_id AS STRING), '_') AS b,
       CASE WHEN event_type = 'signup' THEN '-' ELSE CAST(event_id AS STRING) END AS v
FROM events)"""
