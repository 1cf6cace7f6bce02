"""Bars, flows and indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom import fixed_values as fv
from barloom.catalog.base import AS_OF, BARS, Catalog, FLOWS, NEWEST, REVENUE, SECURITIES, gridded, gridded_sql, on_grid, on_grid_sql
from barloom.operators import bars as B, filters, flows as FL, indicators as I, refresh as R, sets, signals as S
from barloom.plans import views
from barloom.plans.screen import screen
from barloom.session import work_folder

catalog = Catalog()
query = catalog.query

_OHLC = """max(high_price) AS high_price, min(low_price) AS low_price,
  arg_min(open_price, data_date) FILTER (WHERE open_price IS NOT NULL) AS open_price,
  arg_max(close_price, data_date) FILTER (WHERE close_price IS NOT NULL) AS close_price,
  CAST(coalesce(sum(volume), 0) AS BIGINT) AS volume"""

_WEEKLY = """weekly AS (
SELECT *, CAST(isoyear(data_date) AS STRING) AS data_year, CAST(weekofyear(data_date) AS INTEGER) AS week_num,
  CAST(date_trunc('week', data_date) AS DATE) AS week_start_date,
  CAST(date_trunc('week', data_date) AS DATE) + 4 AS week_end_date
FROM bars)"""
_WEEK_KEYS = "stock_code, data_year, week_num, week_start_date, week_end_date"


@query("bars_week", f"WITH {BARS}, {_WEEKLY} SELECT {_WEEK_KEYS}, {_OHLC} FROM weekly GROUP BY {_WEEK_KEYS}")
def bars_week(spark, d):
    return B.bars_week(views.bars(spark, d))


@query(
    "bars_month",
    f"""WITH {BARS} SELECT stock_code, strftime(data_date, '%Y-%m') AS data_year_month,
    min(data_date) AS month_start_date, max(data_date) AS month_end_date, {_OHLC}
    FROM bars GROUP BY stock_code, strftime(data_date, '%Y-%m')""",
)
def bars_month(spark, d):
    return B.bars_month(views.bars(spark, d))


@query(
    "bars_multi_grain",
    f"""WITH {BARS}, m AS (SELECT *, strftime(date_trunc('week', data_date), '%Y-%m-%d') AS week,
      strftime(data_date, '%Y-%m') AS month FROM bars)
    SELECT stock_code, 'week' AS grain, week AS period, {_OHLC} FROM m GROUP BY stock_code, week
    UNION ALL SELECT stock_code, 'month', month, {_OHLC} FROM m GROUP BY stock_code, month
    UNION ALL SELECT stock_code, 'all', 'all', {_OHLC} FROM m GROUP BY stock_code""",
)
def bars_multi_grain(spark, d):
    return B.bars_multi(views.bars(spark, d))


@query(
    "bars_nullskip_first_last",
    f"""WITH {BARS}, h AS (SELECT stock_code, date_trunc('month', data_date) AS m, data_date,
      CASE WHEN volume % 3 = 0 THEN NULL ELSE close_price END AS close_price FROM bars)
    SELECT stock_code, strftime(m, '%Y-%m') AS month,
      arg_min(close_price, data_date) FILTER (WHERE close_price IS NOT NULL) AS first_close_price,
      arg_max(close_price, data_date) FILTER (WHERE close_price IS NOT NULL) AS last_close_price
    FROM h GROUP BY stock_code, m""",
)
def bars_nullskip(spark, d):
    holed = views.bars(spark, d).select(
        "stock_code",
        "data_date",
        F.date_format("data_date", "yyyy-MM").alias("month"),
        F.when(F.col("volume") % 3 != 0, F.col("close_price")).alias("close_price"),
    )
    return B.first_last_nonnull(holed, ["stock_code", "month"], "close_price", "data_date")


@query(
    "join_left_chain",
    f"""WITH {BARS}, {_WEEKLY},
    h AS (SELECT {_WEEK_KEYS}, max(high_price) AS high_price FROM weekly GROUP BY {_WEEK_KEYS}),
    l AS (SELECT {_WEEK_KEYS}, min(low_price) AS low_price FROM weekly GROUP BY {_WEEK_KEYS}),
    v AS (SELECT {_WEEK_KEYS}, CAST(sum(volume) AS BIGINT) AS volume FROM weekly GROUP BY {_WEEK_KEYS})
    SELECT {_WEEK_KEYS}, high_price, low_price, volume, open_price, close_price
    FROM h LEFT JOIN l USING ({_WEEK_KEYS}) LEFT JOIN v USING ({_WEEK_KEYS})
    LEFT JOIN (SELECT {_WEEK_KEYS}, arg_min(open_price, data_date) AS open_price FROM weekly GROUP BY {_WEEK_KEYS}) o
      USING ({_WEEK_KEYS})
    LEFT JOIN (SELECT {_WEEK_KEYS}, arg_max(close_price, data_date) AS close_price FROM weekly GROUP BY {_WEEK_KEYS}) c
      USING ({_WEEK_KEYS})""",
)
def join_left_chain(spark, d):
    keys = [k.strip() for k in _WEEK_KEYS.split(",")]
    # one aggregate frame per measure, joined, as the check of the one-pass form
    weekly = B.bars_week(views.bars(spark, d))
    return B.join_aggs([weekly.select(*keys, name) for name in _MEASURES], keys)


_MONTH_KEYS = "stock_code, data_year_month, month_start_date, month_end_date"
_MEASURES = ("high_price", "low_price", "volume", "open_price", "close_price")


@query(
    "join_left_chain_month",
    f"""WITH {BARS} SELECT stock_code, strftime(data_date, '%Y-%m') AS data_year_month, min(data_date) AS month_start_date,
    max(data_date) AS month_end_date, max(high_price) AS high_price, min(low_price) AS low_price,
    CAST(sum(volume) AS BIGINT) AS volume, arg_min(open_price, data_date) AS open_price,
    arg_max(close_price, data_date) AS close_price FROM bars GROUP BY stock_code, strftime(data_date, '%Y-%m')""",
)
def join_left_chain_month(spark, d):
    keys = _MONTH_KEYS.split(", ")
    monthly = B.bars_month(views.bars(spark, d))
    return B.join_aggs([monthly.select(*keys, name) for name in _MEASURES], keys)


# ------------------------------------------------------------------ flows
_RECENT = f"recent AS (SELECT * FROM flows WHERE data_date >= DATE '{AS_OF}' - 3)"
_SUMS = ", ".join(f"sum({n}) / 1000 AS {n}" for n in fv.FLOW_VOLUMES)


@query("flow_sum_recent", f"WITH {FLOWS}, {_RECENT} SELECT stock_code, {_SUMS} FROM recent GROUP BY stock_code")
def flow_sum_recent(spark, d):
    return FL.flow_sums(views.flows(spark, d), AS_OF)


_RATIOS = ", ".join(
    f"({n} / nullif(cap, 0)) * 1000 AS {n.replace('_vol_amount', '_ratio')}" for n in fv.FLOW_VOLUMES
)
_RATIO_SQL = f"""SELECT a.stock_code, company_name_ch, {_RATIOS}
FROM (SELECT stock_code, company_name_ch, company_capital / 1000 AS cap FROM {{base}}) a
LEFT JOIN (SELECT stock_code, {_SUMS} FROM recent GROUP BY stock_code) b ON a.stock_code = b.stock_code"""


@query("flow_ratio", f"WITH {FLOWS}, {_RECENT}, {NEWEST} {_RATIO_SQL.format(base='newest')}")
def flow_ratio(spark, d):
    return FL.flow_ratio(views.securities(spark, d), views.flows(spark, d), AS_OF)


@query("flow_ratio_all_versions", f"WITH {FLOWS}, {_RECENT}, {SECURITIES} {_RATIO_SQL.format(base='securities')}")
def flow_ratio_raw(spark, d):
    return FL.flow_ratio(views.securities(spark, d), views.flows(spark, d), AS_OF, newest=False)


_CLASSES = """classes AS (SELECT stock_code, data_date,
  foreign_investor_dealer_vol_amount + foreign_investor_vol_amount AS foreign_investor,
  investment_trust_vol_amount AS investment_trust,
  dealer_vol_amount + dealer_hedge_vol_amount AS dealer,
  institutional_investors_vol_amount AS institutional_investors FROM {base})"""
_COUNTS = ", ".join(
    f"CAST(sum(CASE WHEN {n} > 0 THEN 1 ELSE 0 END) AS BIGINT) AS {n}_buy_count" for n in FL.INVESTOR_CLASSES
)
_ANY3 = " OR ".join(f"sum(CASE WHEN {n} > 0 THEN 1 ELSE 0 END) = 3" for n in FL.INVESTOR_CLASSES)
_POSITIVE = f"SELECT stock_code, {_COUNTS} FROM classes GROUP BY stock_code"


@query(
    "flow_positive_days",
    f"WITH {FLOWS}, {_RECENT}, {_CLASSES.format(base='recent')} {_POSITIVE} HAVING {_ANY3}",
)
def flow_positive_days(spark, d):
    return FL.flow_positive_days(views.flows(spark, d), AS_OF)


@query("case_in_filter", f"WITH {FLOWS}, {_CLASSES.format(base='flows')} {_POSITIVE}")
def case_in_filter(spark, d):
    return FL.count_positive(views.flows(spark, d))


@query(
    "filter_having",
    f"WITH {FLOWS}, {_CLASSES.format(base='flows')} {_POSITIVE} HAVING "
    + " OR ".join(f"sum(CASE WHEN {n} > 0 THEN 1 ELSE 0 END) = 10" for n in FL.INVESTOR_CLASSES),
)
def filter_having(spark, d):
    counts = FL.count_positive(views.flows(spark, d))
    return filters.having_any(counts, [f"{n}_buy_count" for n in FL.INVESTOR_CLASSES], 10)


_STREAKS = ", ".join(
    f"""rn - coalesce(max(CASE WHEN {n} > 0 THEN NULL ELSE rn END)
    OVER (PARTITION BY stock_code ORDER BY rn ROWS UNBOUNDED PRECEDING), 0) AS {n}_streak"""
    for n in FL.INVESTOR_CLASSES
)


@query(
    "flow_streak",
    f"""WITH {FLOWS}, {_CLASSES.format(base='flows')},
    num AS (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY data_date) AS rn FROM classes),
    s AS (SELECT stock_code, data_date, {_STREAKS} FROM num)
    SELECT * FROM s WHERE greatest({', '.join(n + '_streak' for n in FL.INVESTOR_CLASSES)}) >= 3""",
)
def flow_streak(spark, d):
    return FL.flow_streak(views.flows(spark, d))


# ------------------------------------------------------------- indicators
_NUM = """num AS (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY data_date) AS rn FROM bars)"""


def _w(n: int) -> str:
    return f"OVER (PARTITION BY stock_code ORDER BY rn ROWS {n - 1} PRECEDING)"


_MA = {
    n: f"CASE WHEN rn >= {n} THEN avg(close_price) {_w(n)} END" for n in fv.SMA_PERIODS
}
_BAND = f"""CASE WHEN rn >= 20 THEN avg(close_price) {_w(20)} END AS middle,
CASE WHEN rn >= 20 THEN stddev_pop(close_price) {_w(20)} * 2.1 END AS spread"""

_MACD = f"""mseed AS (SELECT stock_code, avg(close_price) FILTER (WHERE rn BETWEEN 15 AND 26) AS f,
    avg(close_price) FILTER (WHERE rn <= 26) AS s FROM num GROUP BY stock_code HAVING count(*) >= 26),
mlines AS (SELECT stock_code, CAST(26 AS BIGINT) AS rn, f, s FROM mseed
  UNION ALL SELECT b.stock_code, b.rn, l.f + (b.close_price - l.f) * (2e0 / 13),
    l.s + (b.close_price - l.s) * (2e0 / 27)
  FROM mlines l JOIN num b ON b.stock_code = l.stock_code AND b.rn = l.rn + 1),
gseed AS (SELECT stock_code, avg(f - s) AS g FROM mlines WHERE rn <= 34 GROUP BY stock_code
  HAVING count(*) = 9),
glines AS (SELECT stock_code, CAST(34 AS BIGINT) AS rn, g FROM gseed
  UNION ALL SELECT b.stock_code, b.rn, l.g + ((b.f - b.s) - l.g) * (2e0 / 10)
  FROM glines l JOIN mlines b ON b.stock_code = l.stock_code AND b.rn = l.rn + 1),
macd AS (SELECT m.stock_code, m.rn, f - s AS "MACD", g AS "MACDsignal", f - s - g AS "MACDhist"
  FROM mlines m JOIN glines g ON g.stock_code = m.stock_code AND g.rn = m.rn)"""

_STOCH = f"""fk AS (SELECT stock_code, rn, CASE WHEN hh = ll THEN 0 ELSE (close_price - ll) / (hh - ll) * 100 END AS x
  FROM (SELECT stock_code, rn, close_price, min(low_price) {_w(9)} AS ll, max(high_price) {_w(9)} AS hh
        FROM num) q WHERE rn >= 9),
kl AS (SELECT stock_code, CAST(11 AS BIGINT) AS rn, avg(x) AS k FROM fk WHERE rn <= 11 GROUP BY stock_code
  HAVING count(*) = 3
  UNION ALL SELECT b.stock_code, b.rn, l.k + (b.x - l.k) * 5e-1
  FROM kl l JOIN fk b ON b.stock_code = l.stock_code AND b.rn = l.rn + 1),
dl AS (SELECT stock_code, CAST(13 AS BIGINT) AS rn, avg(k) AS d FROM kl WHERE rn <= 13 GROUP BY stock_code
  HAVING count(*) = 3
  UNION ALL SELECT b.stock_code, b.rn, l.d + (b.k - l.d) * 5e-1
  FROM dl l JOIN kl b ON b.stock_code = l.stock_code AND b.rn = l.rn + 1),
kd AS (SELECT k.stock_code, k.rn, k, d FROM kl k JOIN dl e ON e.stock_code = k.stock_code AND e.rn = k.rn)"""

_RSI = """mv AS (SELECT stock_code, rn, close_price - lag(close_price) OVER (PARTITION BY stock_code ORDER BY rn) AS m
  FROM num),
rl AS (SELECT stock_code, CAST(15 AS BIGINT) AS rn, avg(greatest(m, 0)) AS g, avg(greatest(-m, 0)) AS l
  FROM mv WHERE rn BETWEEN 2 AND 15 GROUP BY stock_code HAVING count(*) = 14
  UNION ALL SELECT b.stock_code, b.rn, (p.g * 13 + greatest(b.m, 0)) / 14, (p.l * 13 + greatest(-b.m, 0)) / 14
  FROM rl p JOIN mv b ON b.stock_code = p.stock_code AND b.rn = p.rn + 1),
rsi AS (SELECT stock_code, rn, CASE WHEN g + l < 1e-14 THEN 0 ELSE 100 * g / (g + l) END AS rsi FROM rl)"""


@query(
    "ind_sma",
    f"WITH {BARS}, {_NUM} SELECT stock_code, data_date, close_price, "
    + ", ".join(f"{on_grid_sql(value)} AS ma{n}" for n, value in _MA.items())
    + " FROM num",
)
def ind_sma(spark, d):
    names = [f"ma{n}" for n in fv.SMA_PERIODS]
    return I.sma(views.stored_bars(spark, d)).select("stock_code", "data_date", "close_price", *gridded(*names))


@query(
    "ind_bbands",
    f"""WITH {BARS}, {_NUM}, b AS (SELECT *, {_BAND} FROM num)
    SELECT stock_code, data_date, {on_grid_sql('middle + spread')} AS upper, {on_grid_sql('middle')} AS middle,
      {on_grid_sql('middle - spread')} AS lower FROM b""",
)
def ind_bbands(spark, d):
    lines = I.bbands(views.stored_bars(spark, d))
    return lines.select("stock_code", "data_date", *gridded("upper", "middle", "lower"))


@query(
    "ind_stoch",
    f"""WITH RECURSIVE {BARS}, {_NUM}, {_STOCH}
    SELECT n.stock_code, data_date, {gridded_sql('k', 'd')} FROM num n
    LEFT JOIN kd ON kd.stock_code = n.stock_code AND kd.rn = n.rn""",
)
def ind_stoch(spark, d):
    return I.stoch(views.stored_bars(spark, d)).select("stock_code", "data_date", *gridded("k", "d"))


_MACD_NAMES = ("MACD", "MACDsignal", "MACDhist")


@query(
    "ind_macd",
    f"""WITH RECURSIVE {BARS}, {_NUM}, {_MACD}
    SELECT n.stock_code, data_date, {gridded_sql(*_MACD_NAMES)} FROM num n
    LEFT JOIN macd m ON m.stock_code = n.stock_code AND m.rn = n.rn""",
)
def ind_macd(spark, d):
    return I.macd(views.stored_bars(spark, d)).select("stock_code", "data_date", *gridded(*_MACD_NAMES))


@query(
    "ind_ema",
    f"""WITH RECURSIVE {BARS}, {_NUM},
    e AS (SELECT stock_code, CAST(26 AS BIGINT) AS rn, avg(close_price) AS ema26 FROM num WHERE rn <= 26
      GROUP BY stock_code HAVING count(*) = 26
      UNION ALL SELECT b.stock_code, b.rn, l.ema26 + (b.close_price - l.ema26) * (2e0 / 27)
      FROM e l JOIN num b ON b.stock_code = l.stock_code AND b.rn = l.rn + 1)
    SELECT n.stock_code, data_date, {on_grid_sql('ema26')} AS ema26 FROM num n
    LEFT JOIN e ON e.stock_code = n.stock_code AND e.rn = n.rn""",
)
def ind_ema(spark, d):
    return I.ema(views.stored_bars(spark, d), 26).select("stock_code", "data_date", *gridded("ema26"))


_ALL_NAMES = [f"ma{n}" for n in fv.SMA_PERIODS] + ["k", "d", *_MACD_NAMES, "upper", "middle", "lower"]
_ALL_SQL = f"""{_NUM}, {_STOCH}, {_MACD},
base AS (SELECT *, {', '.join(f'{value} AS ma{n}' for n, value in _MA.items())}, {_BAND} FROM num),
lines AS (SELECT base.stock_code, data_date, open_price, high_price, low_price, close_price, volume,
  {', '.join(f'ma{n}' for n in _MA)}, k, d, "MACD", "MACDsignal", "MACDhist",
  middle + spread AS upper, middle, middle - spread AS lower
  FROM base LEFT JOIN kd ON kd.stock_code = base.stock_code AND kd.rn = base.rn
  LEFT JOIN macd m ON m.stock_code = base.stock_code AND m.rn = base.rn)"""
_BAR_NAMES = ("stock_code", "data_date", "open_price", "high_price", "low_price", "close_price", "volume")


# some bars come without a close; they are no rows of the series
_PRICED = BARS.replace("bars AS (", "all_bars AS (", 1) + ", bars AS (SELECT * FROM all_bars WHERE day(data_date) <> 13)"


def _holed(spark, d):
    close = F.when(F.dayofmonth("data_date") != 13, F.col("close_price"))
    return views.stored_bars(spark, d).withColumn("close_price", close)


@query(
    "ind_all",
    f"WITH RECURSIVE {_PRICED}, {_ALL_SQL} SELECT {', '.join(_BAR_NAMES)}, {gridded_sql(*_ALL_NAMES)} FROM lines",
)
def ind_all(spark, d):
    return I.indicators(_holed(spark, d)).select(*_BAR_NAMES, *gridded(*_ALL_NAMES))


@query(
    "ind_refresh",
    f"""WITH RECURSIVE {_PRICED}, {_ALL_SQL} SELECT {', '.join(_BAR_NAMES)}, {gridded_sql(*_ALL_NAMES)} FROM lines
    WHERE data_date >= DATE '2001-08-01'""",
)
def ind_refresh(spark, d):
    # the history up to July is known, then the bars of August and those of the rest arrive
    bars, states, cut = _holed(spark, d), work_folder(spark, "states"), ("2001-08-01", "2001-09-01", None)
    R.start(filters.between_dates(bars, None, "2001-07-31"), states)
    steps = [bars.where((F.col("data_date") >= cut[0]) & (F.col("data_date") < cut[1])), bars.where(F.col("data_date") >= cut[1])]
    lines = [R.refresh(spark, states, new, number) for number, new in enumerate(steps, 1)]
    return sets.union_all(lines).select(*_BAR_NAMES, *gridded(*_ALL_NAMES))


# ---------------------------------------------------------------- signals
@query(
    "signal_kd_oversold",
    f"""WITH RECURSIVE {BARS}, {_NUM}, {_STOCH}
    SELECT n.stock_code, data_date,
      CASE WHEN k > d AND k <= 20 AND d <= 20 THEN 1 ELSE 0 END AS buy_flag
    FROM num n LEFT JOIN kd ON kd.stock_code = n.stock_code AND kd.rn = n.rn""",
)
def signal_kd_oversold(spark, d):
    lines = I.stoch(views.stored_bars(spark, d))
    return S.kd_oversold(lines).select("stock_code", "data_date", "buy_flag")


_LAG = "lag({0}) OVER (PARTITION BY stock_code ORDER BY rn)"


@query(
    "signal_kd_cross",
    f"""WITH RECURSIVE {BARS}, {_NUM}, {_STOCH},
    p AS (SELECT *, {_LAG.format('k - d')} AS gap0 FROM kd),
    s AS (SELECT *, CASE WHEN gap0 <= 0 AND k - d > 0 AND k <= 20 AND d <= 20 THEN 'long'
                         WHEN gap0 >= 0 AND k - d < 0 AND k >= 80 AND d >= 80 THEN 'short' END AS side FROM p)
    SELECT s.stock_code, data_date, {gridded_sql('k', 'd')}, side FROM s
    JOIN num n ON n.stock_code = s.stock_code AND n.rn = s.rn WHERE side IS NOT NULL""",
)
def signal_kd_cross(spark, d):
    lines = I.stoch(views.stored_bars(spark, d), previous=True)
    both = S.with_side(lines, S.kd_crossed("long"), S.kd_crossed("short"))
    return both.select("stock_code", "data_date", *gridded("k", "d"), "side")


@query(
    "signal_macd_cross",
    f"""WITH RECURSIVE {BARS}, {_NUM}, {_MACD},
    p AS (SELECT *, {_LAG.format('"MACDhist"')} AS gap0 FROM macd),
    s AS (SELECT *, CASE
      WHEN gap0 <= 0 AND "MACDhist" >= 1e-1 AND "MACD" < 0 AND "MACDsignal" < 0 THEN 'long'
      WHEN gap0 >= 0 AND "MACDhist" <= -1e-1 AND "MACD" > 0 AND "MACDsignal" > 0 THEN 'short' END AS side
      FROM p)
    SELECT s.stock_code, data_date, {gridded_sql('MACD', 'MACDsignal')}, side FROM s
    JOIN num n ON n.stock_code = s.stock_code AND n.rn = s.rn WHERE side IS NOT NULL""",
)
def signal_macd_cross(spark, d):
    lines = I.macd(views.stored_bars(spark, d), previous=True)
    both = S.with_side(lines, S.macd_crossed("long"), S.macd_crossed("short"))
    return both.select("stock_code", "data_date", *gridded("MACD", "MACDsignal"), "side")


_MA_GAP = f"""ma AS (SELECT *, {_MA[5]} AS ma5, {_MA[20]} AS ma20 FROM num),
gaps AS (SELECT *, ma5 - ma20 AS gap, {_LAG.format('ma5 - ma20')} AS gap0 FROM ma)"""


@query(
    "signal_ma_cross",
    f"""WITH {BARS}, {_NUM}, {_MA_GAP}
    SELECT stock_code, data_date, {gridded_sql('ma5', 'ma20')}, CASE WHEN gap > 0 THEN 'long' ELSE 'short' END AS side
    FROM gaps WHERE (gap0 <= 0 AND gap > 0) OR (gap0 >= 0 AND gap < 0)""",
)
def signal_ma_cross(spark, d):
    lines = I.sma(views.stored_bars(spark, d), (5, 20), previous=True)
    both = S.with_side(lines, S.ma_crossed(5, 20, "long"), S.ma_crossed(5, 20, "short"))
    return both.select("stock_code", "data_date", *gridded("ma5", "ma20"), "side")


@query(
    "signal_rsi",
    f"""WITH RECURSIVE {BARS}, {_NUM}, {_RSI},
    p AS (SELECT *, {_LAG.format('rsi')} AS rsi0 FROM rsi)
    SELECT n.stock_code, data_date, {on_grid_sql('p.rsi')} AS rsi,
      CASE WHEN rsi0 <= 20 AND p.rsi > 20 THEN 1 ELSE 0 END AS long_flag,
      CASE WHEN rsi0 >= 80 AND p.rsi < 80 THEN 1 ELSE 0 END AS short_flag
    FROM num n LEFT JOIN p ON p.stock_code = n.stock_code AND p.rn = n.rn""",
)
def signal_rsi(spark, d):
    lines = I.rsi(views.stored_bars(spark, d), previous=True)
    return lines.select(
        "stock_code",
        "data_date",
        *gridded("rsi"),
        F.when(S.rsi_crossed("long"), 1).otherwise(0).alias("long_flag"),
        F.when(S.rsi_crossed("short"), 1).otherwise(0).alias("short_flag"),
    )


_LEADS = ", ".join(
    f"(lead(close_price, {h}) OVER (PARTITION BY stock_code ORDER BY rn) - close_price) / close_price * 100 AS return_{h}"
    for h in fv.FORWARD_HORIZONS
)


@query(
    "forward_return",
    f"""WITH {BARS}, {_NUM}, {_MA_GAP}, f AS (SELECT *, {_LEADS} FROM gaps)
    SELECT stock_code, data_date, close_price, {gridded_sql('return_5', 'return_10', 'return_20')}
    FROM f WHERE gap0 <= 0 AND gap > 0""",
)
def forward_return(spark, d):
    gains = [f"return_{h}" for h in fv.FORWARD_HORIZONS]
    return S.ma_cross_returns(views.stored_bars(spark, d), 5, 20, "long").select("stock_code", "data_date", "close_price", *gridded(*gains))


_GROWTH = """g AS (SELECT a.stock_code, a.ym, a.gross_revenue, p.gross_revenue AS last_month, y.gross_revenue AS last_year,
  (SELECT sum(gross_revenue) FROM revenue t WHERE t.stock_code = a.stock_code AND t.ym // 100 = a.ym // 100
     AND t.ym <= a.ym) AS acc,
  (SELECT sum(gross_revenue) FROM revenue t WHERE t.stock_code = a.stock_code
     AND t.ym // 100 = a.ym // 100 - 1 AND t.ym <= a.ym - 100) AS last_acc
FROM revenue a
LEFT JOIN revenue p ON p.stock_code = a.stock_code
  AND p.ym = CASE WHEN a.ym % 100 = 1 THEN a.ym - 89 ELSE a.ym - 1 END
LEFT JOIN revenue y ON y.stock_code = a.stock_code AND y.ym = a.ym - 100)"""


@query(
    "revenue_mom_yoy_ytd",
    f"""WITH {REVENUE}, {_GROWTH}
    SELECT stock_code, concat(CAST(ym // 100 AS STRING), '-', lpad(CAST(ym % 100 AS STRING), 2, '0'))
      AS revenue_year_month,
      {on_grid_sql('(gross_revenue - last_month) / last_month * 100')} AS last_month_revenue_change_ratio,
      last_month AS last_month_gross_revenue,
      {on_grid_sql('(gross_revenue - last_year) / last_year * 100')} AS last_year_revenue_change_ratio,
      last_year AS last_year_gross_revenue, gross_revenue,
      {on_grid_sql('CAST(acc - last_acc AS DOUBLE) / CAST(last_acc AS DOUBLE) * 100')} AS prophase_revenue_change_ratio,
      CAST(last_acc AS BIGINT) AS last_year_accumulation_revenue, CAST(acc AS BIGINT) AS accumulation_revenue
    FROM g""",
)
def revenue_growth(spark, d):
    grown = sets.revenue_growth(views.revenue(spark, d))
    ratios = [name for name in grown.columns if name.endswith("_ratio")]
    return grown.withColumns({name: on_grid(F.col(name)) for name in ratios})


_SCREEN = f"""ratio AS ({_RATIO_SQL.format(base='newest')}),
positive AS (SELECT stock_code, {_COUNTS} FROM classes GROUP BY stock_code HAVING {_ANY3})
SELECT {', '.join(_BAR_NAMES)}, {gridded_sql(*_ALL_NAMES)}, {{flag}} AS {{name}},
  company_name_ch, {', '.join(n.replace('_vol_amount', '_ratio') for n in fv.FLOW_VOLUMES)},
  {', '.join(n + '_buy_count' for n in FL.INVESTOR_CLASSES)}
FROM lines NATURAL JOIN ratio NATURAL JOIN positive"""


def _screen_sql(flag: str, name: str) -> str:
    return (
        f"WITH RECURSIVE {_PRICED}, {_ALL_SQL}, {FLOWS}, {_RECENT}, {_CLASSES.format(base='recent')}, {NEWEST}, "
        + _SCREEN.format(flag=flag, name=name)
    )


def _screen(spark, d, side):
    found = screen(_holed(spark, d), views.flows(spark, d), views.securities(spark, d), side, AS_OF)
    return found.withColumns({name: on_grid(F.col(name)) for name in _ALL_NAMES})


@query("screen_stocks", _screen_sql("CASE WHEN k > d AND k <= 20 AND d <= 20 THEN 1 ELSE 0 END", "buy_flag"))
def screen_long(spark, d):
    return _screen(spark, d, "long")


@query(
    "screen_stocks_short",
    _screen_sql("CASE WHEN k < d AND k >= 80 AND d >= 80 THEN 1 ELSE 0 END", "sell_flag"),
)
def screen_short(spark, d):
    return _screen(spark, d, "short")
