"""Projections, casts, text clean-up and date rules."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from barloom import fixed_values as fv, schemas
from barloom.catalog.base import Catalog, HOLIDAYS, QUOTES
from barloom.functions import dates as D, labels as L, prices as P
from barloom.operators import joins, project as pr, sets, workdays
from barloom.plans import loads, statements, views
from barloom.sources import readers

catalog = Catalog()
query = catalog.query

# ------------------------------------------------------------ projections
_LISTED = """CAST(c_custkey AS STRING) AS stock_code, c_name AS company_name, c_name AS company_name_ch,
upper(c_name) AS company_name_en, c_mktsegment AS industry,
concat(CAST(1950 + c_custkey % 50 AS STRING), '/', CAST(1 + c_custkey % 12 AS STRING), '/', CAST(1 + c_custkey % 28 AS STRING)) AS establishment_date,
concat(CAST(1970 + c_custkey % 50 AS STRING), '/', CAST(1 + c_custkey % 12 AS STRING), '/', CAST(1 + c_custkey % 28 AS STRING)) AS listed_date,
CAST(CAST(round(abs(c_acctbal) * 1000) AS BIGINT) AS STRING) AS company_capital,
CAST(c_custkey * 10 AS STRING) AS outstanding_principal, '0' AS private_equity, '0' AS preferred_stock,
concat('http://', CAST(c_custkey AS STRING), '.example') AS company_url"""


def company_list(spark, d, market):
    """Company list as published: source headings, text values, a repeated header row."""
    key = F.col("c_custkey")
    side = key % 2 == (0 if market == "TWSE" else 1)

    def day(base):
        return F.concat_ws("/", (key % 50 + base), key % 12 + 1, key % 28 + 1)

    values = [
        key, F.col("c_name"), F.col("c_name"), F.upper("c_name"), F.col("c_mktsegment"), day(1950),
        day(1970), F.round(F.abs(F.col("c_acctbal")) * 1000).cast("bigint"), key * 10, F.lit("0"),
        F.lit("0"), F.concat(F.lit("http://"), key, F.lit(".example")),
    ]
    names = list(fv.SECURITY_COLUMNS)
    names[6] = fv.SECURITY_LISTED_HEADING[market]
    rows = views.table(spark, d, "customer").where(side).select(
        [value.cast("string").alias(name) for value, name in zip(values, names)]
    )
    header = views.table(spark, d, "region").select([F.lit(name).alias(name) for name in names])
    return rows.unionByName(header)


def _masters(spark, d):
    return [loads.security_master(company_list(spark, d, market), market) for market in fv.MARKET_NAMES]


@query("proj_rename_map", f"SELECT {_LISTED} FROM customer")
def proj_rename_map(spark, d):
    def renamed(market):
        rows = readers.drop_header_rows(company_list(spark, d, market), fv.CODE_HEADING)
        return pr.rename_select(rows, loads.security_headings(market))

    return sets.union_all([renamed(market) for market in fv.MARKET_NAMES])


_MARKETS = """CASE WHEN c_custkey % 2 = 0 THEN 'TWSE' ELSE 'OTC' END AS stock_class,
CASE WHEN c_custkey % 2 = 0 THEN '上市' ELSE '上櫃' END AS stock_class_ch"""


@query("union_markets", f"SELECT {_LISTED}, {_MARKETS} FROM customer")
def union_markets(spark, d):
    return sets.union_markets(*_masters(spark, d))


@query(
    "proj_literal_columns",
    "SELECT s_suppkey, s_name, 'TWSE' AS stock_class, '上市' AS stock_class_ch, '2021' AS data_year FROM supplier",
)
def proj_literal_columns(spark, d):
    rows = views.table(spark, d, "supplier").select("s_suppkey", "s_name")
    return pr.with_literals(
        rows, {"stock_class": "TWSE", "stock_class_ch": fv.MARKET_NAMES["TWSE"], "data_year": "2021"}
    )


@query(
    "proj_insert_at",
    "SELECT event_id, user_id, CAST(0.0 AS DOUBLE) AS price_change_ratio, value FROM events",
)
def proj_insert_at(spark, d):
    rows = views.table(spark, d, "events").select("event_id", "user_id", "value")
    return pr.insert_column(rows, 2, "price_change_ratio", F.lit(0.0))


@query("proj_drop", "SELECT event_id, ts, user_id, value FROM events")
def proj_drop(spark, d):
    return pr.drop_columns(views.table(spark, d, "events"), ["props", "event_type"])


@query(
    "proj_reindex",
    """SELECT CAST(user_id AS STRING) AS stock_code, CAST(ts AS DATE) AS data_date,
    CAST(NULL AS DOUBLE) AS high_price, CAST(NULL AS DOUBLE) AS low_price, CAST(NULL AS DOUBLE) AS open_price,
    value AS close_price, event_id AS volume, CAST(NULL AS DOUBLE) AS adj_close_price FROM events""",
)
def proj_reindex(spark, d):
    rows = views.table(spark, d, "events").select(
        F.col("value").alias("close_price"),
        F.col("event_id").alias("volume"),
        F.col("user_id").alias("stock_code"),
        F.to_date("ts").alias("data_date"),
    )
    return pr.conform(rows, schemas.STOCK_PRICE)


@query(
    "cast_strict_int",
    """SELECT CAST(o_orderkey AS BIGINT) AS stock_code, CAST(round(o_totalprice * 100) AS BIGINT) AS company_capital
    FROM orders""",
)
def cast_strict_int(spark, d):
    text = views.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("stock_code"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("company_capital"),
    )
    return pr.cast_strict(text, ["stock_code", "company_capital"])


@query(
    "cast_coerce_numeric",
    f"WITH {QUOTES} SELECT c, ts, CAST(z AS DOUBLE) AS z FROM quotes WHERE z <> '-'",
)
def cast_coerce_numeric(spark, d):
    return pr.cast_coerce(views.quotes(spark, d).select("c", "ts", "z"), "z")


@query(
    "null_marker_replace",
    f"WITH {QUOTES} SELECT c, ts, nullif(z, '-') AS z, b, nullif(v, '-') AS v FROM quotes",
)
def null_marker_replace(spark, d):
    return pr.null_markers(views.quotes(spark, d))


@query(
    "fill_zero",
    f"""WITH {QUOTES} SELECT c, ts, CAST(coalesce(nullif(v, '-'), '0') AS BIGINT) AS accumulation_volume
    FROM quotes""",
)
def fill_zero(spark, d):
    rows = pr.null_markers(views.quotes(spark, d)).select(
        "c", "ts", F.col("v").cast("bigint").alias("accumulation_volume")
    )
    return pr.fill_zero(rows, ["accumulation_volume"])


@query(
    "coalesce_fallback_bid",
    f"WITH {QUOTES} SELECT c, ts, CASE WHEN z = '-' THEN split_part(b, '_', 1) ELSE z END AS price FROM quotes",
)
def coalesce_fallback_bid(spark, d):
    rows = views.quotes(spark, d)
    return rows.select("c", "ts", P.price_or_best_bid(F.col("z"), F.col("b")).alias("price"))


@query(
    "price_change_ratio",
    """SELECT p_partkey, round_even((CAST(p_size AS DOUBLE) - p_size % 7)
      / nullif(CAST(p_size % 7 AS DOUBLE), 0) * 100 * 100, 0) / 100 AS price_change_ratio FROM part""",
)
def price_change_ratio(spark, d):
    last, previous = F.col("p_size").cast("double"), (F.col("p_size") % 7).cast("double")
    return views.table(spark, d, "part").select(
        "p_partkey", P.change_ratio(last, previous).alias("price_change_ratio")
    )


@query(
    "add_insert_time",
    "SELECT event_id, TIMESTAMP '2021-09-23 13:40:00' AS insert_time FROM events",
)
def add_insert_time(spark, d):
    rows = views.table(spark, d, "events").select("event_id")
    stamped = pr.stamp(rows, datetime(2021, 9, 23, 13, 40, tzinfo=timezone.utc))
    return stamped.withColumn("insert_time", D.utc_wall(F.col("insert_time")))


@query("constant_null_column", "SELECT event_id, value, CAST(NULL AS DOUBLE) AS adj_close_price FROM events")
def constant_null_column(spark, d):
    return pr.null_column(views.table(spark, d, "events").select("event_id", "value"), "adj_close_price")


# ------------------------------------------------------------- statements
_CLASSES = list(fv.STATEMENT_MODES["all"])


def _statement_columns() -> list[str]:
    names: dict[str, None] = {}
    for sources in fv.INCOME_SOURCES.values():
        for source in sources:
            for name in [source] if isinstance(source, str) else source or []:
                names[name] = None
    for sums in statements.BALANCE_SUMS.values():
        for parts in sums.values():
            names.update(dict.fromkeys(parts))
    names.update(dict.fromkeys(fv.BALANCE_COLUMNS))
    names.update(dict.fromkeys(fv.CASH_FLOW_MEASURES))
    return list(names)


# Source figures: each heading is the customer's balance in cents, scaled by its place in
# the list; every eleventh figure is missing.
def _figures(quote: str) -> list[str]:
    return [
        f"CASE WHEN (c_custkey + {i}) % 11 <> 0 THEN cents * {i + 1} % 100003 + c_custkey END"
        f" AS {quote}{name}{quote}"
        for i, name in enumerate(_statement_columns())
    ]


def _statement_source(spark, d):
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents")
    classes = ", ".join(f"'{name}'" for name in _CLASSES)
    return views.table(spark, d, "customer").select("c_custkey", cents).selectExpr(
        "CAST(c_custkey AS STRING) AS stock_code",
        f"element_at(array({classes}), CAST(c_custkey % {len(_CLASSES)} + 1 AS INT)) AS {statements.CLASS}",
        "'2021Q2' AS report_year",
        *_figures("`"),
    )


def _statement_cte() -> str:
    figures = ",\n".join(_figures('"'))
    classes = ", ".join(f"'{name}'" for name in _CLASSES)
    return f"""src AS (SELECT CAST(c_custkey AS STRING) AS stock_code,
    list_extract([{classes}], CAST(c_custkey % {len(_CLASSES)} + 1 AS BIGINT)) AS industry_class,
    '2021Q2' AS report_year, {figures}
    FROM (SELECT *, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer) c)"""


def _q(source) -> str:
    if source is None:
        return "NULL"
    return " + ".join(f'"{name}"' for name in ([source] if isinstance(source, str) else source))


def _income_sql(classes) -> str:
    parts = [
        f"SELECT stock_code, "
        + ", ".join(
            f"CAST({_q(source)} AS {'DOUBLE' if name == 'EPS' else 'BIGINT'}) AS \"{name}\""
            for name, source in zip(fv.INCOME_MEASURES, fv.INCOME_SOURCES[cls])
        )
        + f", report_year AS performance_year FROM src WHERE industry_class = '{cls}'"
        for cls in classes
    ]
    return f"WITH {_statement_cte()} " + " UNION ALL ".join(parts)


def _balance_sql(classes) -> str:
    parts = []
    for cls in classes:
        sums = statements.BALANCE_SUMS.get(cls, {})
        columns = ", ".join(
            f"CAST({_q(sums.get(heading, heading))} AS {'DOUBLE' if name == 'PBR' else 'BIGINT'}) AS \"{name}\""
            for heading, name in fv.BALANCE_COLUMNS.items()
        )
        parts.append(
            f"SELECT stock_code, {columns}, report_year AS assets_year FROM src WHERE industry_class = '{cls}'"
        )
    return f"WITH {_statement_cte()} " + " UNION ALL ".join(parts)


def _cash_sql() -> str:
    names = ", ".join(
        "operating_cash_flows + investing_cash_flows AS free_cash_flow" if n == "free_cash_flow" else n
        for n in fv.CASH_FLOW_MEASURES
    )
    return f"WITH {_statement_cte()} SELECT stock_code, report_year AS cash_flows_year, {names} FROM src"


@query("statement_unify", _income_sql(_CLASSES))
def statement_income(spark, d):
    return statements.unify_statements(_statement_source(spark, d), "income", "all")


@query("statement_unify_financial", _income_sql(fv.STATEMENT_MODES["1"]))
def statement_financial(spark, d):
    return statements.unify_statements(_statement_source(spark, d), "income", "1")


@query("statement_unify_general", _income_sql(fv.STATEMENT_MODES["0"]))
def statement_general(spark, d):
    return statements.unify_statements(_statement_source(spark, d), "income", "0")


@query("statement_balance", _balance_sql(_CLASSES))
def statement_balance(spark, d):
    return statements.unify_statements(_statement_source(spark, d), "balance", "all")


@query("derived_fcf", _cash_sql())
def derived_fcf(spark, d):
    return statements.unify_statements(_statement_source(spark, d), "cash", "all")


@query("union_industries", _balance_sql(_CLASSES))
def union_industries(spark, d):
    source = _statement_source(spark, d)
    frames = [
        statements.balance_sheet(source.where(F.col(statements.CLASS) == name)) for name in _CLASSES
    ]
    return statements.union_statements(frames)


_SUMS = {
    "bank_current_assets": fv.BANK_CURRENT_ASSETS,
    "bank_non_current_assets": fv.BANK_NON_CURRENT_ASSETS,
    "bank_current_liabilities": fv.BANK_CURRENT_LIABILITIES,
    "bank_non_current_liabilities": fv.BANK_NON_CURRENT_LIABILITIES,
    "insurance_current_assets": fv.INSURANCE_CURRENT_ASSETS,
    "insurance_non_current_assets": fv.INSURANCE_NON_CURRENT_ASSETS,
    "insurance_current_liabilities": fv.INSURANCE_CURRENT_LIABILITIES,
    "insurance_non_current_liabilities": fv.INSURANCE_NON_CURRENT_LIABILITIES,
}


@query(
    "row_sum_components",
    f"WITH {_statement_cte()} SELECT stock_code, {', '.join(f'{_q(parts)} AS {name}' for name, parts in _SUMS.items())} FROM src",
)
def row_sum_components(spark, d):
    return _statement_source(spark, d).select("stock_code", *(P.sum_components(parts).alias(name) for name, parts in _SUMS.items()))


# --------------------------------------------------------------- dividends
def _dividend_report(spark, d):
    key, cents = F.col("c_custkey"), F.round(F.col("c_acctbal") * 100).cast("bigint")
    values = {
        "stock_code": F.concat(key.cast("string"), F.lit(" - "), F.col("c_name")),
        "dividend_year": F.lit("110"),
        "dividend_date": F.lit("2021/07/01"),
        "remarks": F.col("c_mktsegment"),
    }
    numbers = [n for n in fv.DIVIDEND_NAMES if n not in values]
    values |= {name: (cents * (i + 1) % 997 / 8) for i, name in enumerate(numbers)}
    dropped = [F.lit("x").alias(name) for name in fv.DIVIDEND_DROPPED]
    kept = [values[name].alias(f"heading {i}") for i, name in enumerate(fv.DIVIDEND_NAMES)]
    return views.table(spark, d, "customer").select(dropped[0], *kept, *dropped[1:])


_DIV_NUMBERS = [
    n for n in fv.DIVIDEND_NAMES if n not in ("stock_code", "dividend_year", "dividend_date", "remarks")
]
_DIV = f"""div AS (SELECT CAST(c_custkey AS STRING) AS stock_code, '110' AS dividend_year,
'2021/07/01' AS dividend_date, c_mktsegment AS remarks,
{', '.join(f'cents * {i + 1} % 997 / 8 AS {n}' for i, n in enumerate(_DIV_NUMBERS))}
FROM (SELECT *, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer) c)"""
_RESERVES = """capital_reserve_cash_dividend_1 + capital_reserve_cash_dividend_2 AS capital_reserve_cash_dividend,
capital_reserve_stock_dividend_1 + capital_reserve_stock_dividend_2 AS capital_reserve_stock_dividend"""


@query("reserve_sum", f"WITH {_DIV} SELECT stock_code, {_RESERVES} FROM div")
def reserve_sum(spark, d):
    named = _dividend_report(spark, d).drop(*fv.DIVIDEND_DROPPED).toDF(*fv.DIVIDEND_NAMES)
    return pr.reserve_sum(named).select(
        L.code_of_label(F.col("stock_code")).alias("stock_code"),
        "capital_reserve_cash_dividend",
        "capital_reserve_stock_dividend",
    )


@query(
    "dividend_load",
    f"""WITH {_DIV} SELECT stock_code, dividend_year, dividend_date, cash_dividend, {_RESERVES},
    cash_dividend_total, stock_dividend, stock_dividend_total, remarks FROM div""",
)
def dividend_load(spark, d):
    return loads.dividends(_dividend_report(spark, d))


# ------------------------------------------------------------ text clean-up
def _money(column):
    return F.format_number(F.round(F.col(column) * 100).cast("bigint"), 0)


@query(
    "str_strip_commas",
    "SELECT o_orderkey, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS STRING) AS amount FROM orders",
)
def str_strip_commas(spark, d):
    rows = views.table(spark, d, "orders").select("o_orderkey", _money("o_totalprice").alias("amount"))
    return pr.strip_all_commas(rows)


@query("str_strip_quote_eq", "SELECT lpad(CAST(c_custkey AS STRING), 6, '0') AS stock_code FROM customer")
def str_strip_quote_eq(spark, d):
    code = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    wrapped = F.concat(F.lit('="'), code, F.lit('"'))
    return views.table(spark, d, "customer").select(L.strip_quote_eq(wrapped).alias("stock_code"))


@query("str_replace_slash", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS listed_date FROM orders")
def str_replace_slash(spark, d):
    text = F.date_format("o_orderdate", "yyyy/M/d")
    return views.table(spark, d, "orders").select("o_orderkey", L.slash_date(text).alias("listed_date"))


@query(
    "str_extract_paren",
    r"""SELECT n_nationkey, nullif(regexp_extract(CASE WHEN n_nationkey % 4 = 0 THEN n_name
      ELSE concat('x (', n_name, ')') END, '\((\w+)\)', 1), '') AS word FROM nation""",
)
def str_extract_paren(spark, d):
    label = F.when(F.col("n_nationkey") % 4 == 0, F.col("n_name")).otherwise(
        F.concat(F.lit("x ("), F.col("n_name"), F.lit(")"))
    )
    return views.table(spark, d, "nation").select("n_nationkey", L.paren_word(label).alias("word"))


@query("str_split_code", "SELECT CAST(c_custkey AS STRING) AS stock_code, c_mktsegment FROM customer")
def str_split_code(spark, d):
    label = F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" - "), F.col("c_name"))
    return views.table(spark, d, "customer").select(
        L.code_of_label(label).alias("stock_code"), "c_mktsegment"
    )


@query("str_prefix10", "SELECT event_id, CAST(substr(CAST(ts AS STRING), 1, 10) AS DATE) AS data_date FROM events")
def str_prefix10(spark, d):
    return views.table(spark, d, "events").select("event_id", L.date_part(F.col("ts")).alias("data_date"))


@query(
    "str_normalise_label",
    """SELECT n_nationkey, replace(replace(replace(label, '(元)', ''), '買賣超', '買賣差額'), '大 盤 ', '大盤') AS label
    FROM (SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN concat(n_name, '買賣超(元)')
      WHEN 1 THEN '大 盤 ' ELSE concat(n_name, '買進金額(元)') END AS label FROM nation) q""",
)
def str_normalise_label(spark, d):
    kind = F.col("n_nationkey") % 3
    label = (
        F.when(kind == 0, F.concat("n_name", F.lit("買賣超(元)")))
        .when(kind == 1, "大 盤 ")
        .otherwise(F.concat("n_name", F.lit("買進金額(元)")))
    )
    return views.table(spark, d, "nation").select("n_nationkey", L.normalise_label(label).alias("label"))


@query(
    "case_translate",
    """SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'buy_money_amount'
    WHEN event_type = 'error' THEN 'sell_money_amount' ELSE 'diff_money_amount' END AS buy_sell_type FROM events""",
)
def case_translate(spark, d):
    label = (
        F.when(F.col("event_type") == "purchase", "買進金額")
        .when(F.col("event_type") == "error", "賣出金額")
        .otherwise("買賣差額")
    )
    return views.table(spark, d, "events").select("event_id", L.side_of_label(label).alias("buy_sell_type"))


_SIGNS = "一二三四五六日"


def _holiday_range(start, end):
    def day(column):
        sign = F.substring(F.lit(_SIGNS), F.weekday(column) + 1, F.lit(1))
        return F.concat(F.date_format(column, "M/d"), F.lit("("), sign, F.lit(")"))

    return F.concat(day(start), F.lit("-"), day(end))


@query(
    "str_strip_weekday",
    f"""WITH {HOLIDAYS} SELECT holiday_name, concat(month(holiday_start), '/', day(holiday_start), '-',
      month(holiday_end), '/', day(holiday_end)) AS holiday_range FROM holidays""",
)
def str_strip_weekday(spark, d):
    text = _holiday_range(F.col("holiday_start"), F.col("holiday_end"))
    return views.holidays(spark, d).select("holiday_name", L.strip_weekday(text).alias("holiday_range"))


@query("str_drop_first_char", "SELECT n_nationkey, n_name AS stock_code FROM nation")
def str_drop_first_char(spark, d):
    symbol = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("^"), "n_name")).otherwise(F.col("n_name"))
    return views.table(spark, d, "nation").select("n_nationkey", L.index_symbol(symbol).alias("stock_code"))


@query("json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark, d):
    rows = views.table(spark, d, "events").select("event_id", "props")
    return readers.json_fields(rows, "props", "k bigint")


# ------------------------------------------------------------------- dates
_DAYS = "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS data_date FROM orders) days"


def _days(spark, d):
    rows = views.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("data_date"))
    return rows.distinct()


def _day():
    return F.col("data_date")




@query(
    "date_week_bounds",
    f"""SELECT data_date, CAST(date_trunc('week', data_date) AS DATE) AS week_start_date,
    CAST(date_trunc('week', data_date) AS DATE) + 4 AS week_end_date FROM {_DAYS}""",
)
def date_week_bounds(spark, d):
    monday, friday = D.week_bounds(_day())
    return _days(spark, d).select(
        "data_date", monday.alias("week_start_date"), friday.alias("week_end_date")
    )


@query("date_iso_week", f"SELECT data_date, CAST(weekofyear(data_date) AS INTEGER) AS week_num FROM {_DAYS}")
def date_iso_week(spark, d):
    return _days(spark, d).select("data_date", D.iso_week(_day()).alias("week_num"))


@query(
    "date_week_year",
    f"""SELECT data_date, CASE WHEN weekofyear(data_date) = 1 THEN strftime(monday + 4, '%Y')
    ELSE strftime(monday, '%Y') END AS data_year
    FROM (SELECT data_date, CAST(date_trunc('week', data_date) AS DATE) AS monday FROM {_DAYS}) q""",
)
def date_week_year(spark, d):
    return _days(spark, d).select("data_date", D.week_year(_day()).alias("data_year"))


_WORKDAY = """CASE WHEN hend IS NOT NULL THEN hend + 1
WHEN isodow({day}) = 6 THEN {day} + 2 WHEN isodow({day}) = 7 THEN {day} + 1 ELSE {day} END"""
_HEND = """(SELECT arg_min(holiday_end, (holiday_start, holiday_end)) FROM holidays h
WHERE {day} BETWEEN holiday_start AND holiday_end AND year(holiday_start) = year({day})) AS hend"""


@query(
    "date_next_workday",
    f"""WITH {HOLIDAYS} SELECT data_date, {_WORKDAY.format(day='data_date')} AS work_date
    FROM (SELECT data_date, {_HEND.format(day='data_date')} FROM {_DAYS}) q""",
)
def date_next_workday(spark, d):
    return workdays.next_workday(_days(spark, d), views.holidays(spark, d))


@query(
    "date_next_workday_strict",
    f"""WITH {HOLIDAYS}, spine AS (SELECT CAST(d AS DATE) AS d FROM
      generate_series(DATE '1991-12-01', DATE '2003-12-31', INTERVAL 1 DAY) s(d)),
    work AS (SELECT d FROM spine WHERE isodow(d) < 6 AND NOT EXISTS (SELECT 1 FROM holidays
      WHERE d BETWEEN holiday_start AND holiday_end AND year(holiday_start) = year(d)))
    SELECT data_date, (SELECT min(d) FROM work WHERE d >= data_date) AS work_date FROM {_DAYS}""",
)
def date_next_workday_strict(spark, d):
    return workdays.next_workday_strict(_days(spark, d), views.holidays(spark, d))


_DEADLINES = ", ".join(
    f"('{kind}', '{period}', '{day}')"
    for kind, days in (("general", fv.GENERAL_DEADLINES), ("financial", fv.FINANCIAL_DEADLINES))
    for period, day in days.items()
)


@query(
    "date_filing_deadlines",
    f"""WITH {HOLIDAYS}, y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
    due AS (SELECT year, company_kind, report,
      CAST(CASE WHEN report = 'annual' THEN year - 1 ELSE year END AS INTEGER) AS report_year,
      CAST(concat(CAST(year AS STRING), '-', md) AS DATE) AS due_date
      FROM y, (VALUES {_DEADLINES}) t(company_kind, report, md)),
    h AS (SELECT *, {_HEND.format(day='due_date')} FROM due)
    SELECT year, company_kind, report, report_year, due_date, {_WORKDAY.format(day='due_date')} AS filing_date
    FROM h""",
)
def date_filing_deadlines(spark, d):
    years = _days(spark, d).select(F.year("data_date").alias("year")).distinct()
    return workdays.filing_deadlines(years, views.holidays(spark, d))


@query(
    "date_roc",
    f"""SELECT data_date, concat(CAST(year(data_date) - 1911 AS STRING), '/',
      lpad(CAST(month(data_date) AS STRING), 2, '0'), '/', lpad(CAST(day(data_date) AS STRING), 2, '0')) AS roc_date,
      data_date AS back, CAST(CASE WHEN year(data_date) > 1990 THEN year(data_date) - 1911
        ELSE year(data_date) END AS INTEGER) AS roc_year
    FROM {_DAYS}""",
)
def date_roc(spark, d):
    roc = D.to_roc(_day())
    return _days(spark, d).select(
        "data_date",
        roc.alias("roc_date"),
        D.from_roc(roc).alias("back"),
        D.roc_year(F.year(_day())).alias("roc_year"),
    )


@query(
    "date_weekday_class",
    f"""SELECT data_date, CASE WHEN isodow(data_date) <= 5 THEN 'flows' WHEN isodow(data_date) = 7 THEN 'indices'
      ELSE 'none' END AS load, month(data_date) = 1 AND day(data_date) = 5 AS holiday_load,
      day(data_date) = 7 AS ratio_load FROM {_DAYS}""",
)
def date_weekday_class(spark, d):
    return _days(spark, d).select(
        "data_date",
        D.weekday_class(_day()).alias("load"),
        D.is_holiday_load(_day()).alias("holiday_load"),
        D.is_ratio_load(_day()).alias("ratio_load"),
    )


@query(
    "date_month_back",
    f"""SELECT data_date, strftime(data_date - INTERVAL 1 MONTH, '%Y-%m') AS previous_month,
    strftime(data_date - 30, '%Y-%m') AS days_back_month FROM {_DAYS}""",
)
def date_month_back(spark, d):
    return _days(spark, d).select(
        "data_date",
        D.month_back(_day()).alias("previous_month"),
        D.days_back(_day(), 30).alias("days_back_month"),
    )


@query(
    "date_expand_holidays",
    f"""WITH {HOLIDAYS} SELECT holiday_name, holiday_start, holiday_end, CAST(day AS DATE) AS day FROM
    (SELECT *, unnest(generate_series(holiday_start, holiday_end, INTERVAL 1 DAY)) AS day FROM holidays
     WHERE holiday_start <= holiday_end) q""",
)
def date_expand_holidays(spark, d):
    return joins.expand_holidays(views.holidays(spark, d))


@query(
    "date_holiday_parse",
    f"""WITH {HOLIDAYS} SELECT holiday_name, strftime(holiday_start, '%Y') AS holiday_year, holiday_start, holiday_end,
    CAST(holiday_end - holiday_start + 1 AS STRING) AS holiday_day, '' AS holiday_remarks FROM holidays
    WHERE year(holiday_start) = year(holiday_end)
    UNION ALL SELECT holiday_name, strftime(holiday_start, '%Y'), holiday_start,
      make_date(year(holiday_start), month(holiday_end), day(holiday_end)),
      CAST(holiday_end - holiday_start + 1 AS STRING), '' FROM holidays
    WHERE year(holiday_start) <> year(holiday_end)""",
)
def date_holiday_parse(spark, d):
    text = _holiday_range(F.col("holiday_start"), F.col("holiday_end"))
    rows = views.holidays(spark, d).select(
        "holiday_name",
        F.year("holiday_start").alias("year"),
        F.when(F.col("holiday_start") == F.col("holiday_end"), F.split_part(text, F.lit("-"), F.lit(1)))
        .otherwise(text)
        .alias("holiday_range"),
        (F.date_diff("holiday_end", "holiday_start") + 1).cast("string").alias("holiday_day"),
        F.lit("").alias("holiday_remarks"),
    )
    return workdays.parse_holiday(rows, F.col("year"))


@query("date_year_month_key", f"SELECT data_date, strftime(data_date, '%Y-%m') AS month_key FROM {_DAYS}")
def date_year_month_key(spark, d):
    key = D.month_key(F.year(_day()), F.month(_day()))
    return _days(spark, d).select("data_date", key.alias("month_key"))


@query(
    "date_in_session",
    """SELECT event_id, CAST(ts AS TIME) BETWEEN TIME '09:00:00' AND TIME '13:40:00' AS in_session,
    CAST(ts AS TIME) >= TIME '13:40:00' AS after_close FROM events""",
)
def date_in_session(spark, d):
    ts = F.col("ts")
    return views.table(spark, d, "events").select(
        "event_id", D.in_session(ts).alias("in_session"), D.after_close(ts).alias("after_close")
    )
