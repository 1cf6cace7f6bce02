"""Explicit schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

from barloom import fixed_values as fv


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_DATE, _TS = T.DateType(), T.TimestampType()

STOCK_PRICE = _struct(
    ("stock_code", _S), ("data_date", _DATE), ("high_price", _D), ("low_price", _D),
    ("open_price", _D), ("close_price", _D), ("volume", _L), ("adj_close_price", _D),
)
STOCK_PRICE_WEEK = _struct(
    ("stock_code", _S), ("data_year", _S), ("week_num", _I), ("week_start_date", _DATE),
    ("week_end_date", _DATE), ("high_price", _D), ("low_price", _D), ("open_price", _D),
    ("close_price", _D), ("volume", _L),
)
STOCK_PRICE_MONTH = _struct(
    ("stock_code", _S), ("data_year_month", _S), ("month_start_date", _DATE),
    ("month_end_date", _DATE), ("high_price", _D), ("low_price", _D), ("open_price", _D),
    ("close_price", _D), ("volume", _L),
)
QUOTE_SNAPSHOT = _struct(
    ("stock_code", _S), ("company_name", _S), ("newest_deal_price", _D),
    ("newest_volume", _L), ("accumulation_volume", _L), ("open_price", _D),
    ("high_price", _D), ("low_price", _D), ("yesterday_close_price", _D),
    ("price_change_ratio", _D), ("insert_time", _TS),
)
RAW_QUOTE = _struct(*[(name, _S) for name in fv.QUOTE_FIELDS])
QUOTE_PAYLOAD = T.StructType([T.StructField("msgArray", T.ArrayType(RAW_QUOTE))])
SECURITIES = _struct(
    ("stock_code", _S), ("company_name", _S), ("company_name_ch", _S),
    ("company_name_en", _S), ("industry", _S), ("establishment_date", _DATE),
    ("listed_date", _DATE), ("company_capital", _L), ("outstanding_principal", _L),
    ("private_equity", _L), ("preferred_stock", _L), ("company_url", _S),
    ("stock_class", _S), ("stock_class_ch", _S), ("update_date", _DATE),
    ("stock_status", _S),
)
INVESTOR_FLOWS = _struct(
    ("stock_code", _S),
    *[(name, _L) for name in list(fv.FLOW_COLUMNS.values())[1:]],
    ("data_date", _DATE),
)
INVESTOR_MONEY = _struct(
    ("data_date", _DATE), ("stock_class", _S), ("buy_sell_type", _S),
    ("buy_sell_type_ch", _S), *[(name, _L) for name in fv.MONEY_INVESTORS],
)
EXCHANGE_RATES = _struct(
    ("currency_type", _S), *[(name, _D) for name in fv.FX_COLUMNS[1:]], ("data_date", _DATE),
)
HOLIDAYS = _struct(
    ("holiday_name", _S), ("holiday_year", _S), ("holiday_start", _DATE),
    ("holiday_end", _DATE), ("holiday_day", _S), ("holiday_remarks", _S),
)
