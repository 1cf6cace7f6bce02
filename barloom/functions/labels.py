"""Text clean-up as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from barloom import fixed_values as fv


def strip_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def strip_quote_eq(text: Column) -> Column:
    """``="0050"`` becomes ``0050``."""
    return F.translate(text, '="', "")


def slash_date(text: Column) -> Column:
    """``2021/9/3`` to a date, NULL when it is none."""
    return F.try_to_date(text, "y/M/d")


def paren_word(text: Column) -> Column:
    """First word in parentheses, NULL without one."""
    return F.nullif(F.regexp_extract(text, "(?U)" + fv.PAREN_WORD, 1), F.lit(""))


def code_of_label(text: Column) -> Column:
    """``2330 - name`` becomes ``2330``."""
    return F.replace(F.split_part(text, F.lit("-"), F.lit(1)), F.lit(" "), F.lit(""))


def date_part(ts: Column) -> Column:
    return F.to_date(ts)


def feed_symbol(code: Column, market: Column) -> Column:
    return (
        F.when(market == "TWSE", F.concat(F.lit("tse_"), code, F.lit(".tw")))
        .when(market == "OTC", F.concat(F.lit("otc_"), code, F.lit(".tw")))
        .otherwise("")
    )


def price_symbol(code: Column, market: Column) -> Column:
    """Symbol of the price feed: listed stocks end in .TW, all others in .TWO."""
    return F.concat(code, F.when(market == "TWSE", ".TW").otherwise(".TWO"))


def normalise_label(text: Column) -> Column:
    for old, new in fv.LABEL_REPLACEMENTS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def side_of_label(text: Column) -> Column:
    side = F.lit(fv.SIDE_DEFAULT)
    for label, name in fv.SIDE_LABELS.items():
        side = F.when(text == label, name).otherwise(side)
    return side


def strip_weekday(text: Column) -> Column:
    return F.regexp_replace(text, fv.WEEKDAY_SIGNS, "")


def index_symbol(text: Column) -> Column:
    """Symbol without its leading caret; symbols without one stay whole."""
    return F.regexp_replace(text, r"^\^", "")
