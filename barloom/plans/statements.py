"""Quarterly statements of all industry classes in one layout each.

The classes publish different columns. The input is one wide frame with an
``industry_class`` column. Every heading that a class publishes must be there; a measure
that a class does not publish is NULL for it. The class picks the source expression row by row, so a statement is one pass over its
input, without a scan or union per class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from barloom import fixed_values as fv
from barloom.functions.prices import sum_components
from barloom.operators.project import free_cash_flow, quoted
from barloom.operators.sets import union_all

CLASS = "industry_class"
_KINDS = {"income": "performance_year", "balance": "assets_year", "cash": "cash_flows_year"}

# balance columns that these classes do not publish but are the sum of components
_BANK_SUMS = {
    "流動資產": fv.BANK_CURRENT_ASSETS,
    "非流動資產": fv.BANK_NON_CURRENT_ASSETS,
    "流動負債": fv.BANK_CURRENT_LIABILITIES,
    "非流動負債": fv.BANK_NON_CURRENT_LIABILITIES,
}
_INSURANCE_SUMS = {
    "流動資產": fv.INSURANCE_CURRENT_ASSETS,
    "非流動資產": fv.INSURANCE_NON_CURRENT_ASSETS,
    "流動負債": fv.INSURANCE_CURRENT_LIABILITIES,
    "非流動負債": fv.INSURANCE_NON_CURRENT_LIABILITIES,
}
BALANCE_SUMS = {"bank": _BANK_SUMS, "holding": _BANK_SUMS, "insurance": _INSURANCE_SUMS}


Source = str | tuple[str, ...] | None


def _figure(df: DataFrame, source: Source, kind: T.DataType) -> Column:
    if source is None:
        return F.lit(None).cast(kind)
    names = [source] if isinstance(source, str) else list(source)
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"the statement lacks the headings {absent}")
    return sum_components(names).cast(kind)


def _by_class(df: DataFrame, sources: dict[str, Source], kind: T.DataType) -> Column:
    """The figure of the row's own class; classes with the same source share a branch."""
    shared: dict[Source, list[str]] = {}
    for name, source in sources.items():
        shared.setdefault(source, []).append(name)
    if len(shared) == 1:
        return _figure(df, next(iter(shared)), kind)
    picked = F.lit(None).cast(kind)
    for source, names in shared.items():
        picked = F.when(F.col(CLASS).isin(names), _figure(df, source, kind)).otherwise(picked)
    return picked


def _income_sources(i: int, classes: Sequence[str]) -> dict[str, Source]:
    return {cls: fv.INCOME_SOURCES[cls][i] for cls in classes}


def _balance_sources(heading: str, classes: Sequence[str]) -> dict[str, Source]:
    return {cls: BALANCE_SUMS.get(cls, {}).get(heading, heading) for cls in classes}


def headings(kind: str, mode: str = "all") -> list[str]:
    """Headings that a statement of a mode's classes must have."""
    classes = fv.STATEMENT_MODES[mode]
    if kind == "cash":
        return list(fv.CASH_FLOW_MEASURES)
    if kind == "income":
        parts = [_income_sources(i, classes) for i in range(len(fv.INCOME_MEASURES))]
    else:
        parts = [_balance_sources(heading, classes) for heading in fv.BALANCE_COLUMNS]
    sources = [source for part in parts for source in part.values() if source is not None]
    names = [name for source in sources for name in ([source] if isinstance(source, str) else source)]
    return list(dict.fromkeys(names))


def income_statement(df: DataFrame, classes: Sequence[str] = fv.STATEMENT_MODES["all"]) -> DataFrame:
    def measure(i: int, name: str) -> Column:
        kind = T.DoubleType() if name == "EPS" else T.LongType()
        return _by_class(df, _income_sources(i, classes), kind).alias(name)

    measures = [measure(i, name) for i, name in enumerate(fv.INCOME_MEASURES)]
    return df.select("stock_code", *measures, F.col("report_year").alias(_KINDS["income"]))


def balance_sheet(df: DataFrame, classes: Sequence[str] = fv.STATEMENT_MODES["all"]) -> DataFrame:
    def measure(heading: str, name: str) -> Column:
        kind = T.DoubleType() if name == "PBR" else T.LongType()
        return _by_class(df, _balance_sources(heading, classes), kind).alias(name)

    measures = [measure(heading, name) for heading, name in fv.BALANCE_COLUMNS.items()]
    return df.select("stock_code", *measures, F.col("report_year").alias(_KINDS["balance"]))


def cash_flow(df: DataFrame, classes: Sequence[str] = fv.STATEMENT_MODES["all"]) -> DataFrame:
    """Same columns in all classes; free cash flow is recomputed."""
    named = df.select(
        "stock_code",
        F.col("report_year").alias(_KINDS["cash"]),
        *[_figure(df, name, T.LongType()).alias(name) for name in fv.CASH_FLOW_MEASURES],
    )
    return free_cash_flow(named).select("stock_code", _KINDS["cash"], *fv.CASH_FLOW_MEASURES)


_BUILDERS = {"income": income_statement, "balance": balance_sheet, "cash": cash_flow}


def unify_statements(df: DataFrame, kind: str, mode: str = "all") -> DataFrame:
    """One statement kind (income, balance, cash) of the classes a mode covers:
    ``0`` general companies, ``1`` financial ones, ``all``."""
    classes = fv.STATEMENT_MODES[mode]
    return _BUILDERS[kind](df.where(quoted(CLASS).isin(list(classes))), classes)


def union_statements(frames: list[DataFrame]) -> DataFrame:
    """Stack class frames that arrive separately; absent measures become NULL."""
    return union_all(frames)
