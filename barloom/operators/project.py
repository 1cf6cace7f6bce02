"""Projections, renames, casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from barloom import fixed_values as fv
from barloom.functions.labels import strip_commas


def quoted(name: str) -> Column:
    """Column by its literal name; source headings may hold dots and spaces."""
    return F.col(f"`{name}`")


def rename_select(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns, renamed, in the order of the mapping."""
    return df.select([quoted(old).alias(new) for old, new in mapping.items()])


def with_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def insert_column(df: DataFrame, position: int, name: str, value: Column) -> DataFrame:
    columns = [quoted(column) for column in df.columns]
    return df.select(*columns[:position], value.alias(name), *columns[position:])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; missing ones become NULL."""
    present = set(df.columns)
    return df.select(
        [
            (quoted(field.name) if field.name in present else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in schema
        ]
    )


def cast_strict(df: DataFrame, columns: Sequence[str], kind: str = "bigint") -> DataFrame:
    """Cast that fails the job on a bad value, whatever the session's ANSI mode."""

    def checked(name: str) -> Column:
        text = quoted(name)
        value = text.try_cast(kind)
        failed = text.isNotNull() & value.isNull()
        message = F.concat(F.lit(f"{name} is no {kind}: "), text.cast("string"))
        return F.when(failed, F.raise_error(message).cast(kind)).otherwise(value)

    return df.withColumns({name: checked(name) for name in columns})


def cast_coerce(df: DataFrame, column: str, kind: str = "double", drop: bool = True) -> DataFrame:
    """Cast with bad values to NULL, and by default without those rows."""
    result = df.withColumn(column, quoted(column).try_cast(kind))
    return result.where(quoted(column).isNotNull()) if drop else result


def _text_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]


def null_markers(df: DataFrame, marker: str = fv.MISSING_MARKER) -> DataFrame:
    """The missing marker becomes NULL in every text column."""
    return df.withColumns({n: F.nullif(quoted(n), F.lit(marker)) for n in _text_columns(df)})


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {n: F.coalesce(quoted(n), F.lit(0).cast(df.schema[n].dataType)) for n in columns}
    )


def strip_all_commas(df: DataFrame) -> DataFrame:
    return df.withColumns({n: strip_commas(quoted(n)) for n in _text_columns(df)})


def free_cash_flow(df: DataFrame) -> DataFrame:
    """Operating plus investing flows, in place of the published figure."""
    return df.withColumn(
        "free_cash_flow", F.col("operating_cash_flows") + F.col("investing_cash_flows")
    )


def reserve_sum(df: DataFrame) -> DataFrame:
    """Statutory and other capital reserve together, for cash and for stock."""
    kinds = ("capital_reserve_cash_dividend", "capital_reserve_stock_dividend")
    return df.withColumns({k: F.col(f"{k}_1") + F.col(f"{k}_2") for k in kinds}).drop(
        *[f"{k}_{part}" for k in kinds for part in (1, 2)]
    )


def stamp(df: DataFrame, ts: datetime | None = None) -> DataFrame:
    """Processing time of the rows; a given time makes a run repeatable."""
    return df.withColumn("insert_time", F.current_timestamp() if ts is None else F.lit(ts))


def null_column(df: DataFrame, name: str, kind: str = "double") -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(kind))
