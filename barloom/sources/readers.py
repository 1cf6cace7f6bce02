"""Readers and parsers of landed files."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from barloom import fixed_values as fv, schemas
from barloom.operators.filters import between_dates, drop_label
from barloom.operators.sets import union_all

CORRUPT = "_corrupt_record"


def read_prices(
    spark: SparkSession,
    path: str,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """Daily bars of a date range: years without a day of it are not opened, and the range
    itself reaches the scan of the others."""
    whole = T.StructType([*schemas.STOCK_PRICE.fields, T.StructField("data_year", T.IntegerType())])
    prices = between_dates(spark.read.schema(whole).parquet(path), start, end)
    for day, after in ((start, True), (end, False)):
        if day is not None:
            year = F.lit(int(str(day)[:4]))
            prices = prices.where(F.col("data_year") >= year if after else F.col("data_year") <= year)
    return prices


def parse_quotes(df: DataFrame, column: str) -> DataFrame:
    """Quotes inside a JSON payload, one row each; absent fields are NULL.

    A payload without quotes keeps its row with NULL fields. Other columns stay.
    """
    payload = F.from_json(column, schemas.QUOTE_PAYLOAD)
    rest = [name for name in df.columns if name != column]
    exploded = df.select(*rest, F.explode_outer(payload["msgArray"]).alias("_q"))
    return exploded.select(*rest, "_q.*")


def json_fields(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """Fields of a JSON object beside the other columns."""
    rest = [name for name in df.columns if name != column]
    return df.select(*rest, F.from_json(column, schema).alias("_j")).select(*rest, "_j.*")


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, **options: str
) -> DataFrame:
    """CSV as text columns; unparsable lines land in ``_corrupt_record``."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    reader = spark.read.schema(full).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).options(**options)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def report_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of landed report files: ``file``, ``line_no`` from 0, ``value``. A report is one
    file of one day and one market, so each is read whole and keeps its order."""
    whole = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    named = whole.select(F.col("_metadata.file_path").alias("file"), F.split("value", "\r?\n").alias("lines"))
    return named.select("file", F.posexplode("lines").alias("line_no", "value"))


def report_heading(lines: DataFrame, title_lines: int = 1) -> list[str]:
    """Column names of the reports, from the line behind the title lines of any one of them."""
    first = lines.where(F.col("line_no") == title_lines).select("value").first()
    if first is None:
        raise ValueError(f"no report has a line behind {title_lines} title lines")
    return next(csv.reader([first["value"]]))


def report_rows(lines: DataFrame, title_lines: int = 1, names: Sequence[str] | None = None) -> DataFrame:
    """Rows of reports as text columns beside ``file`` and ``line_no``: title lines, heading
    and empty lines are left out; fields a line lacks are NULL."""
    names = report_heading(lines, title_lines) if names is None else list(names)
    ddl = ", ".join(f"`{name}` string" for name in names)
    body = lines.where((F.col("line_no") > title_lines) & (F.length("value") > 0))
    parsed = F.from_csv("value", ddl, {"quote": '"'})
    return body.select("file", "line_no", parsed.alias("_r")).select(
        "file", "line_no", *[F.col(f"_r.`{name}`") for name in names]
    )


def clean_csv(df: DataFrame) -> DataFrame:
    """Without columns that are NULL throughout, then without rows that miss a value.

    Which columns are empty is known only from the data: one aggregate over the
    input decides it, and only its single row of counts reaches the driver.
    """
    names = [name for name in df.columns if name != CORRUPT]
    if not names:
        return df
    counts = df.agg(*[F.count(F.col(f"`{n}`")).alias(f"c{i}") for i, n in enumerate(names)]).first()
    filled = [name for i, name in enumerate(names) if counts[f"c{i}"]]
    return df.select([F.col(f"`{n}`") for n in filled]).dropna("any")


def parse_quoted(lines: DataFrame, names: Sequence[str], column: str = "value") -> DataFrame:
    """Lines of quoted fields; the heading line and empty lines go, commas in numbers too."""
    schema = T.StructType([T.StructField(name, T.StringType(), True) for name in names])
    ddl = ", ".join(f"`{field.name}` string" for field in schema)
    parsed = F.from_csv(column, ddl, {"quote": '"'})
    rest = [name for name in lines.columns if name != column]
    rows = lines.where(F.length(column) > 0).select(*rest, parsed.alias("_r"))
    fields = [F.replace(F.col(f"_r.`{n}`"), F.lit(","), F.lit("")).alias(n) for n in names]
    return drop_header_rows(rows.select(*rest, *fields), names[0], names[0])


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """One feed per market or industry as one frame; missing columns become NULL."""
    return union_all(feeds)


def drop_header_rows(df: DataFrame, column: str, label: str = fv.CODE_HEADING) -> DataFrame:
    """Without header rows repeated inside the data."""
    return drop_label(df, column, label)


def _failures(casts: dict[str, str]) -> Column:
    """Names of a row's columns that do not cast as asked, "" for none."""

    def failed(name: str, kind: str) -> Column:
        text = F.col(f"`{name}`")
        return text.isNotNull() & text.try_cast(kind).isNull()

    return F.concat_ws(",", *[F.when(failed(name, kind), F.lit(name)) for name, kind in casts.items()])


def checked(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """All rows in one pass: columns cast as asked, ``failed_columns`` where some do not
    (NULL where all do), and the texts as they came in ``landed``."""
    landed = F.struct(*[F.col(f"`{name}`") for name in casts])
    marked = df.withColumns({"failed_columns": F.nullif(_failures(casts), F.lit("")), "landed": landed})
    return marked.withColumns({name: F.col(f"`{name}`").try_cast(kind) for name, kind in casts.items()})


def dead_letter(df: DataFrame, casts: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose columns cast as asked, and the rows that fail with the reason, for two
    destinations. Where one pass must do, take :func:`checked`."""
    reasons = _failures(casts)
    good = df.where(reasons == "").withColumns(
        {name: F.col(f"`{name}`").try_cast(kind) for name, kind in casts.items()}
    )
    bad = df.withColumn("failed_columns", reasons).where(F.col("failed_columns") != "")
    return good, bad
