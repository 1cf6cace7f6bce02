"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.session import exists, work_folder
from barloom.sources import versions

YEAR = "data_year"


def append(df: DataFrame, path: str, date_column: str = "data_date") -> None:
    """Append to a table partitioned by year. Rows meet their year before the write,
    several tasks per year where a year is large, so that files stay few."""
    (
        df.withColumn(YEAR, F.year(date_column))
        .hint("rebalance", YEAR)
        .write.mode("append")
        .partitionBy(YEAR)
        .parquet(path)
    )


def replace(df: DataFrame, path: str) -> None:
    """Replace a whole table by the frame, which may read the version it replaces.

    Readers go on with the old version until the new one is complete (``versions.read``).
    """
    versions.publish(df, path)


def upsert_days(df: DataFrame, path: str, column: str = "data_date") -> None:
    """Replace only the days the frame holds, so that a repeated load adds nothing.

    The table is the one :func:`append` writes. The years concerned are written aside first,
    without the days that come anew, and then take the place of the old ones.
    """
    spark = df.sparkSession
    aside = work_folder(spark, "upsert")
    new = df.withColumn(YEAR, F.year(column))
    new.hint("rebalance", YEAR).write.partitionBy(YEAR).parquet(f"{aside}/new")
    new = spark.read.schema(new.schema).parquet(f"{aside}/new")
    if not exists(spark, path):
        append(new.drop(YEAR), path, column)
        return
    # as many as the calendar has
    years = [row[YEAR] for row in new.select(YEAR).distinct().collect()]
    days = new.select(column).distinct()
    kept = spark.read.schema(new.schema).parquet(path).where(F.col(YEAR).isin(years)).join(days, column, "left_anti")
    whole = kept.select(*new.columns).unionByName(new)
    whole.hint("rebalance", YEAR).write.partitionBy(YEAR).parquet(f"{aside}/whole")
    (
        spark.read.schema(new.schema).parquet(f"{aside}/whole")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(YEAR)
        .parquet(path)
    )


def export(
    posts: DataFrame, comments: DataFrame, folder: str, fmt: str, key: str = "post_id"
) -> None:
    """Posts and their comments as files.

    ``txt``: each post its own text file, each post's comments their own csv folder (one
    file unless they are very many). ``csv``: one csv table of posts, one of comments.
    """
    if fmt == "txt":
        posts.select(key, "text").write.partitionBy(key).text(f"{folder}/posts")
        _csv(comments.hint("rebalance", key), f"{folder}/comments", [key])
    elif fmt == "csv":
        _csv(posts, f"{folder}/posts")
        _csv(comments, f"{folder}/comments")
    else:
        raise ValueError(f"format must be txt or csv, not {fmt!r}")


def _csv(df: DataFrame, path: str, partitions: Sequence[str | Column] = ()) -> None:
    writer = df.write.options(header=True, quoteAll=True, escape='"', emptyValue="")
    (writer.partitionBy(*partitions) if partitions else writer).csv(path)
