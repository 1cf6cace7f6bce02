"""Ordered work on long series without putting a whole series into one task.

A window over ``stock_code`` alone sends every row of a stock to one task. Here
a series is numbered first (:func:`running`: a window inside short calendar
buckets plus the totals of the buckets before), then cut into chunks of fixed
length (:func:`chunked`). Rows near a cut are copied into the neighbouring
chunk, so that trailing and leading frames see all rows they need; afterwards
:func:`own_rows` drops the copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

POSITION = "_position"
CHUNK = "_chunk"
OWN = "_own"
CHUNK_ROWS = 8192

_BUCKET = "_bucket"
_COMBINE = {
    "sum": (F.sum, lambda before, local: F.coalesce(before, F.lit(0)) + local),
    "max": (F.max, lambda before, local: F.coalesce(local, before)),
}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, tuple[str, Column]],
    bucket: Column | None = None,
) -> DataFrame:
    """Running ``sum`` or ``max`` from the start of each series up to each row.

    ``bucket`` must not decrease along ``order`` (default: the year of the first
    order column). Each bucket is one window partition; buckets are chained by
    their totals, one row per bucket. ``max`` expects values that do not decrease along ``order``, so
    that a later bucket always overrules an earlier one.
    """
    bucket = F.year(order[0]) if bucket is None else bucket
    frame = Window.unboundedPreceding, Window.currentRow
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(*order).rowsBetween(*frame)
    marked = df.withColumn(_BUCKET, bucket)

    totals = marked.groupBy(*keys, _BUCKET).agg(
        *[_COMBINE[kind][0](value).alias(f"_total_{name}") for name, (kind, value) in values.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        _BUCKET,
        *[
            _COMBINE[kind][0](f"_total_{name}").over(earlier).alias(f"_before_{name}")
            for name, (kind, _) in values.items()
        ],
    )

    local = marked.withColumns(
        {f"_local_{name}": _COMBINE[kind][0](value).over(inside) for name, (kind, value) in values.items()}
    )
    joined = local.join(carried, [*keys, _BUCKET], "inner")
    results = [
        _COMBINE[kind][1](F.col(f"_before_{name}"), F.col(f"_local_{name}")).alias(name)
        for name, (kind, _) in values.items()
    ]
    kept = [name for name in df.columns if name not in values]
    return joined.select(*kept, *results)


def with_position(
    df: DataFrame,
    keys: Sequence[str] = ("stock_code",),
    order: Sequence[str] = ("data_date",),
    bucket: Column | None = None,
) -> DataFrame:
    """Number the rows of each series from 1. Keys and order must not be NULL."""
    return running(df, keys, order, {POSITION: ("sum", F.lit(1))}, bucket)


def with_last_marked(
    df: DataFrame,
    marks: dict[str, Column],
    keys: Sequence[str] = ("stock_code",),
    order: Sequence[str] = ("data_date",),
) -> DataFrame:
    """Number the rows of each series, and give for each mark the position of the last row
    up to here that has it (0 for none), all from one ordered pass over the buckets."""
    frame = Window.unboundedPreceding, Window.currentRow
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(*order).rowsBetween(*frame)
    local = df.withColumn(_BUCKET, F.year(order[0])).withColumn(POSITION, F.count(F.lit(1)).over(inside))
    local = local.withColumns({n: F.max(F.when(mark, F.col(POSITION))).over(inside) for n, mark in marks.items()})
    totals = local.groupBy(*keys, _BUCKET).agg(F.max(POSITION).alias("_rows"), *[F.max(n).alias(f"_last_{n}") for n in marks])
    earlier = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    carried = before.select(
        *keys, _BUCKET, "_before", *[F.max(F.col("_before") + F.col(f"_last_{n}")).over(earlier).alias(f"_carried_{n}") for n in marks]
    )
    joined = local.join(carried, [*keys, _BUCKET])
    return joined.select(
        *df.columns,
        (F.col("_before") + F.col(POSITION)).alias(POSITION),
        *[F.coalesce(F.col("_before") + F.col(n), F.col(f"_carried_{n}"), F.lit(0)).alias(n) for n in marks],
    )


def chunked(
    df: DataFrame,
    keys: Sequence[str] = ("stock_code",),
    order: Sequence[str] = ("data_date",),
    before: int = 0,
    after: int = 0,
    chunk_rows: int = CHUNK_ROWS,
) -> tuple[DataFrame, WindowSpec]:
    """Cut numbered series into chunks that also hold their neighbours' edge rows.

    Returns the rows (with ``_position``, ``_chunk``, ``_own``) and the window
    that orders one chunk. A frame reaching ``before`` rows back or ``after``
    rows ahead is complete on every own row.
    """
    numbered = df if POSITION in df.columns else with_position(df, keys, order)
    index = F.col(POSITION) - 1

    def chunk_of(row: Column) -> Column:
        return F.floor(row / chunk_rows)

    if before or after:
        first = chunk_of(F.greatest(index - after, F.lit(0)))
        targets = F.sequence(first, chunk_of(index + before))
        numbered = numbered.withColumn(CHUNK, F.explode_outer(targets))
    else:
        numbered = numbered.withColumn(CHUNK, chunk_of(index))
    rows = numbered.withColumn(OWN, F.col(CHUNK) == chunk_of(index))
    return rows, Window.partitionBy(*keys, CHUNK).orderBy(POSITION)


def own_rows(df: DataFrame, keep_position: bool = False) -> DataFrame:
    """Drop the copied edge rows and the helper columns. A kept position spares the next
    :func:`chunked` the numbering."""
    own = df.where(OWN).drop(CHUNK, OWN)
    return own if keep_position else own.drop(POSITION)
