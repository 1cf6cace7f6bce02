"""Keyword search in a stored index of trigrams: pages of articles without reading the articles.

:func:`build` puts the articles in order of their key and deals them, by range, to parts of about
``PART_ROWS`` rows; a row is known by its part and its place there. Every place of a text begins a
trigram, three code points as one whole number (behind the end of a text there are zeros). For
every part a trigram has its hits, row and place of each, as lists of the steps from hit to hit,
small whole numbers that take a byte or two; a part may have several lists. A task reads some parts
and writes the lists of a trigram in all that it holds, part after part, as one row, so that small
parts do not make more rows. Hits stay in the task that found them: it puts its rows in order of
their trigrams and writes them to a file of its own, of which a search reads the pages that hold its
keyword's trigrams only.

A keyword of three signs and more is in a row where its trigrams, every third one and the last,
follow each other; a shorter one begins a range of trigrams. The hits of a part meet in one row,
so what a task holds is bounded by the part. A page begins in the part where the matches of the
parts before it reach its start: only the parts and rows of a page are read.

Keywords are found as they are written, also inside of words. Null and empty texts match nothing;
repeated rows are rows of their own; rows of equal keys have an order of their own, by a hash of
their text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

PART_ROWS = 50_000
_FLUSH = 1 << 21  # signs a task holds before it writes their hits
_BITS = 21  # of a code point
_STORED = "gram long, part long, parts binary, hits binary"


def _packed(signs: np.ndarray) -> np.ndarray:
    """The trigram at every place but the last two."""
    return signs[:-2] << 2 * _BITS | signs[1:-1] << _BITS | signs[2:]


def _coded(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers as bytes of seven bits, the lowest first and all but the last of a number marked, and the bytes of each."""
    size = np.ones(len(numbers), np.int64)
    rest = numbers >> 7
    while rest.any():
        size += rest > 0
        rest >>= 7
    begin = np.cumsum(size) - size
    data = np.empty(size.sum(), np.uint8)
    for nth in range(int(size.max(initial=0))):
        some = size > nth
        data[begin[some] + nth] = numbers[some] >> 7 * nth & 127 | (size[some] > nth + 1) << 7
    return data, size


def _lists(gram: np.ndarray, row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hits of each trigram as bytes, from hits by trigram, row and place: trigrams, bytes of all, and their borders.

    A list tells the steps from row to row, doubled and one more, each followed by the steps from
    place to place in the row, doubled; the first row of a list is a step from -1, the first place of a row from 0.
    """
    fresh = np.concatenate([[True], gram[1:] != gram[:-1]])
    turns = np.concatenate([[True], row[1:] != row[:-1]]) | fresh
    steps = np.where(fresh, row + 1, np.diff(row, prepend=0))
    moves = np.where(turns, place, np.diff(place, prepend=0))
    at = np.arange(len(gram)) + np.cumsum(turns)
    numbers = np.empty(len(gram) + turns.sum(), np.int64)
    numbers[at] = moves << 1
    numbers[at[turns] - 1] = steps[turns] << 1 | 1
    data, size = _coded(numbers)
    first = np.flatnonzero(fresh)
    behind = np.concatenate([[0], np.cumsum(size)])
    return gram[first], data, behind[np.append(at[first] - 1, len(numbers))]


def _decoded(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The whole numbers of lists of bytes, and the borders of the lists."""
    begins = np.concatenate([[True], data[:-1] < 128])[: len(data)]
    start = np.flatnonzero(begins)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(len(borders), np.int64)
    nth = np.arange(len(data)) - start[np.cumsum(begins) - 1]
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * nth, start), np.searchsorted(start, borders)


def _unpacked(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hits, row << 32 and place, of lists of bytes, and the borders of the lists."""
    numbers, of_list = _decoded(data, borders)
    if not len(numbers):
        return numbers, of_list
    turns, numbers = numbers & 1 > 0, numbers >> 1
    steps = np.cumsum(np.where(turns, numbers, 0))
    row = steps - np.repeat(np.concatenate([[0], steps])[of_list[:-1]], np.diff(of_list)) - 1
    moves = np.cumsum(np.where(turns, 0, numbers))
    place = moves - moves[np.maximum.accumulate(np.where(turns, np.arange(len(turns)), 0))]
    return (row << 32 | place)[~turns], np.concatenate([[0], np.cumsum(~turns)])[of_list]


def _grouped(gram: np.ndarray, part: np.ndarray, row: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """The lists of each trigram as one row, from hits by trigram, part, row and place.

    ``parts`` tells for each list the step to its part, from the row's first, and its bytes among the ``hits``.
    """
    fresh = np.concatenate([[True], (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])])
    first = np.flatnonzero(fresh)
    _, data, borders = _lists(np.cumsum(fresh), row, place)
    gram, part = gram[first], part[first]
    top = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    steps = np.diff(part, prepend=0)
    steps[top] = 0
    told, size = _coded(np.stack([steps, np.diff(borders)], 1).ravel())
    behind = np.concatenate([[0], np.cumsum(size)])[::2]

    def lists(data: np.ndarray, borders: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(top), [None, pa.py_buffer(borders[np.append(top, len(first))].astype(np.int32)), pa.py_buffer(data)])

    return pa.RecordBatch.from_arrays([pa.array(gram[top]), pa.array(part[top]), lists(told, behind), lists(data, borders)], ["gram", "part", "parts", "hits"])


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of hits of the parts of a task. It holds ``_FLUSH`` signs."""
    held: list[tuple[int, int, int, np.ndarray]] = []
    size = 0

    def written() -> pa.RecordBatch:
        held.sort(key=lambda x: x[:3])
        length = [len(g) for *_, g in held]
        part, row = (np.repeat(np.array([x[n] for x in held], np.int64), length) for n in (0, 1))
        gram = np.concatenate([g for *_, g in held])
        place = np.concatenate([np.arange(low, low + n, dtype=np.int64) for (_, _, low, _), n in zip(held, length, strict=True)])
        held.clear()
        order = np.argsort(gram, kind="stable")
        return _grouped(gram[order], part[order], row[order], place[order])

    for batch in batches:
        for low in range(0, len(batch), 256):
            some = batch.slice(low, 256)
            for part, row, text in zip(*(some.column(x).to_pylist() for x in ("part", "row", "text")), strict=True):
                if not text:
                    continue
                signs = np.frombuffer(f"{text}\0\0".encode("utf-32-le", "surrogatepass"), np.uint32)
                for at in range(0, len(signs) - 2, _FLUSH):
                    held.append((part, row, at, _packed(signs[at : at + _FLUSH + 2].astype(np.int64))))
                    size += len(held[-1][-1])
                    if size >= _FLUSH:
                        yield written()
                        size = 0
    if held:
        yield written()


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of hits of one part as arrays, those of some ``_FLUSH`` bytes at a time."""
    for batch in batches:
        every, told = (batch.column(x).to_pylist() for x in ("hits", "parts"))
        behind = np.cumsum([len(x) for x in every], dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(behind // _FLUSH)) + 1).tolist(), len(batch)]
        for low, high in pairwise(cuts):
            if low < high:
                edges = np.concatenate([[0], np.cumsum([len(x) for x in told[low:high]])])
                numbers, edges = _decoded(np.frombuffer(b"".join(told[low:high]), np.uint8), edges)
                first, count = edges[:-1] // 2, np.diff(edges) // 2
                passed = np.cumsum(numbers[::2])
                gram, part = (batch.column(x).to_numpy()[low:high] for x in ("gram", "part"))
                borders = np.concatenate([[0], np.cumsum(numbers[1::2])])
                hits, own = _unpacked(np.frombuffer(b"".join(every[low:high]), np.uint8), borders)
                lists = pa.ListArray.from_arrays(pa.array(own, pa.int32()), pa.array(hits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(gram, count)), pa.array(np.repeat(part - passed[first], count) + passed), lists], ["gram", "part", "hits"]
                )


def build(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", part_rows: int = PART_ROWS) -> None:
    """Write articles and index below ``folder``."""
    spark = docs.sparkSession
    parts = max(1, -(-docs.count() // part_rows))
    tie = F.xxhash64(text)
    ordered = docs.repartitionByRange(parts, F.col(key), tie).sortWithinPartitions(F.col(key), tie)
    number = F.monotonically_increasing_id()
    placed = ordered.select(*docs.columns, F.shiftright(number, 33).alias("part"), number.bitwiseAND(F.lit((1 << 33) - 1)).alias("row"))
    placed.write.option("compression", "zstd").partitionBy("part").parquet(f"{folder}/articles")
    # a table without rows has no files that could tell
    spark.range(1).select(F.lit(placed.schema.json())).write.text(f"{folder}/schema")
    texts = _articles(spark, folder).select("part", "row", F.col(text).alias("text"))
    hits = texts.mapInArrow(_hits, _STORED)
    hits.sortWithinPartitions("gram", "part").write.option("compression", "zstd").parquet(f"{folder}/hits")


def _articles(spark: SparkSession, folder: str) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{folder}/schema").first()[0]))
    return spark.read.schema(schema).parquet(f"{folder}/articles")


def matches(spark: SparkSession, folder: str, word: str) -> DataFrame:
    """part and the rows of it that hold the keyword, ascending."""
    if not word:
        raise ValueError("a keyword has one sign at least")
    hits = spark.read.schema(_STORED).parquet(f"{folder}/hits")

    def opened(lists: DataFrame) -> DataFrame:
        return lists.mapInArrow(_opened, "gram long, part long, hits array<long>")

    signs = np.array([ord(c) for c in word], np.int64)
    if len(signs) < 3:
        low = int(sum(s << (2 - i) * _BITS for i, s in enumerate(signs.tolist())))
        found = opened(hits.where(F.col("gram").between(low, low + (1 << (3 - len(signs)) * _BITS) - 1)))
        rows = F.array_distinct(F.flatten(F.collect_list(F.array_distinct(F.transform("hits", lambda x: F.shiftright(x, 32))))))
        return found.groupBy("part").agg(F.array_sort(rows).alias("rows"))
    grams = _packed(signs).tolist()
    offsets = sorted({*range(0, len(grams), 3), len(grams) - 1})
    chosen = opened(hits.where(F.col("gram").isin(sorted({grams[at] for at in offsets}))))

    def starts_by(at: int) -> Column:
        """Where the keyword would begin, by the hits of its trigram at this place."""
        return F.flatten(F.collect_list(F.when(F.col("gram") == grams[at], F.transform("hits", lambda x: x - at))))

    of_part = chosen.groupBy("part").agg(*(starts_by(at).alias(f"at_{at}") for at in offsets))
    starts = F.col(f"at_{offsets[0]}")
    for at in offsets[1:]:
        starts = F.array_intersect(starts, F.col(f"at_{at}"))
    rows = F.array_sort(F.array_distinct(F.transform(starts, lambda x: F.shiftright(x, 32))))
    return of_part.select("part", rows.alias("rows")).where(F.size("rows") > 0)


def pages(spark: SparkSession, folder: str, word: str, first_page: int, last_page: int, page_size: int = 20, key: str = "doc_id") -> DataFrame:
    """The articles of pages ``first_page`` to ``last_page`` (from 1) of those that hold the keyword, by key."""
    low, high = (first_page - 1) * page_size, last_page * page_size
    found = matches(spark, folder, word).withColumn("n", F.size("rows").cast("long"))
    # one row per part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = found.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    own = counted.where((F.col("before") < high) & (F.col("before") + F.col("n") > low))
    start = F.greatest(F.lit(low) - F.col("before"), F.lit(0)).cast("int")
    stop = F.least(F.lit(high) - F.col("before"), F.col("n")).cast("int")
    wanted = own.select("part", F.explode(F.slice("rows", start + 1, stop - start)).alias("row")).collect()  # the rows of the pages
    articles = _articles(spark, folder)
    rows = spark.createDataFrame([tuple(r) for r in wanted], "part long, row long")
    read = articles.where(F.col("part").isin(sorted({r["part"] for r in wanted})) & F.col("row").isin(sorted({r["row"] for r in wanted})))
    names = [x for x in articles.columns if x not in ("part", "row")]
    return read.join(F.broadcast(rows), ["part", "row"]).orderBy("part", "row").select(*names)
