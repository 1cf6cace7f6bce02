"""Runs of words that repeat with a period, found by minimizers of several scales.

A run is a stretch of words with smallest period q, at least max(6, 4 q) words long, that no
neighbouring word extends. A scale s covers the periods from (2 s - 1) / 3 to s. Each window
of s stretches of s words selects its least stretch by hash; a stretch of s words tells all
rotations of a period up to s apart, so inside a run each window selects the least rotation,
and its selections lie exactly one period apart: equal neighbours among the selections seed
a period. 2 s + q - 1 words, which a run of 4 q words has, hold two of them. Scales grow by
one half, up to a quarter of the longest text. Periods up to ``SHORT``, too short for a
window, are found by comparing the text with itself at each lag.

Seeds one period apart count once. Each is extended to both sides by prefix sums of hashes and
a binary search; a stretch of several periods is one run of its smallest. Words are compared
by 64-bit hashes.

The work of a text grows as its words by the logarithm of their number, whatever repeats.
Texts of a slice are searched together, parted by values that occur once; memory follows the
longest text.

Defined results: null, empty and blank texts have no words and no runs; texts of any length are
searched whole; runs of one text may overlap, and are ordered by start and period; repeated
rows, and rows with a null or repeated id, are each searched for themselves; an empty table
gives no rows. Only doc_id and text are read, further columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from barloom.llm import codes

SHORT = 8
LEAST_WORDS, LEAST_PERIODS = 6, 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id {}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def long_enough(length: np.ndarray, period: np.ndarray | int) -> np.ndarray:
    return length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)


def lag_scan(words: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the stretches that repeat at one lag, compared word by word."""
    equal = np.zeros(max(len(words) - lag, 0) + 2, np.int8)
    equal[1:-1] = words[lag:] == words[: len(equal) - 2]
    step = np.diff(equal)
    start = np.flatnonzero(step == 1)
    length = np.flatnonzero(step == -1) - start + lag
    found = long_enough(length, lag)
    return start[found], length[found]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window, by windows of doubling width."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Places of the least stretches of all windows; of equal ones in a window the first."""
    bits = np.uint64(len(grams).bit_length())
    placed = grams >> bits << bits | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_min(placed, width) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    fresh = np.ones(len(place), bool)
    fresh[1:] = place[1:] != place[:-1]
    return place[fresh]


def seeds(hashes: codes.SequenceHash, size: int, scale: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and lag of equal neighbouring minimizers, the first one of each chain."""
    if size < 2 * scale:
        return (np.zeros(0, np.int64),) * 2
    grams = hashes.fixed(scale)
    place = minimizers(grams, scale)
    value = grams[place]
    order = np.argsort(value, kind="stable")
    place, value = place[order], value[order]
    lag = np.diff(place)
    pair = (value[1:] == value[:-1]) & (lag >= low) & (lag <= scale)
    place, lag = place[:-1][pair], lag[pair]
    key = lag * (size + 1) + place
    first = ~np.isin(key - lag, key)
    return place[first], lag[first]


def extended(hashes: codes.SequenceHash, size: int, place: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the whole stretch that repeats at each seed's lag."""

    def furthest(most: np.ndarray, same) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            alike = same(middle)
            low, high = np.where(alike, middle, low), np.where(alike, high, middle - 1)
        return low

    right = furthest(size - place - lag, lambda n: hashes.same(place, place + lag, n))
    left = furthest(place, lambda n: hashes.same(place - n, place + lag - n, n))
    return place - left, left + right + lag


def find_runs(words: np.ndarray, edges: np.ndarray) -> Runs:
    """Start, length and period of all runs, by start and period.

    ``edges`` are the borders of the texts, of which each ends with a value that occurs once.
    """
    found: list[Runs] = []

    def keep(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> None:
        right = long_enough(length, period)
        found.append((start[right], length[right], period[right]))

    for lag in range(1, SHORT + 1):
        start, length = lag_scan(words, lag)
        keep(start, length, np.full(len(start), lag))

    sizes = np.diff(edges)
    origin = np.arange(len(words))
    low = SHORT + 1
    while len(sizes) and LEAST_PERIODS * low < sizes.max():
        held = sizes > LEAST_PERIODS * low  # with its last value
        if not held.all():
            held_words = np.repeat(held, sizes)
            words, origin, sizes = words[held_words], origin[held_words], sizes[held]
        scale = (3 * low + 1) // 2
        hashes = codes.SequenceHash(words)
        place, lag = seeds(hashes, len(words), scale, low)
        start, length = extended(hashes, len(words), place, lag)
        keep(origin[start], length, lag)
        low = scale + 1

    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[smallest], length[smallest], period[smallest]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def searched(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, Runs, np.ndarray, np.ndarray]:
    """Of the texts of a slice: numbers of words, borders of words, runs (start in the text), borders of runs, words kept."""
    rows = len(edges) - 1
    start, end, document = codes.word_spans(data, edges)
    counts = np.bincount(document, minlength=rows)
    borders = np.concatenate([[0], np.cumsum(counts + 1)])
    words = np.empty(borders[-1], np.uint64)
    last = np.zeros(len(words), bool)
    last[borders[1:] - 1] = True
    words[~last] = codes.RollingHash(data).spans(start, end)
    words[last] = codes.mixed(np.arange(1, rows + 1, dtype=np.uint64))
    first, length, period = find_runs(words, borders)
    dropped = np.zeros(len(words) + 1, np.int64)
    np.add.at(dropped, first + period, 1)
    np.add.at(dropped, first + length, -1)
    text = np.searchsorted(borders, first, "right") - 1
    runs = np.searchsorted(text, np.arange(rows + 1))
    return counts, borders, (first - borders[text], length, period), runs, np.cumsum(dropped)[:-1] == 0


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, edges in codes.text_slices(batch):
            counts, borders, runs, at, kept = searched(data, edges)
            raw = data.tobytes()
            collapsed = []
            for row in range(high - low):
                words = raw[edges[row] : edges[row + 1]].split()
                own = kept[borders[row] : borders[row + 1] - 1]
                collapsed.append(b" ".join(words if own.all() else [words[i] for i in np.flatnonzero(own)]))
            listed = pa.ListArray.from_arrays(
                pa.array(at, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in runs], fields=list(RUN))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(low, high - low), pa.array(counts, pa.int64()), listed, pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) and the text with each run's first period only."""
    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(_found, SCHEMA.format(kind))
