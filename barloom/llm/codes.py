"""Numpy helpers on Arrow batches of texts: slices, rolling hashes, words, shingles.

Texts of a batch are handled as one byte array with document borders, in slices of
about a megabyte, so that memory follows the longest document and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = np.asarray(values).astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: one odd 64-bit value per byte
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER)) | np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: the white space of the contracts: space and 0x09 to 0x0D
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts (or binaries) as one byte array and the borders of each; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, borders, data = column.buffers()
    edges = np.frombuffer(borders, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[edges[0] : edges[-1]], edges - edges[0]


def slices(edges: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, one row at least."""
    start, rows = 0, len(edges) - 1
    while start < rows:
        stop = int(np.searchsorted(edges, edges[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def text_slices(
    batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, borders) of each slice of a batch."""
    data, edges = text_bytes(batch.column(column))
    for start, stop in slices(edges, limit):
        yield start, stop, data[edges[start] : edges[stop]], edges[start : stop + 1] - edges[start]


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < size:
        inverse = pow(_MULTIPLIER, -1, 1 << 64)
        for place, base in enumerate((_MULTIPLIER, inverse)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _POWERS[place] = np.multiply.accumulate(steps)
    return _POWERS[0][:size], _POWERS[1][:size]


class RollingHash:
    """Polynomial hash of any stretch of a byte array from one pass of prefix sums."""

    def __init__(self, data: np.ndarray):
        powers, self._inverse = _powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * powers[:-1], out=self._sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for arrays of borders; equal stretches hash alike."""
        raw = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return mixed(raw + (end - start).astype(np.uint64) * np.uint64(_MULTIPLIER))

    def fixed(self, size: int) -> np.ndarray:
        """Hash of every stretch of ``size`` bytes, by start."""
        count = len(self._sums) - size
        if count <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self._sums[size:] - self._sums[:count]) * self._inverse[:count])


def word_spans(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word; white space and document borders part words."""
    inside = ~SPACE[data]
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    border = np.zeros(len(data) + 1, bool)
    border[edges] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | border[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | border[1:-1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(edges, start, "right") - 1


def word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word with A-Z lowered, and its document."""
    start, end, document = word_spans(data, edges)
    return RollingHash(LOWER[data]).spans(start, end), document


def shingles(words: np.ndarray, documents: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles by document, ordered by (document, hash).

    A document with fewer words has its whole sequence as its one shingle, one
    without words has none. Returns hashes and borders of the documents.
    """
    count = np.bincount(documents, minlength=rows)
    first = np.concatenate([[0], np.cumsum(count)])
    width = np.minimum(count, size)
    made = np.where(count > 0, count - width + 1, 0)
    document = np.repeat(np.arange(rows), made)
    borders = np.concatenate([[0], np.cumsum(made)])
    begin = first[document] + np.arange(len(document)) - borders[document]
    value = width[document].astype(np.uint64)
    for place in range(size):
        inside = place < width[document]
        word = words[np.where(inside, begin + place, 0)] if len(words) else value
        value = np.where(inside, mixed(value * np.uint64(_MULTIPLIER) + word), value)
    order = np.lexsort((value, document))
    value, document = value[order], document[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (document[1:] != document[:-1])
    value, document = value[fresh], document[fresh]
    return value, np.concatenate([[0], np.cumsum(np.bincount(document, minlength=rows))])


def gram_buckets(codes: np.ndarray, edges: np.ndarray, sizes: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: bucket of every n-gram by start, and whether it lies in one text."""
    room = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(codes))
    value = mixed(codes.astype(np.uint64) + np.uint64(1))
    running = np.zeros(len(codes), np.uint64)
    for length in range(1, max(sizes) + 1):
        shifted = value[length - 1 :]
        running = running[: len(shifted)] * np.uint64(_MULTIPLIER) + shifted
        if length in sizes:
            spread = (running ^ (running >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            bucket = (spread >> np.uint64(40)) % np.uint64(buckets)
            yield bucket.astype(np.int64), room[: len(bucket)] >= length


def packed(counts: np.ndarray) -> bytes:
    """Counts in the narrowest width that holds them, width first."""
    for kind in (np.uint8, np.uint16, np.uint32, np.uint64):
        if counts.max(initial=0) <= np.iinfo(kind).max:
            return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()
    raise ValueError("a count beyond 64 bits")


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def segment_sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive borders (empty stretches give 0)."""
    total = np.zeros(len(edges) - 1, np.float64)
    if len(values):
        filled = np.flatnonzero(np.diff(edges) > 0)
        if len(filled):
            total[filled] = np.add.reduceat(values, edges[:-1][filled], dtype=np.float64)
    return total


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts as one array, and the borders of each."""
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32), edges


class SequenceHash(RollingHash):
    """The rolling hash over 64-bit values, such as the hashes of words."""

    def __init__(self, values: np.ndarray):
        powers, self._inverse = _powers(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers[:-1], out=self._sums[1:])

    def same(self, one: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches of ``size`` values that start at ``one`` and ``other`` are alike."""
        left = (self._sums[one + size] - self._sums[one]) * self._inverse[one]
        return left == (self._sums[other + size] - self._sums[other]) * self._inverse[other]
