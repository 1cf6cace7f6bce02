"""Scoring texts with a small causal self-attention model on subword ids, beside a word baseline.

Words are runs without white space, A-Z lowered; every text ends with one end mark. The
baseline is the smoothed unigram model of words over all training texts.

The model reads subword ids: every word, after a space, through a public byte-level
vocabulary (a file, its path is a parameter), then one end id. The probability of a subword
is that of its class given what precedes it, from one layer of masked self-attention, times
its share of the class. Classes hold about equal shares of all training subwords, so shares
and classes follow the counts of the whole training corpus. The attention weights are learned
in the tasks by Adam, from common starting weights: each of ``ROUNDS`` rounds takes the
training documents of its own part of the hashes of ids, so that every one teaches once, and
after each round the tasks' weights are averaged, weighted by subwords learned. A document is
learned from in windows side by side, so that every one of its subwords teaches once. What is
learned from and gathered so grows with the corpus, while the model itself has a fixed size.
Logits of attention and of classes are held within ``LARGEST`` of 0, so that exponentials need no
maximum of their row.

Texts are scored in windows of ``WINDOW`` subwords that overlap, every subword once: all of
the first window, and the last ``STRIDE`` of each later one, with at least WINDOW - STRIDE
subwords before it. Windows of many texts form one masked batch.

Word counts have one row per distinct word and stay distributed. The ``FREQUENT`` most
frequent words or somewhat fewer, a table of bounded size, go to the tasks with their subwords; the other words of
a text are joined with the counts. Words meet by 64-bit hash. Once words are counted, every text is
read once more, into a stored table of its subword ids and what its frequent words give; learning
and scoring read that table. The ``COMMON_IDS`` most frequent
subword ids have an input vector each; rarer ones share ``SHARED_IDS`` vectors by their number.

A null text is an empty text: its one token is the end. Repeated rows are scored, and
learned from, each for itself. Without any training text, the baseline is uniform and so is
the model. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import codes
from barloom.llm.toxicity import remainder
from barloom.llm.work import stored

END_WORD = "\n"  # no word: words hold no white space
SMOOTHING = 0.1
FREQUENT = 1 << 20
CLASSES = 64
WIDTH = 16
WINDOW = 24
STRIDE = 18
COMMON_IDS = 4096
SHARED_IDS = 1024
ROUNDS = 2
TRAIN_SHARE = ROUNDS  # one document of so many in each round, so that the rounds part them all
RATE = 0.01
BATCH = 128
SCORE_BATCH = 256
LARGEST = 40.0
WEIGHT_BLOCK = 1 << 13
COUNTED_BYTES = 1 << 23  # of text whose words are counted together

#: split of a text before byte pairs are merged, fixed by the vocabulary: of words, and of white space
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
SPACE_PATTERN = r"\s+(?!\S)|\s+"
FOREIGN_SPACE = re.compile(r"[^\S ]")


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str = f"{WORD_PATTERN}|{SPACE_PATTERN}") -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(number) for token, number in map(bytes.split, lines)}
    return tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def subword_count(path: str) -> int:
    """Number of ids; the end id is the one behind them."""
    return _encoding(path).n_vocab


class Subwords:
    """Ids of words, all words of a slice in one call."""

    def __init__(self, path: str):
        encoding = _encoding(path)
        self._encode = encoding.encode_ordinary
        self._encode_row = _encoding(path, WORD_PATTERN).encode_to_numpy
        self.end = encoding.n_vocab
        self._sizes = np.array([len(encoding.decode_single_token_bytes(i)) for i in range(self.end)])

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a list of words one after another, and their borders.

        A space parts words for the vocabulary too, so a row of words has the ids of its
        words, one after another, and no white space but the space before a word, which the
        pattern of words covers. That does not hold for words with white space of other
        scripts inside, which are read one by one.
        """
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        row = b" ".join(words).decode()
        if FOREIGN_SPACE.search(row):
            found = [self._encode(f" {word.decode()}") for word in words]
            edges = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])
            return np.fromiter((i for ids in found for i in ids), np.int64, edges[-1]), edges
        ids = self._encode_row(f" {row}").astype(np.int64)
        begin = np.cumsum(self._sizes[ids]) - self._sizes[ids]
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        return ids, np.concatenate([[0], np.searchsorted(begin, ends)])


def stretches(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of stretches of an array, one stretch after another."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class Words:
    """The words of a slice: distinct ones, and which one stands at each place of each document."""

    hashes: np.ndarray
    lowered: np.ndarray
    start: np.ndarray
    end: np.ndarray
    number: np.ndarray
    borders: np.ndarray

    @property
    def texts(self) -> list[bytes]:
        return self.some(slice(None))

    def some(self, which: np.ndarray | slice) -> list[bytes]:
        """Some of the distinct words."""
        raw = self.lowered.tobytes()
        return [raw[a:b] for a, b in zip(self.start[which].tolist(), self.end[which].tolist(), strict=True)]


def slice_words(data: np.ndarray, edges: np.ndarray) -> Words:
    lowered = codes.LOWER[data]
    start, end, document = codes.word_spans(data, edges)
    hashes = codes.RollingHash(lowered).spans(start, end)
    number, distinct = pd.factorize(hashes)
    first = np.empty(len(distinct), np.int64)
    first[number[::-1]] = np.arange(len(number))[::-1]
    borders = np.concatenate([[0], np.cumsum(np.bincount(document, minlength=len(edges) - 1))])
    return Words(distinct, lowered, start[first], end[first], number, borders)


def end_hash() -> int:
    data = np.frombuffer(END_WORD.encode(), np.uint8)
    return int(codes.RollingHash(data).spans(np.array([0]), np.array([len(data)]))[0].view(np.int64))


def counted_together(held: list[tuple[Words, np.ndarray]]) -> pa.RecordBatch:
    """hash, word and count of every distinct word of some slices, each given with the counts of its words."""
    number, hashes = pd.factorize(np.concatenate([words.hashes for words, _ in held]))
    count = np.zeros(len(hashes), np.int64)
    np.add.at(count, number, np.concatenate([count for _, count in held]))
    first = np.empty(len(hashes), np.int64)
    first[number[::-1]] = np.arange(len(number))[::-1]
    lowered = np.concatenate([words.lowered for words, _ in held])
    shift = np.cumsum([0, *(len(words.lowered) for words, _ in held)])
    start, end = (np.concatenate([getattr(words, name) + at for (words, _), at in zip(held, shift[:-1], strict=True)])[first] for name in ("start", "end"))
    borders = np.concatenate([[0], np.cumsum(end - start)])
    data = lowered[stretches(start, end - start)]
    texts = pa.Array.from_buffers(pa.large_string(), len(hashes), [None, pa.py_buffer(borders), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), texts.cast(pa.string()), pa.array(count)], ["hash", "word", "count"])


def count_words(texts: DataFrame) -> DataFrame:
    """hash, word and count of every distinct word of all texts, the end mark among them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, held, size = 0, [], 0
        for batch in batches:
            for start, stop, data, edges in codes.text_slices(batch):
                ends += stop - start
                words = slice_words(data, edges)
                held.append((words, np.bincount(words.number, minlength=len(words.hashes))))
                words.number = None
                size += len(data)
                if size >= COUNTED_BYTES:
                    yield counted_together(held)
                    held, size = [], 0
        if held:
            yield counted_together(held)
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([end_hash()]), pa.array([END_WORD]), pa.array([ends])], ["hash", "word", "count"])

    rows = texts.select("text").mapInArrow(counted, "hash long, word string, count long")
    return rows.groupBy("hash", "word").agg(F.sum("count").alias("count"))


def count_subwords(words: DataFrame, path: str) -> np.ndarray:
    """Occurrences of every subword id in the training texts, from the word counts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = Subwords(path)
        total = np.zeros(subwords.end + 1, np.int64)
        for batch in batches:
            words, count = batch.column("word").to_pylist(), batch.column("count").to_numpy()
            real = np.array([word != END_WORD for word in words], bool)
            total[subwords.end] += count[~real].sum()
            ids, edges = subwords.of([word.encode() for word in words if word != END_WORD])
            each = np.repeat(count[real], np.diff(edges))
            total[: subwords.end] += np.bincount(ids, each, minlength=subwords.end).astype(np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "count"])

    rows = words.mapInArrow(counted, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))
    total = np.zeros(subword_count(path) + 1, np.int64)
    for row in rows.toLocalIterator():
        total[row["id"]] = row["count"]
    return total


@dataclass
class Lexicon:
    """Class and log share of every subword id, its row in the table of input vectors, and the log share of every class."""

    group: np.ndarray
    share: np.ndarray
    row: np.ndarray
    prior: np.ndarray


def lexicon(counts: np.ndarray) -> Lexicon:
    """Classes of about equal mass by falling count; every id has a share, however rare."""
    mass = counts + 0.1
    order = np.argsort(-mass, kind="stable")
    before = np.cumsum(mass[order]) - mass[order]
    group = np.empty(len(counts), np.int64)
    group[order] = np.minimum((before / mass.sum() * CLASSES).astype(np.int64), CLASSES - 1)
    whole = np.bincount(group, mass, minlength=CLASSES)
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    row = np.where(rank < COMMON_IDS, rank, COMMON_IDS + np.arange(len(counts)) % SHARED_IDS)
    prior = np.log((whole + 0.1) / (whole + 0.1).sum())
    return Lexicon(group, np.log(mass) - np.log(whole[group]), row, prior)


_SHAPES = {
    "vectors": (COMMON_IDS + SHARED_IDS, WIDTH),
    "places": (WINDOW, WIDTH),
    "ask": (WIDTH, WIDTH),
    "key": (WIDTH, WIDTH),
    "value": (WIDTH, WIDTH),
    "mix": (WIDTH, WIDTH),
    "out": (WIDTH, CLASSES),
    "bias": (CLASSES,),
}
_SIZE = sum(math.prod(x) for x in _SHAPES.values())
_BEFORE = np.tril(np.ones((WINDOW, WINDOW), np.float32))
_PAIRS = np.arange((COMMON_IDS + SHARED_IDS) * WIDTH // 2).reshape(-1, WIDTH // 2)


def parts(weights: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the flat weights by name."""
    found, at = {}, 0
    for name, shape in _SHAPES.items():
        size = math.prod(shape)
        found[name] = weights[at : at + size].reshape(shape)
        at += size
    return found


def first_weights(prior: np.ndarray | None = None) -> np.ndarray:
    """Small fixed pseudo-random weights; the bias holds the classes' log shares."""
    noise = (codes.mixed(np.arange(1, _SIZE + 1, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) / (1 << 53) - 0.5
    weights = (noise * 0.5).astype(np.float32)
    parts(weights)["bias"][:] = 0 if prior is None else prior
    return weights


def _flat(x: np.ndarray) -> np.ndarray:
    return x.reshape(-1, x.shape[-1])


class Room:
    """Arrays that batches use one after another, so that no batch asks the system for memory anew."""

    def __init__(self):
        self._held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, ...], kind: np.dtype) -> np.ndarray:
        size = math.prod(shape)
        held = self._held.get(name)
        if held is None or held.size < size or held.dtype != kind:
            held = self._held[name] = np.empty(size, kind)
        return held[:size].reshape(shape)


def _merged(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The two maps that attention comes to: from input to what asks for inputs, and from seen inputs to states."""
    return (w["ask"] * WIDTH**-0.5 @ w["key"].T).astype(w["ask"].dtype), w["value"] @ w["mix"]


def _attended(w: dict[str, np.ndarray], rows: np.ndarray, room: Room | None = None, skip: int = 0) -> tuple[np.ndarray, ...]:
    """State after each place of windows of input rows but the first ``skip``, and what learning needs again.

    The results are arrays of the room, good until it is used again.
    """
    room, kind, count = room or Room(), w["vectors"].dtype, len(rows)
    asks, gives = _merged(w)
    x = np.take(w["vectors"], rows, axis=0, out=room("x", (count, WINDOW, WIDTH), kind), mode="clip")
    x += w["places"]
    u = room("u", x.shape, kind)
    np.matmul(_flat(x), asks, out=_flat(u))
    a = np.matmul(u[:, skip:], x.transpose(0, 2, 1), out=room("a", (count, WINDOW - skip, WINDOW), kind))
    np.clip(a, -LARGEST, LARGEST, out=a)
    np.exp(a, out=a)
    a *= _BEFORE[skip:]
    total = room("total", (count, WINDOW - skip, 1), kind)
    np.matmul(_flat(a), np.ones((WINDOW, 1), kind), out=_flat(total))
    seen = np.matmul(a, x, out=room("seen", (count, WINDOW - skip, WIDTH), kind))
    seen /= total
    h = room("h", seen.shape, kind)
    np.matmul(_flat(seen), gives, out=_flat(h))
    h += x[:, skip:]
    return h, x, u, a, total, seen


def _parted_logits(w: dict[str, np.ndarray], states: np.ndarray, room: Room) -> tuple[np.ndarray, np.ndarray]:
    """Logits as two parts to be added, one of each state and class and one of each class.

    Where no sum of the two can leave its bounds, the bias stays apart, and its exponentials
    are factors of whole columns.
    """
    found = np.matmul(states, w["out"], out=room("logits", (len(states), CLASSES), states.dtype))
    bias = w["bias"]
    if found.max(initial=0) + bias.max() < LARGEST and found.min(initial=0) + bias.min() > -LARGEST:
        return found, bias
    found += bias
    return np.clip(found, -LARGEST, LARGEST, out=found), np.zeros_like(bias)


def _cells(group: np.ndarray) -> np.ndarray:
    """Place of one class after each of a list of states among all logits."""
    return np.arange(0, len(group) * CLASSES, CLASSES) + group


def _class_logs(w: dict[str, np.ndarray], states: np.ndarray) -> np.ndarray:
    """Class log probabilities after each of a list of states."""
    logits = sum(_parted_logits(w, states, Room()))
    return logits - np.log(np.exp(logits).sum(1))[:, None]


def _chosen_logs(w: dict[str, np.ndarray], states: np.ndarray, group: np.ndarray, room: Room) -> np.ndarray:
    """Log probability of one class after each of a list of states."""
    logits, bias = _parted_logits(w, states, room)
    chosen = logits.ravel()[_cells(group)] + bias[group]
    np.exp(logits, out=logits)
    return chosen - np.log(logits @ np.exp(bias))


def slopes(weights: np.ndarray, rows: np.ndarray, group: np.ndarray, real: np.ndarray, room: Room | None = None) -> np.ndarray:
    """Gradient of the mean negative log probability of the classes at the real places.

    A logit beyond ``LARGEST`` has the slope of one within. The result is an array of the room.
    """
    room, kind = room or Room(), weights.dtype
    w, slope = parts(weights), room("slope", weights.shape, kind)
    g = parts(slope)
    h, x, u, a, total, seen = _attended(w, rows, room)
    asks, gives = _merged(w)
    # the slope of the logits is d, its rows times pace and its columns times factor
    d, bias = _parted_logits(w, _flat(h), room)
    np.exp(d, out=d)
    factor, chosen = np.exp(bias), group.ravel()
    whole = d @ factor
    counts = (real.ravel() / max(real.sum(), 1)).astype(kind)
    pace = counts / whole
    d.ravel()[_cells(chosen)] -= whole / factor[chosen]
    h *= pace.reshape(total.shape)
    g["out"][:] = (d.T @ _flat(h)).T
    g["out"] *= factor
    np.multiply(pace @ d, factor, out=g["bias"])
    dx = room("dx", x.shape, kind)
    np.matmul(d, factor[:, None] * w["out"].T, out=_flat(dx))
    dx *= pace.reshape(total.shape)
    given = _flat(seen).T @ _flat(dx)
    np.matmul(given, w["mix"].T, out=g["value"])
    np.matmul(w["value"].T, given, out=g["mix"])
    dseen = room("dseen", x.shape, kind)
    np.matmul(_flat(dx), gives.T, out=_flat(dseen))
    dseen /= total
    # the slope of the logits of attention is da less a times mean in each row
    da = np.matmul(dseen, x.transpose(0, 2, 1), out=room("da", a.shape, kind))
    da *= a
    mean = np.einsum("nij,nij->ni", dseen, seen)[..., None]
    du = np.matmul(da, x, out=room("du", x.shape, kind))
    seen *= mean * total
    du -= seen
    more = room("more", x.shape, kind)
    dseen -= np.multiply(u, mean, out=more)
    dx += np.matmul(a.transpose(0, 2, 1), dseen, out=more)
    dx += np.matmul(da.transpose(0, 2, 1), u, out=more)
    np.matmul(_flat(du), asks.T, out=_flat(more))
    dx += more
    asked = _flat(x).T @ _flat(du) * kind.type(WIDTH**-0.5)
    np.matmul(asked, w["key"], out=g["ask"])
    np.matmul(asked.T, w["ask"], out=g["key"])
    g["places"][:] = dx.sum(0)
    g["vectors"][:] = 0
    # two weights side by side are added up as one complex number
    pair = np.dtype(f"c{2 * kind.itemsize}")
    cells = np.take(_PAIRS, rows, axis=0, out=room("cells", (*rows.shape, WIDTH // 2), _PAIRS.dtype), mode="clip")
    np.add.at(g["vectors"].reshape(-1).view(pair), cells.ravel(), dx.reshape(-1).view(pair))
    return slope


class Adam:
    """Steps down a slope, each weight at a pace of its own.

    The sums of slopes and of squares are kept without the factors 0.1 and 0.01 of their
    averages, which go into the numbers of each step.
    """

    def __init__(self, size: int, kind: np.dtype):
        self._first, self._second = (np.zeros(size, kind) for _ in range(2))
        self._step = 0

    def move(self, point: np.ndarray, slope: np.ndarray) -> None:
        """Move the point; the slope is used up."""
        first, second = self._first, self._second
        self._step += 1
        first *= 0.9
        first += slope
        slope *= slope
        second *= 0.99
        second += slope
        scale = 0.1 / math.sqrt(1 - 0.99**self._step)
        move = np.sqrt(second, out=slope)
        move += 1e-8 / scale
        np.divide(first, move, out=move)
        move *= RATE * 0.1 / (1 - 0.9**self._step) / scale
        point -= move


def windows(borders: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first place, and first place scored of the windows over documents of subwords.

    The places scored by the windows of a document part it without overlap.
    """
    size = np.diff(borders)
    made = 1 + np.maximum(-(-(size - WINDOW) // stride), 0)
    of = np.repeat(np.arange(len(size)), made)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(made) - made, made)
    start = borders[of] + nth * stride
    return of, start, np.where(nth == 0, 0, WINDOW - stride)


def slice_subwords(words: Words, subwords: Subwords, frequent: FrequentWords, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the distinct words of a slice, where each begins and how many it has; ``at`` is its place among the frequent words, or -1."""
    known, new = at >= 0, np.flatnonzero(at < 0)
    begin, size = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    low = frequent.edges[at[known]]
    size[known] = frequent.edges[at[known] + 1] - low
    ids, edges = subwords.of(words.some(new))
    begin[new], size[new] = edges[:-1], np.diff(edges)
    begin[known] = len(ids) + np.cumsum(size[known]) - size[known]
    return np.concatenate([ids, frequent.ids[stretches(low, size[known])]]), begin, size


def subword_rows(words: Words, ids: np.ndarray, begin: np.ndarray, size: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents of a slice, each with its end id, and the borders of the documents."""
    each = size[words.number]
    running = ids[stretches(begin[words.number], each)]
    ends = np.concatenate([[0], np.cumsum(each)])[words.borders[1:]]
    borders = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
    return np.insert(running, ends, end), borders


def _input_rows(ids: np.ndarray, borders: np.ndarray, lex: Lexicon, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Input row of what precedes each subword, and its class; a text begins after an end id.

    Both are given as a window from each place on. Windows may read on behind the end of
    their document, as no place sees what follows it.
    """
    rows, group = np.zeros((2, len(ids) + WINDOW), np.int64)
    rows[1 : len(ids) + 1] = lex.row[ids]
    rows[borders[:-1]] = lex.row[end]
    group[: len(ids)] = lex.group[ids]
    return sliding_window_view(rows, WINDOW), sliding_window_view(group, WINDOW)


def packed_ids(ids: np.ndarray, borders: np.ndarray, end: int) -> pa.Array:
    """The subword ids of each document as bytes, as few for each as the end id takes."""
    kind = _id_kind(end)
    data = pa.py_buffer(ids.astype(kind).tobytes())
    edges = pa.py_buffer((borders * kind.itemsize).astype(np.int64).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(borders) - 1, [None, edges, data]).cast(pa.binary())


def id_slices(batch: pa.RecordBatch, end: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, subword ids, borders) of slices of a batch of packed documents, cut as their texts are."""
    kind = _id_kind(end)
    data, edges = codes.text_bytes(batch.column("subwords"))
    for first, stop in codes.slices(np.concatenate([[0], np.cumsum(batch.column("n_bytes").to_numpy())])):
        ids = np.frombuffer(data[edges[first] : edges[stop]].tobytes(), kind).astype(np.int64)
        yield first, stop, ids, (edges[first : stop + 1] - edges[first]) // kind.itemsize


def _id_kind(end: int) -> np.dtype:
    return np.dtype(np.uint16 if end < 1 << 16 else np.uint32)


def learn(texts: DataFrame, path: str, lex: Lexicon, weights: np.ndarray) -> np.ndarray:
    """Weights after one round: every task learns from the subwords of the given texts, the average counts."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((lex, weights))
    end = subword_count(path)

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, point = shared.value[0], shared.value[1].copy()
        adam, room, total = Adam(len(point), point.dtype), Room(), 0
        for batch in batches:
            for _, _, ids, borders in id_slices(batch, end):
                rows, group = _input_rows(ids, borders, lex, end)
                of, start, _ = windows(borders, WINDOW)
                order = np.argsort(codes.mixed(np.arange(len(of), dtype=np.uint64)), kind="stable")
                for low in range(0, len(of), BATCH):
                    some = order[low : low + BATCH]
                    real = np.arange(WINDOW) < (borders[of[some] + 1] - start[some])[:, None]
                    adam.move(point, slopes(point, rows[start[some]], group[start[some]], real, room))
                    total += int(real.sum())
        if total:
            blocks = range(0, _SIZE, WEIGHT_BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([low // WEIGHT_BLOCK for low in blocks], pa.int32()),
                    pa.array([point[low : low + WEIGHT_BLOCK].tobytes() for low in blocks], pa.binary()),
                    pa.array([total] * len(blocks), pa.int64()),
                ],
                ["block", "weights", "subwords"],
            )

    def averaged(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mass = 0.0, 0
        for batch in batches:
            for data, count in zip(batch.column("weights").to_pylist(), batch.column("subwords").to_pylist(), strict=True):
                total = total + np.frombuffer(data, np.float32).astype(np.float64) * count
                mass += count
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([(total / mass).astype(np.float32).tobytes()], pa.binary()), pa.array([mass], pa.int64())],
            ["block", "weights", "subwords"],
        )

    schema = "block int, weights binary, subwords long"
    after = weights.copy()
    rows = texts.select("n_bytes", "subwords").mapInArrow(learned, schema).groupBy("block").applyInArrow(averaged, schema)
    for row in rows.toLocalIterator():
        low = row["block"] * WEIGHT_BLOCK
        after[low : low + WEIGHT_BLOCK] = np.frombuffer(row["weights"], np.float32)
    return after


def log_probabilities(ids: np.ndarray, borders: np.ndarray, lex: Lexicon, weights: np.ndarray, end: int) -> np.ndarray:
    """Natural log probability of each document of subword ids."""
    w, room = parts(weights), Room()
    rows, group = _input_rows(ids, borders, lex, end)
    of, start, skipped = windows(borders)
    total = codes.segment_sums(lex.share[ids], borders)
    for skip in (0, WINDOW - STRIDE):
        alike = np.flatnonzero(skipped == skip)
        for low in range(0, len(alike), SCORE_BATCH):
            some = alike[low : low + SCORE_BATCH]
            states = _flat(_attended(w, rows[start[some]], room, skip)[0])
            coming = group[start[some]][:, skip:]
            real = np.arange(skip, WINDOW) < (borders[of[some] + 1] - start[some])[:, None]
            logs = _chosen_logs(w, states, coming.ravel(), room).reshape(coming.shape)
            total += np.bincount(of[some], (logs * real).sum(1, dtype=np.float64), minlength=len(total))
    return total


def frequent_words(words: DataFrame, most: int) -> DataFrame:
    """The rows of the most frequent words, ``most`` at the most.

    Words are taken by bins of their count, from the highest as long as all of a bin fit, so
    that no task sorts or gathers the words.
    """
    words = words.withColumn("bin", F.floor(F.log2("count") * 8))
    left, lowest = most, None
    for row in sorted(words.groupBy("bin").agg(F.count("*").alias("words")).collect(), reverse=True):
        left -= row["words"]
        if left < 0:
            break
        lowest = row["bin"]
    kept = F.lit(False) if lowest is None else F.col("bin") >= lowest
    return words.where(kept).drop("bin")


@dataclass
class FrequentWords:
    """A table of bounded size of words by ascending hash, with their counts and subword ids."""

    hashes: np.ndarray
    count: np.ndarray
    ids: np.ndarray
    edges: np.ndarray

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in the table, -1 where it is not there."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


def with_subwords(words: DataFrame, path: str) -> FrequentWords:
    """The table of some words, whose subwords the tasks find; the end mark has none."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords = Subwords(path)
        for batch in batches:
            texts = [word.encode() for word in batch.column("word").to_pylist()]
            real = [word for word in texts if word != END_WORD.encode()]
            ids, edges = subwords.of(real)
            size = np.zeros(len(texts), np.int64)
            size[[word != END_WORD.encode() for word in texts]] = np.diff(edges)
            packed = packed_ids(ids, np.concatenate([[0], np.cumsum(size)]), subwords.end)
            yield pa.RecordBatch.from_arrays([batch.column("hash"), batch.column("count"), packed], ["hash", "count", "subwords"])

    top = words.select("hash", "word", "count").mapInArrow(found, "hash long, count long, subwords binary").toArrow()
    kind = _id_kind(subword_count(path))
    hashes = top["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    data, edges = codes.text_bytes(top["subwords"].take(pa.array(order)))
    return FrequentWords(hashes[order], top["count"].to_numpy()[order], np.frombuffer(data.tobytes(), kind), edges // kind.itemsize)


@dataclass
class Counts:
    """Words and subwords of the training texts."""

    path: str
    lexicon: Lexicon
    words: DataFrame  # hash, count
    tokens: int
    distinct: int
    frequent: FrequentWords


@dataclass
class Model:
    counts: Counts
    weights: np.ndarray


def count(texts: DataFrame, path: str) -> Counts:
    """Count all words and subwords of the column text."""
    words = stored(count_words(texts), "words")
    size = words.agg(F.sum("count").alias("tokens"), F.count("*").alias("distinct")).first()
    lex = lexicon(count_subwords(words, path))
    frequent = with_subwords(frequent_words(words, FREQUENT), path)
    return Counts(path, lex, words.select("hash", "count"), size["tokens"] or 0, size["distinct"], frequent)


def teach(read: DataFrame, counts: Counts, share: int = TRAIN_SHARE, rounds: int = ROUNDS) -> Model:
    """Learn the attention weights from training texts that were read with these counts."""
    weights = first_weights(counts.lexicon.prior)
    if not counts.distinct:
        weights[:] = 0
    for number in range(rounds):
        part = read.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == number % share)
        weights = learn(part, counts.path, counts.lexicon, weights)
    return Model(counts, weights)


def train(texts: DataFrame, path: str, share: int = TRAIN_SHARE, rounds: int = ROUNDS) -> Model:
    """Count all words and subwords of doc_id and text, and learn the attention weights."""
    counts = count(texts, path)
    return teach(of_documents(read_words(texts, counts)), counts, share, rounds)


def _base(count: np.ndarray, tokens: int, distinct: int) -> np.ndarray:
    return np.log10((count + SMOOTHING) / (tokens + SMOOTHING * (distinct + 1)))


def read_words(documents: DataFrame, counts: Counts) -> DataFrame:
    """A stored row of every document, with its subwords and what its frequent words give, and rows of its other words.

    Texts are parted into words and subwords once for learning and scoring. The rows of a
    document have the same number ``row``; those of other words have a hash.
    """
    shared = documents.sparkSession.sparkContext.broadcast((counts.frequent, counts.path, counts.tokens, counts.distinct))
    kind = documents.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", kind), T.StructField("row", T.LongType())]
    fields += [T.StructField(x, T.LongType()) for x in ("n_tokens", "n_known")]
    fields += [T.StructField("base_score", T.DoubleType()), T.StructField("n_bytes", T.LongType()), T.StructField("subwords", T.BinaryType())]
    fields += [T.StructField("hash", T.LongType()), T.StructField("times", T.LongType())]
    schema = T.StructType(fields)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, path, tokens, distinct = shared.value
        subwords = Subwords(path)
        end = np.array([end_hash()], np.int64).view(np.uint64)
        for batch in batches:
            for first, stop, data, edges in codes.text_slices(batch):
                rows = stop - first
                words = slice_words(data, edges)
                hashes = np.concatenate([words.hashes, end])
                at = frequent.places(hashes)
                seen = np.zeros(len(hashes), np.int64)
                seen[at >= 0] = frequent.count[at[at >= 0]]
                own_ids = slice_subwords(words, subwords, frequent, at[:-1])
                value = np.where(seen > 0, _base(seen, tokens, distinct), 0)
                number, document = words.number, np.repeat(np.arange(rows), np.diff(words.borders))
                base = np.bincount(document, value[number], minlength=rows) + value[-1]
                sure = np.bincount(document, seen[number] > 0, minlength=rows).astype(np.int64) + (seen[-1] > 0)
                names = schema.names
                own = batch.column("row").slice(first, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, rows),
                        own,
                        pa.array(np.diff(words.borders) + 1),
                        pa.array(sure),
                        pa.array(base),
                        pa.array(np.diff(edges)),
                        packed_ids(*subword_rows(words, *own_ids, subwords.end), subwords.end),
                        pa.nulls(rows, pa.int64()),
                        pa.nulls(rows, pa.int64()),
                    ],
                    names,
                )
                # the other words, once per document, are looked up by a join
                other = np.flatnonzero(seen[number] == 0)
                pair, times = np.unique(document[other] * np.int64(len(hashes)) + number[other], return_counts=True)
                if not seen[-1]:
                    pair = np.concatenate([pair, np.arange(rows) * np.int64(len(hashes)) + len(hashes) - 1])
                    times = np.concatenate([times, np.ones(rows, np.int64)])
                of = pa.array(pair // len(hashes))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(len(pair), batch.column("doc_id").type),
                        own.take(of),
                        *[pa.nulls(len(pair), pa.int64())] * 2,
                        pa.nulls(len(pair), pa.float64()),
                        pa.nulls(len(pair), pa.int64()),
                        pa.nulls(len(pair), pa.binary()),
                        pa.array(hashes[pair % len(hashes)].view(np.int64)),
                        pa.array(times),
                    ],
                    names,
                )

    rows = documents.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return stored(rows.mapInArrow(found, schema), "subwords")


def of_documents(read: DataFrame) -> DataFrame:
    return read.where("hash is null").drop("hash", "times")


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row of ``documents``."""
    return score_read(read_words(documents, model.counts), model)


def score_read(read: DataFrame, model: Model) -> DataFrame:
    """The scores of documents that were read with the counts of the model."""
    counts = model.counts
    shared = read.sparkSession.sparkContext.broadcast((counts.lexicon, model.weights))
    end = subword_count(counts.path)
    documents = of_documents(read)
    schema = T.StructType([*(x for x in documents.schema if x.name not in ("n_bytes", "subwords")), T.StructField("score", T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, weights = shared.value
        for batch in batches:
            for first, stop, ids, borders in id_slices(batch, end):
                log = log_probabilities(ids, borders, lex, weights, end) / np.log(10)
                own = batch.drop_columns(["n_bytes", "subwords"]).slice(first, stop - first)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(log)], schema.names)

    found = stored(documents.mapInArrow(scored, schema), "scores")
    looked_up = read.where("hash is not null").select("row", "hash", "times").join(counts.words, "hash", "left")
    count = F.coalesce("count", F.lit(0))
    scale = counts.tokens + SMOOTHING * (counts.distinct + 1)
    rest = looked_up.groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((count + SMOOTHING) / F.lit(scale))).alias("more_base"),
    )
    whole = found.join(rest, "row", "left")
    return whole.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
    )


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(remainder(column, 10) == 0, F.lit(False))


def corpus_scores(documents: DataFrame, path: str) -> DataFrame:
    """Scores of every document by a model of those not held out; a tenth of the ids is held out."""
    counts = count(documents.select("text").where(remainder("doc_id", 10) != 0), path)
    read = read_words(documents, counts)
    model = teach(of_documents(read).where(remainder("doc_id", 10) != 0), counts)
    return score_read(read, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
