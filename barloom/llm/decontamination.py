"""Benchmark decontamination: BM25 over test items, searched by block-max WAND.

Every document is cut into overlapping passages that cover it whole, and every passage is a
query against an inverted index. An item has an entry for its whole text and one for its
question, so that a question without its answer is found by itself; a question of fewer than
``SHINGLE`` words is common speech and has none. Texts of more than ``PIECE`` words have an
entry for each of their overlapping pieces too; as any ``PIECE`` words that follow each other
lie in one passage, items of any length are retrieved by their pieces. Scores are BM25 with the distinct words of the
passage, divided by the score an entry gives itself, so that 1 means all of the entry is there;
the score of an item is its best entry's. All items with an entry at or above ``THRESHOLD`` are
retrieved: a bound from the largest impact of each word rules out some passages in one pass,
block-max WAND searches the rest, many at once. A retrieved pair is verified on words: the
share of the item's five-word shingles, and those of its question and its answer, found
anywhere in the document; what has fewer than five words must be found in a passage retrieved
or its surroundings.

The index is built in shards of about ``SHARD_BYTES`` of item text, spread by hash, with
statistics over all items; each shard is one pass over the documents, so what is broadcast is
bounded however large the benchmark is.

Words are runs of letters and digits, A-Z lowered. Null or empty texts and items match
nothing. Of an item, the last sentence is the answer and what precedes it the question; an
item of one sentence is both. Repeated items are searched each for itself, repeated
documents give one row per document id and item; texts of any length are searched whole, an
empty table of documents or items gives no rows. Only doc_id, item_id and text are read;
``clean`` keeps all columns, and decides row by row, whatever the ids. The answer of an item is
told of, but not asked for: a question that is known is a leak by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import codes
from barloom.llm.work import stored

PASSAGE_WORDS = 128
STRIDE = 64
PIECE = PASSAGE_WORDS - STRIDE
THRESHOLD = 0.5
OVERLAP = 0.8
SHINGLE = 5
K1, B = 1.2, 0.75
BLOCK = 8
BATCH = 512
SHARD_BYTES = 8 << 20

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[48:58] = _WORD_BYTE[65:91] = _WORD_BYTE[97:123] = _WORD_BYTE[128:] = True
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def words_of(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word of a slice."""
    parted = np.where(_WORD_BYTE[data], codes.LOWER[data], np.uint8(32))
    return codes.word_hashes(parted, edges)


def text_words(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]))[0]


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer; an item of one sentence is both."""
    sentences = [x for x in _SENTENCE_END.split(text.strip()) if x]
    if len(sentences) < 2:
        return text, text
    return " ".join(sentences[:-1]), sentences[-1]


def shingle_set(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct shingles, ascending."""
    return codes.shingles(words, np.zeros(len(words), np.int64), 1, size)[0]


@dataclass(frozen=True)
class Part:
    """Distinct shingles of a text, of five words or of as many as it has."""

    size: int
    shingles: np.ndarray


def part(text: str) -> Part:
    words = text_words(text)
    size = min(SHINGLE, len(words))
    return Part(size, shingle_set(words, size) if size else np.zeros(0, np.uint64))


@dataclass(frozen=True)
class Item:
    item_id: object
    parts: tuple[Part, Part, Part]  # whole, question, answer


@dataclass(frozen=True)
class Index:
    """Postings by word (ascending hash) and entry, in blocks of BLOCK entries.

    ``owner`` is the item of each entry. Impacts are shares of an entry's own score. Line i of
    a word's blocks says that the postings ``start[i]`` to ``start[i + 1]`` lie in block
    ``block[i]`` and none is over ``top[i]``.
    """

    items: list[Item]
    owner: np.ndarray
    words: np.ndarray
    largest: np.ndarray  # of each word
    first: np.ndarray  # lines of each word's blocks
    block: np.ndarray
    top: np.ndarray
    start: np.ndarray
    entry: np.ndarray
    impact: np.ndarray


def entries(whole: np.ndarray, question: np.ndarray) -> list[np.ndarray]:
    """Word sequences of an item that are searched, each for itself."""
    found = [whole, question] if len(question) >= SHINGLE else [whole]
    for text in list(found):
        last = max(len(text) - PIECE, 0)
        found += [text[first : first + PIECE] for first in (*range(0, last, PIECE // 2), last)]
    return list({x.tobytes(): x for x in found}.values())


def build_index(rows: list[tuple[object, str]], count: int, average: float, frequency: dict[int, int]) -> Index:
    """Index of one shard; ``count``, ``average`` and ``frequency`` describe all items."""
    items, owner, word, entry, weight = [], [], [], [], []
    for item_id, text in sorted(rows, key=lambda row: (str(row[0]), row[1])):
        whole = text_words(text)
        if not len(whole):
            continue
        question, answer = question_and_answer(text)
        for own in entries(whole, text_words(question)):
            found, times = np.unique(own, return_counts=True)
            seen = np.array([frequency[x] for x in found.tolist()], np.float64)
            rarity = np.log1p((count - seen + 0.5) / (seen + 0.5))
            gain = rarity * times * (K1 + 1) / (times + K1 * (1 - B + B * len(own) / average))
            word.append(found)
            entry.append(np.full(len(found), len(owner)))
            weight.append(gain / gain.sum())
            owner.append(len(items))
        items.append(Item(item_id, tuple(part(x) for x in (text, question, answer))))
    if not items:
        empty, none = np.zeros(0), np.zeros(0, np.int64)
        return Index([], none, none.astype(np.uint64), empty, np.zeros(1, np.int64), none, empty, np.zeros(1, np.int64), none, empty)
    words, numbers, weights = (np.concatenate(x) for x in (word, entry, weight))
    order = np.lexsort((numbers, words))
    words, numbers, weights = words[order], numbers[order], weights[order]
    known, first = np.unique(words, return_index=True)
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[1:] != words[:-1]) | (numbers[1:] // BLOCK != numbers[:-1] // BLOCK)
    start = np.flatnonzero(fresh)
    return Index(
        items,
        np.array(owner),
        known,
        np.maximum.reduceat(weights, first),
        np.append(np.searchsorted(start, first), len(start)),
        numbers[start] // BLOCK,
        np.maximum.reduceat(weights, start),
        np.append(start, len(words)),
        numbers,
        weights,
    )


def _spread(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one after another, and the range of each."""
    size = end - first
    of = np.repeat(np.arange(len(size)), size)
    return first[of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size), of


def search(index: Index, passage: np.ndarray, word: np.ndarray, passages: int, threshold: float = THRESHOLD) -> tuple[np.ndarray, ...]:
    """(passage, entry, score) of all entries that reach the threshold, for a batch of passages.

    ``passage`` and ``word`` (number in the index) are distinct pairs. The two tests of
    block-max WAND run for the whole batch instead of cursor by cursor: a passage whose words'
    largest impacts cannot reach the threshold is left, then every block whose largest
    impacts cannot; the entries of the blocks that remain are scored in full.
    """
    least = threshold - 1e-9
    hopeful = np.bincount(passage, index.largest[word], minlength=passages) >= least
    passage, word = passage[hopeful[passage]], word[hopeful[passage]]
    size = len(index.owner)
    blocks = -(-size // BLOCK)
    entry, of = _spread(index.first[word], index.first[word + 1])
    cell = passage[of] * blocks + index.block[entry]
    bound = np.bincount(cell, index.top[entry], minlength=passages * blocks)
    kept = bound[cell] >= least
    entry, cell = entry[kept], cell[kept]
    posting, of = _spread(index.start[entry], index.start[entry + 1])
    pair, number = np.unique(cell[of] // blocks * size + index.entry[posting], return_inverse=True)
    score = np.bincount(number, index.impact[posting], minlength=len(pair))
    found = score >= least
    return pair[found] // size, pair[found] % size, score[found]


class Stretch:
    """Shingles of a stretch of words, made for each size when first asked for."""

    def __init__(self, words: np.ndarray):
        self._words = words
        self._sets: dict[int, np.ndarray] = {}

    def share(self, part: Part) -> float:
        if not len(part.shingles):
            return 0.0
        if part.size not in self._sets:
            self._sets[part.size] = shingle_set(self._words, part.size)
        held = self._sets[part.size]
        if not len(held):
            return 0.0
        at = np.minimum(np.searchsorted(held, part.shingles), len(held) - 1)
        return float((held[at] == part.shingles).mean())


def match_slice(data: np.ndarray, edges: np.ndarray, index: Index) -> Iterator[tuple[int, int, int, float, float, float, float]]:
    """(document, item, passages, best score, whole, question, answer overlap) of retrieved pairs."""
    words, document = words_of(data, edges)
    if not len(words) or not len(index.words):
        return
    number = np.minimum(np.searchsorted(index.words, words), len(index.words) - 1)
    known = index.words[number] == words
    gain = np.concatenate([[0], np.cumsum(np.where(known, index.largest[number], 0))])
    rows = len(edges) - 1
    border = np.concatenate([[0], np.cumsum(np.bincount(document, minlength=rows))])
    size = np.diff(border)
    made = np.where(size > 0, np.maximum(-(-(size - PASSAGE_WORDS) // STRIDE), 0) + 1, 0)
    of = np.repeat(np.arange(rows), made)
    start = border[of] + (np.arange(len(of)) - np.repeat(np.cumsum(made) - made, made)) * STRIDE
    stop = np.minimum(start + PASSAGE_WORDS, border[of + 1])
    hopeful = np.flatnonzero(gain[stop] - gain[start] + 1e-9 >= THRESHOLD)
    pairs: dict[tuple[int, int], list[float]] = {}
    for low in range(0, len(hopeful), BATCH):
        some = hopeful[low : low + BATCH]
        place, passage = _spread(start[some], stop[some])
        passage, place = passage[known[place]], place[known[place]]
        distinct = np.unique(passage * len(index.words) + number[place])
        found = search(index, distinct // len(index.words), distinct % len(index.words), len(some))
        around: dict[int, Stretch] = {}
        last_of: dict[int, int] = {}
        for nth, which, score in zip(found[0].tolist(), index.owner[found[1]].tolist(), found[2].tolist(), strict=True):
            first, last, row = int(start[some[nth]]), int(stop[some[nth]]), int(of[some[nth]])
            if nth not in around:
                around[nth] = Stretch(words[max(first - STRIDE, border[row]) : min(last + STRIDE, border[row + 1])])
            best = pairs.setdefault((row, which), [0, 0.0, 0.0, 0.0, 0.0])
            best[0] += last_of.get(which) != nth
            last_of[which] = nth
            best[1] = max(best[1], score)
            for slot, part in enumerate(index.items[which].parts, 2):
                if part.size < SHINGLE:
                    best[slot] = max(best[slot], around[nth].share(part))
    whole: tuple[int, Stretch] | None = None
    for (row, place), best in sorted(pairs.items()):
        if whole is None or whole[0] != row:
            whole = row, Stretch(words[border[row] : border[row + 1]])
        for slot, part in enumerate(index.items[place].parts, 2):
            if part.size == SHINGLE:
                best[slot] = whole[1].share(part)
        yield row, place, *best


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each item, and the word count of each as word 0."""
    for batch in batches:
        for _, _, data, edges in codes.text_slices(batch):
            words, document = words_of(data, edges)
            order = np.lexsort((words, document))
            words, document = words[order], document[order]
            fresh = np.ones(len(words), bool)
            fresh[1:] = (words[1:] != words[:-1]) | (document[1:] != document[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(words[fresh].view(np.int64))], ["word"])


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, edges in codes.text_slices(batch):
            _, document = words_of(data, edges)
            own = np.bincount(document, minlength=len(edges) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64))], ["words"])


def indexes(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> Iterator[Index]:
    """Bounded indexes that together hold all items."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    lengths = items.select("text").mapInArrow(_lengths, "words long").where("words > 0")
    size = lengths.agg(F.count("*").alias("count"), F.avg("words").alias("average")).first()
    if not size["count"]:
        return
    total = items.agg(F.sum(F.octet_length("text"))).first()[0]
    shards = -(-total // shard_bytes)
    found = items.select("text").mapInArrow(_item_words, "word long").groupBy("word").agg(F.count("*").alias("seen"))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))
    for number in range(shards):
        held = items.where(shard == number)
        own = held.select("text").mapInArrow(_item_words, "word long").distinct().join(found, "word")
        frequency = {row["word"] % (1 << 64): row["seen"] for row in own.toLocalIterator()}
        rows = [(row["item_id"], row["text"]) for row in held.toLocalIterator()]
        yield build_index(rows, size["count"], size["average"], frequency)


def retrieve(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, passages, score and overlaps of all retrieved pairs."""
    kept = documents.select("doc_id", "text")
    item_type = benchmark.schema["item_id"]
    numbers = [T.StructField(x, T.DoubleType()) for x in ("score", "item_overlap", "question_overlap", "answer_overlap")]
    schema = T.StructType([kept.schema["doc_id"], item_type, T.StructField("passages", T.LongType()), *numbers])
    spark = documents.sparkSession
    parts = []
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def matched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, _, data, edges in codes.text_slices(batch):
                    rows = list(match_slice(data, edges, shared.value))
                    ids = batch.column("doc_id").take(pa.array([first + row[0] for row in rows], pa.int64()))
                    items = pa.array([shared.value.items[row[1]].item_id for row in rows])
                    if not rows:
                        continue
                    rest = [pa.array([row[slot] for row in rows], kind) for slot, kind in zip(range(2, 7), [pa.int64()] + [pa.float64()] * 4, strict=True)]
                    yield pa.RecordBatch.from_arrays([ids, items, *rest], schema.names)

        parts.append(kept.mapInArrow(matched, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    best = [F.max(x).alias(x) for x in ("passages", "score", "item_overlap", "question_overlap", "answer_overlap")]
    return whole.groupBy("doc_id", "item_id").agg(*best)


def contaminated(pairs: DataFrame) -> DataFrame:
    """The verified pairs: the whole item or its question is in the document."""
    verified = (F.col("item_overlap") >= OVERLAP) | (F.col("question_overlap") >= OVERLAP)
    return pairs.where(verified).withColumn("answer_found", F.col("answer_overlap") >= OVERLAP)


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without the rows that hold an item, whatever their ids; rows are numbered once in a stored table."""
    rows = stored(documents.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("record")), "documents")
    texts = rows.select(F.col("row").alias("doc_id"), F.col("record.text").alias("text"))
    bad = contaminated(retrieve(texts, benchmark)).select(F.col("doc_id").alias("row")).distinct()
    return rows.join(bad, "row", "left_anti").select("record.*")
