"""Words of Han text: a dictionary learned from the texts, and the best way to cut a run of signs into its words.

A string of signs is a word if it is frequent, if its signs stand together more often than
chance puts them there (cohesion: the least pointwise mutual information over its cuts, in
nats), and if many different signs stand before and behind it (the smaller of the two
entropies of its neighbours). All of this follows from one count of the strings of up to
``MOST_SIGNS`` + 1 signs, added up in each task before its shuffle.

A word costs 16 times the binary logarithm of how rarely it occurs, rounded to a whole number; a
run is cut so that the costs of its words add up to the least, and among equal ways the first word
that differs is the longer one. Whole costs make ties exact.

The dictionary is sent to the tasks as a trie (:class:`Trie`) if it has ``TRIE_WORDS`` words at
most; a larger one is joined with the strings of the texts by shuffle. Both give the same words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from barloom.session import work_folder

MOST_SIGNS = 4
MIN_COUNT = 5
MIN_COHESION = 1.5
MIN_ENTROPY = 1.0
#: of at most MOST_SIGNS signs each: less than 100 MB as a trie
TRIE_WORDS = 1_000_000
COST_STEPS = 16
_BORDER = "^"  # beside the first and the last sign of a run; no sign
_NEVER = np.int64(1) << 40
_SIGN_BITS = 21
_STRINGS = 1 << 20  # strings that a task counts at once
_SIGNS = 1 << 21  # signs that a task cuts at once
_PIECES = r"\p{IsHan}+|[\p{L}&&[^\p{IsHan}]]+"


def _strings(signs: Column, most: int, size: Column) -> Column:
    """All strings of 1 to ``most`` signs of an array of ``size`` signs, as (start from 1, text)."""

    def at(i: Column) -> Column:
        lengths = F.sequence(F.lit(1), F.least(F.lit(most), size - i + 1))
        return F.transform(lengths, lambda n: F.struct(i.alias("start"), F.array_join(F.slice(signs, i, n), "").alias("word")))

    return F.flatten(F.transform(F.sequence(F.lit(1), size), at))


def _distinct(strings: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of signs, ``_STRINGS`` * 2 at most, and the times of each added up."""
    key = np.zeros(len(strings), np.int64)
    for place in range(strings.shape[1]):
        if place > 2 and place % 2:  # a number of a row so far takes no more room than a sign
            key = pd.factorize(key)[0]
        key = key << _SIGN_BITS | strings[:, place]
    number = pd.factorize(key)[0]
    first = np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1))
    return strings[first], np.bincount(number, times, len(first)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The strings of ``most`` signs, shorter at the end of a run, with counts that a task has added up as far as it can hold them."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        return _distinct(*(np.concatenate(x) for x in zip(*held, strict=True)))

    def written() -> pa.RecordBatch:
        strings, count = merged()
        held.clear()
        words = np.ascontiguousarray(strings).view(f"<U{most}").ravel()  # without the zeros behind
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(count)], ["word", "count"])

    for batch in batches:
        for low in range(0, len(batch), 256):
            signs = np.frombuffer("".join(batch.column(0).slice(low, 256).to_pylist()).encode("utf-32-le"), np.uint32)
            every = np.lib.stride_tricks.sliding_window_view(signs, most)
            for at in range(0, len(every), _STRINGS):
                some = every[at : at + _STRINGS]
                some = some[some[:, 0] > 0]
                held.append(_distinct(some, np.ones(len(some))))
                if sum(len(s) for s, _ in held) > _STRINGS:
                    held[:] = [merged()]
                    if len(held[0][0]) > _STRINGS // 2:
                        yield written()
    if held:
        yield written()


def string_counts(docs: DataFrame, most: int, text: str = "text") -> DataFrame:
    """word, n (its signs) and count of all strings of up to ``most`` signs, also with the border sign at the ends of runs.

    Only the longest string from each place is counted in the texts; the shorter ones begin them.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(r"\p{IsHan}+"), F.lit(0))
    behind = _BORDER + "\0" * (most - 1)
    framed = docs.select(runs.alias("runs")).where(F.size("runs") > 0)
    framed = framed.select(F.concat(F.lit(_BORDER), F.array_join("runs", behind + _BORDER), F.lit(behind)).alias("framed"))
    found = framed.mapInArrow(lambda batches: _counted(batches, most), "word string, count long")
    longest = found.groupBy("word").agg(F.sum("count").alias("count"))
    begun = longest.select("word", "count", F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("n"))
    begun = begun.select(F.expr("left(word, n)").alias("word"), "n", "count")
    return begun.groupBy("word", "n").agg(F.sum("count").alias("count"))


def _entropy(counts: DataFrame, word: Column, words: DataFrame, name: str) -> DataFrame:
    """Entropy of the neighbours of some words, from the counts of the strings that have one sign more."""
    own = counts.select(word.alias("word"), "count").join(words.select("word"), "word", "left_semi")
    total = F.sum("count")
    spread = F.sum(F.col("count") * F.log("count"))
    return own.groupBy("word").agg((F.log(total) - spread / total).alias(name))


def learn_words(
    docs: DataFrame,
    text: str = "text",
    most_signs: int = MOST_SIGNS,
    min_count: int = MIN_COUNT,
    min_cohesion: float = MIN_COHESION,
    min_entropy: float = MIN_ENTROPY,
) -> DataFrame:
    """The dictionary: word, count, cohesion, entropy and cost. Every sign that occurs is a word too, without cohesion and entropy.

    The counts of strings are written aside once, as every measure reads them, and so are the cohesive strings.
    """
    path = work_folder(docs.sparkSession, "strings")
    string_counts(docs, most_signs + 1, text).write.parquet(path)
    every = docs.sparkSession.read.parquet(path)
    inner = every.where(~F.contains("word", F.lit(_BORDER)) & (F.col("n") <= most_signs))
    total = inner.where("n = 1").agg(F.sum("count").alias("total"))
    frequent = inner.where((F.col("n") > 1) & (F.col("count") >= min_count))

    cut = F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("cut")
    parts = frequent.select("word", "n", "count", cut).select(
        "word", "count", F.expr("left(word, cut)").alias("first"), F.expr("right(word, n - cut)").alias("rest")
    )
    known = inner.where(F.col("n") < most_signs)
    firsts = known.select(F.col("word").alias("first"), F.col("count").alias("first_count"))
    rests = known.select(F.col("word").alias("rest"), F.col("count").alias("rest_count"))
    joined = parts.join(firsts, "first").join(rests, "rest").withColumn("total", total.scalar())
    together = F.log(F.col("count") * F.col("total").cast("double") / (F.col("first_count").cast("double") * F.col("rest_count")))
    cohesive = joined.groupBy("word").agg(F.first("count").alias("count"), F.min(together).alias("cohesion")).where(F.col("cohesion") >= min_cohesion)

    path = work_folder(docs.sparkSession, "cohesive")
    cohesive.write.parquet(path)
    cohesive = docs.sparkSession.read.parquet(path)
    longer = every.where("n > 1")
    after = _entropy(longer, F.expr("left(word, n - 1)"), cohesive, "after")
    before = _entropy(longer, F.expr("right(word, n - 1)"), cohesive, "before")
    free = cohesive.join(after, "word").join(before, "word").withColumn("entropy", F.least("before", "after"))
    words = free.where(F.col("entropy") >= min_entropy).select("word", "count", "cohesion", "entropy")
    empty = F.lit(None).cast("double")
    signs = inner.where("n = 1").select("word", "count", empty.alias("cohesion"), empty.alias("entropy"))
    return with_costs(words.unionByName(signs))


def with_costs(words: DataFrame) -> DataFrame:
    """A dictionary (word, count, …) with the cost of each word."""
    everything = words.agg(F.sum("count").alias("total")).scalar()
    rare = F.log2(everything.cast("double") / F.col("count"))
    return words.withColumn("cost", F.round(rare * COST_STEPS).cast("bigint"))


@dataclass(frozen=True)
class Trie:
    """Words as one sorted array of edges per depth: an edge is its parent's number there and a sign.

    ``costs`` has the cost of the word that ends at an edge, or one that no way can have.
    """

    edges: list[np.ndarray]
    costs: list[np.ndarray]
    unknown: int

    def word_costs(self, signs: np.ndarray, room: np.ndarray) -> list[np.ndarray]:
        """For each number of signs the cost of the word of that length that starts at each place.

        ``room`` is the number of signs to the end of the run. A sign that is no word has the cost of an unknown one.
        """
        found = []
        node = np.zeros(len(signs), np.int64)
        alive = room > 0
        for depth, (edges, costs) in enumerate(zip(self.edges, self.costs, strict=True)):
            ahead = np.minimum(np.arange(len(signs)) + depth, max(len(signs) - 1, 0))
            key = node << 21 | signs[ahead]
            place = np.minimum(np.searchsorted(edges, key), max(len(edges) - 1, 0))
            alive = alive & (room > depth) & ((edges[place] == key) if len(edges) else False)
            found.append(np.where(alive, costs[place] if len(costs) else _NEVER, _NEVER))
            node = np.where(alive, place, 0)
        found[0] = np.where((room > 0) & (found[0] == _NEVER), self.unknown, found[0])
        return found


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def build_trie(words: dict[str, int], unknown: int) -> Trie:
    most = max(map(len, words), default=1)
    codes = {word: _codes(word).tolist() for word in words}
    edges, costs = [], []
    parents: dict[str, int] = {"": 0}
    for depth in range(1, most + 1):
        keys = {word[:depth]: parents[word[: depth - 1]] << 21 | codes[word][depth - 1] for word in words if len(word) >= depth}
        ordered = sorted(keys, key=keys.__getitem__)
        edges.append(np.array([keys[x] for x in ordered], np.int64))
        costs.append(np.array([words.get(x, _NEVER) for x in ordered], np.int64))
        parents = {x: i for i, x in enumerate(ordered)}
    return Trie(edges, costs, unknown)


def best_lengths(costs: list[np.ndarray], borders: np.ndarray) -> np.ndarray:
    """At every place the signs of the first word of the cheapest way to the end of its run.

    ``borders`` part the places into runs, each with a last place that is no sign. All runs
    are worked through side by side, from their ends.
    """
    best = np.zeros(borders[-1] if len(borders) else 0, np.int64)
    length = np.zeros(len(best), np.int64)
    last = borders[1:] - 1
    size = np.diff(borders) - 1
    order = np.argsort(-size, kind="stable")
    last, size = last[order], size[order]
    for back in range(1, int(size[0]) + 1 if len(size) else 0):
        here = last[: np.searchsorted(-size, -back, "right")] - back
        least = np.full(len(here), 2 * _NEVER)
        for n in range(1, len(costs) + 1):
            way = costs[n - 1][here] + best[np.minimum(here + n, len(best) - 1)]
            better = (way <= least) & (costs[n - 1][here] < _NEVER)
            least = np.where(better, way, least)
            length[here] = np.where(better, n, length[here])
        best[here] = least
    return length


def word_starts(lengths: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Places where a word begins, ascending; all runs are walked through side by side."""
    begins = np.zeros(len(lengths), bool)
    at, end = borders[:-1], borders[1:] - 1
    while len(at := at[(left := at < end)]):
        end = end[left]
        begins[at] = True
        at = at + lengths[at]
    return np.flatnonzero(begins)


def _laid_out(runs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signs of all runs, each with a last place of no sign, the borders, and the signs to the end from each place."""
    borders = np.concatenate([[0], np.cumsum([len(r) + 1 for r in runs], dtype=np.int64)])
    signs = _codes("\x00".join([*runs, ""]))
    return signs, borders, np.repeat(borders[1:] - 1, np.diff(borders)) - np.arange(len(signs))


def _cut(signs: np.ndarray, costs: list[np.ndarray], borders: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of all runs one after another, and how many each run has."""
    lengths = best_lengths(costs, borders)
    start = word_starts(lengths, borders)
    place = np.arange(len(costs))
    inside = place < lengths[start, None]
    strings = np.where(inside, signs[np.minimum(start[:, None] + place, max(len(signs) - 1, 0))], 0).astype(np.uint32)
    words = strings.view(f"<U{len(costs)}").ravel()  # without the zeros behind
    return pa.array(words, pa.string()), np.diff(np.searchsorted(start, borders))


def cut_runs(runs: list[str], trie: Trie) -> list[list[str]]:
    """The words of each run of signs."""
    signs, borders, room = _laid_out(runs)
    words, count = _cut(signs, trie.word_costs(signs, room), borders)
    every = iter(words.to_pylist())
    return [list(islice(every, n)) for n in count.tolist()]


def _pieces(text: Column) -> Column:
    """Runs of Han signs and words of other letters in order, in lower case."""
    pieces = F.regexp_extract_all(F.lower(text), F.lit(_PIECES), F.lit(0))
    return F.transform(pieces, lambda x: F.struct(x.alias("piece"), x.rlike(r"^\p{IsHan}").alias("han")))


def unknown_cost(dictionary: DataFrame) -> tuple[int, int]:
    """Number of words, and the cost of a sign that is none: one more than the dearest word."""
    row = dictionary.agg(F.count("*"), F.max("cost")).first()
    return row[0], (row[1] or 0) + 1


def segments(docs: DataFrame, dictionary: DataFrame, key: str = "doc_id", text: str = "text", most_words: int = TRIE_WORDS) -> DataFrame:
    """One row per word with its place in the text, from 0; words of other letters as they are, in lower case.

    ``dictionary``: word, cost, a stored table of distinct words. A null or empty text has no words.
    """
    count, unknown = unknown_cost(dictionary)
    if count > most_words:
        return _joined_segments(docs, dictionary, unknown, key, text)
    words = {row["word"]: row["cost"] for row in dictionary.select("word", "cost").toLocalIterator()}
    shared = docs.sparkSession.sparkContext.broadcast(build_trie(words, unknown))

    def costs_of(signs: np.ndarray, borders: np.ndarray, room: np.ndarray, batch: pa.RecordBatch) -> list[np.ndarray]:
        return shared.value.word_costs(signs, room)

    return _cut_pieces(docs.select(key, _pieces(F.col(text)).alias("pieces")), key, costs_of)


def _sizes(pieces: pa.ListArray) -> np.ndarray:
    return pieces.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, about ``_SIGNS`` signs or one row at a time."""
    pieces = batch.column("pieces")
    signs = pc.utf8_length(pieces.flatten().field("piece")).to_numpy(zero_copy_only=False)
    behind = np.concatenate([[0], np.cumsum(signs, dtype=np.int64)])[np.cumsum(_sizes(pieces))]
    cuts = [0, *(np.flatnonzero(np.diff(behind // _SIGNS)) + 1).tolist(), len(batch)]
    for low, high in pairwise(cuts):
        if low < high:
            yield batch.slice(low, high - low)


def _cut_pieces(
    pieces: DataFrame, key: str, costs_of: Callable[[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch], list[np.ndarray]]
) -> DataFrame:
    kind = dict(pieces.dtypes)[key]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (rows for batch in batches for rows in _slices(batch)):
            every = rows.column("pieces").flatten()
            piece, is_han = every.field("piece"), every.field("han")
            han = is_han.to_numpy(zero_copy_only=False).astype(bool)
            signs, borders, room = _laid_out(piece.filter(is_han).to_pylist())
            words, of_runs = _cut(signs, costs_of(signs, borders, room, rows), borders)
            count = np.ones(len(han), np.int64)
            count[han] = of_runs
            # the words of runs, and the other pieces, in the order of the texts
            of_run = np.repeat(han, count)
            place = np.where(of_run, np.cumsum(of_run) - 1, len(words) + np.cumsum(~of_run) - 1)
            found = pa.concat_arrays([words, piece.filter(pc.invert(is_han))]).take(pa.array(place))
            behind = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(_sizes(rows.column("pieces")))])]
            lists = pa.ListArray.from_arrays(pa.array(behind, pa.int32()), found)
            yield pa.RecordBatch.from_arrays([rows.column(key), lists], [key, "words"])

    return pieces.mapInArrow(cut, f"{key} {kind}, words array<string>").select(key, F.posexplode("words").alias("pos", "term"))


def _joined_segments(docs: DataFrame, dictionary: DataFrame, unknown: int, key: str, text: str) -> DataFrame:
    """:func:`segments` for a dictionary of any size: the strings of the texts are joined with it by shuffle."""
    spark = docs.sparkSession
    most = dictionary.agg(F.max(F.char_length("word"))).first()[0]
    path = work_folder(spark, "pieces")
    docs.select(key, F.monotonically_increasing_id().alias("row"), _pieces(F.col(text)).alias("pieces")).write.parquet(path)
    rows = spark.read.parquet(path)
    runs = rows.select("row", F.posexplode(F.filter("pieces", lambda x: x["han"])).alias("run", "p"))
    signs = runs.select("row", "run", F.split("p.piece", "").alias("signs"))
    strings = signs.select("row", "run", F.explode(_strings(F.col("signs"), most, F.size("signs"))).alias("s"))
    priced = strings.select("row", "run", "s.*").join(dictionary.select("word", "cost"), "word")
    ways = priced.groupBy("row").agg(F.collect_list(F.struct("run", "start", F.char_length("word").alias("n"), "cost")).alias("ways"))

    def costs_of(signs: np.ndarray, borders: np.ndarray, room: np.ndarray, batch: pa.RecordBatch) -> list[np.ndarray]:
        costs = [np.where((room > 0) & (n == 0), unknown, _NEVER) for n in range(most)]
        first = 0  # of the row's runs among all
        for pieces, own in zip(batch.column("pieces").to_pylist(), batch.column("ways").to_pylist(), strict=True):
            for x in own or ():
                costs[x["n"] - 1][borders[first + x["run"]] + x["start"] - 1] = x["cost"]
            first += sum(x["han"] for x in pieces or ())
        return costs

    return _cut_pieces(rows.join(ways, "row", "left").select(key, "pieces", "ways"), key, costs_of)
