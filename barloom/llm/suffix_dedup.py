"""Repeated 100-byte strings removed from a corpus, by prefix-free parsing.

Every text is parsed by a rolling hash of ``TRIGGER`` bytes: of the trigger places inside a
string of ``LENGTH`` bytes, the one with the least hash (the first of equals) is its trigger.
The strings that share a trigger place form a phrase: their starts are neighbours, and its
text is theirs together. Equal strings have equal triggers at equal offsets, so they can only
lie in phrases of one trigger, and the parse of a text is its list of phrases.

1. Triggers met at one place only cannot belong to a repeated string; they are dropped.
2. The other phrases give the parse (phrase, document, start) and the dictionary: every
   distinct phrase once, with its first place in corpus order, by document and start. At any
   other place all strings of the phrase are repeated.
3. The dictionary is dealt by trigger to groups of about ``GROUP_BYTES``. Each builds the
   suffix array of its phrases, as deep as the string is long. Neighbours equal that deep are
   one string; the places of their phrases give its first place in the corpus, and which
   strings of a phrase are repeats even at the phrase's first place. A trigger of more than
   ``HOT`` phrases is dealt string by string, by a hash of the string, to as many groups as
   it needs.
4. The removed stretches of a document meet its text, and what is left is hashed.

Triggers and phrases meet by 64-bit hashes, a phrase by both its own and its trigger's.
Strings are compared byte by byte.

Texts are UTF-8 bytes; a null text is empty. Texts shorter than ``LENGTH`` lose nothing. Rows
without an id come before all others and count as one document; rows of one id are one
document, so equal places in them are no repeats of each other. An empty table gives no rows.
Only doc_id and text are read. Memory of a task follows its longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import codes
from barloom.llm.work import stored

LENGTH = 100
TRIGGER = 32
GROUP_BYTES = 4 << 20
HOT = 8192
_PLACE_BITS = np.uint64(30)  # places of a slice, behind the hash that orders triggers


class Parse:
    """Phrases of a slice: place of the trigger, first string, and number of strings."""

    def __init__(self, data: np.ndarray, edges: np.ndarray):
        self.rolling = codes.RollingHash(data)
        empty = np.zeros(0, np.int64)
        self.trigger = self.start = self.strings = self.document = empty
        self.hashes = self.rolling.fixed(TRIGGER)
        if len(data) < LENGTH:
            return
        low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
        least = (self.hashes & ~low) | np.arange(len(self.hashes), dtype=np.uint64)
        span, want = 1, LENGTH - TRIGGER + 1
        while span * 2 <= want:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < want:
            least = np.minimum(least[: len(least) - (want - span)], least[want - span :])
        chosen = (least & low).astype(np.int64)
        size = np.diff(edges)
        room = np.maximum(size - LENGTH + 1, 0)
        document = np.repeat(np.arange(len(size)), room)
        begin = edges[document] + np.arange(len(document)) - np.repeat(np.cumsum(room) - room, room)
        if not len(begin):
            return
        trigger = chosen[begin]
        fresh = np.ones(len(begin), bool)
        fresh[1:] = (trigger[1:] != trigger[:-1]) | (document[1:] != document[:-1])
        first = np.flatnonzero(fresh)
        self.trigger, self.start, self.document = trigger[first], begin[first], document[first]
        self.strings = np.diff(np.append(first, len(begin)))

    def trigger_hashes(self) -> np.ndarray:
        return self.hashes[self.trigger].view(np.int64)


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, text, place (order of the document) and row (hash that tells texts of one id apart)."""
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    text = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", text.alias("text"), place.alias("place"), F.xxhash64(place, text).alias("row"))


def repeated_triggers(texts: DataFrame) -> DataFrame:
    """Hash of every trigger met at more than one place."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, edges in codes.text_slices(batch):
                found, count = np.unique(Parse(data, edges).trigger_hashes(), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(count)], ["trigger", "places"])

    rows = texts.select("text").mapInArrow(counted, "trigger long, places long")
    return rows.groupBy("trigger").agg(F.sum("places").alias("places")).where("places > 1").select("trigger")


def triggers_of_rows(texts: DataFrame) -> DataFrame:
    """row and trigger, once each."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for first, _, data, edges in codes.text_slices(batch):
                parse = Parse(data, edges)
                row, trigger = rows[first + parse.document], parse.trigger_hashes()
                once = np.flatnonzero(np.diff(np.maximum.accumulate(_numbered(row, trigger)), prepend=-1))
                yield pa.RecordBatch.from_arrays([pa.array(row[once]), pa.array(trigger[once])], ["row", "trigger"])

    return texts.select("row", "text").mapInArrow(listed, "row long, trigger long")


def phrases(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The parse: every phrase of a wanted trigger with its place; its text once per task."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            places, rows = batch.column("place").to_numpy(), batch.column("row").to_numpy()
            lists = batch.column("triggers")
            for first, stop, data, edges in codes.text_slices(batch):
                parse = Parse(data, edges)
                own = lists.slice(first, stop - first)
                trigger = parse.trigger_hashes()
                number = np.repeat(np.arange(stop - first), np.diff(own.offsets.to_numpy()))
                at = np.flatnonzero(_among((parse.document, trigger), (number, own.flatten().to_numpy())))
                start, strings, document = parse.start[at], parse.strings[at], parse.document[at]
                end = start + strings + LENGTH - 1
                phrase = parse.rolling.spans(start, end).view(np.int64)
                raw = data.tobytes()
                texts_ = []
                for key, a, b in zip(zip(trigger[at].tolist(), phrase.tolist(), strict=True), start.tolist(), end.tolist(), strict=True):
                    texts_.append(None if key in seen else raw[a:b])
                    seen.add(key)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(trigger[at]),
                        pa.array(phrase),
                        pa.array(places[first + document]),
                        pa.array(rows[first + document]),
                        pa.array(start - edges[document]),
                        pa.array(strings),
                        pa.array(texts_, pa.binary()),
                    ],
                    ["trigger", "phrase", "place", "row", "start", "strings", "text"],
                )

    schema = "trigger long, phrase long, place long, row long, start long, strings long, text binary"
    return texts.join(wanted, "row").select("place", "row", "triggers", "text").mapInArrow(parsed, schema)


def _numbered(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Numbers of the distinct pairs of two whole numbers, from 0 as they come."""
    left, right = pd.factorize(one)[0], pd.factorize(other)[0]
    return pd.factorize(left * np.int64(len(right) + 1) + right)[0]


def _among(pairs: tuple[np.ndarray, np.ndarray], known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which pairs of two whole numbers are among the known ones."""
    own = len(pairs[0])
    number = _numbered(*(np.concatenate(x) for x in zip(pairs, known, strict=True)))
    marks = np.zeros(len(number), bool)
    marks[number[own:]] = True
    return marks[number[:own]]


def string_groups(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The repeated strings of a suffix array of depth LENGTH, and the number of each one's group.

    Sorts the suffixes that begin at ``begin`` by eight bytes at a time; suffixes that differ
    from both neighbours are in place and drop out.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.zeros(len(data), np.uint64)
    for place in range(8):
        eight = (eight << np.uint64(8)) | padded[place : place + len(data)]
    at, group = begin, np.zeros(len(begin), np.int64)
    for depth in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        key = eight[at + depth]
        order = np.lexsort((key, group)) if depth else np.argsort(key, kind="stable")
        at, group, key = at[order], group[order], key[order]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        group = np.cumsum(fresh) - 1
        tied = np.bincount(group, minlength=1)[group] > 1 if len(group) else fresh
        at, group = at[tied], group[tied]
    return at, group


def later_strings(table: pa.Table) -> pa.Table:
    """Runs (low to high) of a phrase's strings that begin earlier in the corpus than at its first place."""
    names = ("trigger", "phrase", "place", "start", "offset", "strings")
    trigger, phrase, place, start, offset, strings = (table[x].to_numpy() for x in names)
    data, border = codes.text_bytes(table["text"])
    owner = np.repeat(np.arange(len(strings)), strings)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
    at, group = string_groups(data, border[owner] + within)
    owner = np.searchsorted(border, at, "right") - 1
    within = at - border[owner]
    begins = start[owner] + within
    order = np.lexsort((begins, place[owner], group))
    owner, within, group, begins = owner[order], within[order], group[order], begins[order]
    first = np.searchsorted(group, group)
    later = (place[owner] != place[owner[first]]) | (begins != begins[first])
    owner, within = owner[later], within[later]
    order = np.lexsort((within, owner))
    owner, within = owner[order], within[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (within[1:] != within[:-1] + 1)
    run = np.flatnonzero(fresh)
    end = np.append(run[1:], len(owner)) - 1 if len(run) else run
    one = owner[run]
    low, high = within[run] + offset[one], within[end] + offset[one]
    return pa.table({"trigger": trigger[one], "phrase": phrase[one], "low": low, "high": high})


def dictionary_repeats(dictionary: DataFrame) -> DataFrame:
    """trigger, phrase, low and high of the runs of repeated strings at the phrases' first places."""
    several = dictionary.groupBy("trigger").agg(F.count("*").alias("phrases")).where("phrases > 1")
    rows = dictionary.join(several, "trigger").withColumn("groups", F.ceil(F.col("phrases") / HOT))
    whole = rows.where("groups = 1").select("trigger", "phrase", "place", "start", F.lit(0).cast("long").alias("offset"), "strings", "text", F.xxhash64("trigger").alias("deal"))
    single = (
        rows.where("groups > 1")
        .withColumn("offset", F.explode(F.sequence(F.lit(0).cast("long"), F.col("strings") - 1)))
        .withColumn("text", F.expr(f"substring(text, cast(offset + 1 as int), {LENGTH})"))
        .select("trigger", "phrase", "place", (F.col("start") + F.col("offset")).alias("start"), "offset", F.lit(1).cast("long").alias("strings"), "text", F.xxhash64("text").alias("deal"))
    )
    dealt = stored(whole.unionAll(single), "dictionary")
    total = dealt.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = total // GROUP_BYTES + 1
    return (
        dealt.withColumn("deal", F.pmod("deal", F.lit(groups)))
        .groupBy("deal")
        .applyInArrow(later_strings, "trigger long, phrase long, low long, high long")
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans cover."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], end))
        else:
            found.append((start, end))
    return found


def repeated_spans(texts: DataFrame) -> DataFrame:
    """place, row and spans (start, end in bytes) of every document that repeats something."""
    wanted = (
        triggers_of_rows(texts)
        .join(stored(repeated_triggers(texts), "triggers"), "trigger", "left_semi")
        .groupBy("row")
        .agg(F.collect_set("trigger").alias("triggers"))
    )
    parse = stored(phrases(texts, stored(wanted, "wanted")), "parse")
    first = F.min(F.struct("place", "start")).alias("first")
    dictionary = stored(
        parse.groupBy("trigger", "phrase")
        .agg(first, F.count("*").alias("places"), F.max("strings").alias("strings"), F.max("text").alias("text"))
        .select("trigger", "phrase", "first.place", "first.start", "places", "strings", "text"),
        "phrases",
    )
    found = parse.drop("text")
    again = dictionary.where("places > 1").select("trigger", "phrase", F.col("place").alias("p"), F.col("start").alias("s"))
    whole = (
        found.join(again, ["trigger", "phrase"])
        .where("place <> p or start <> s")
        .select("place", "row", "start", (F.col("start") + F.col("strings") + LENGTH - 1).alias("end"))
    )
    runs = dictionary_repeats(dictionary).join(dictionary.select("trigger", "phrase", "place", "start"), ["trigger", "phrase"])
    part = found.join(runs, ["trigger", "phrase", "place", "start"]).select(
        "place", "row", (F.col("start") + F.col("low")).alias("start"), (F.col("start") + F.col("high") + LENGTH).alias("end")
    )
    spans = whole.unionAll(part).groupBy("place", "row")
    return spans.agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def deduplicated(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans removed and bytes kept of every row."""
    texts = keyed(documents)
    spans = stored(repeated_spans(texts), "spans")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType(
        [documents.schema["doc_id"]]
        + [T.StructField(x, T.LongType()) for x in ("n_bytes", "n_removed", "n_spans")]
        + [T.StructField("kept_sha256", T.StringType()), T.StructField("removed", span), T.StructField("kept", T.BinaryType())]
    )
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, parts = [], [], []
            for text, spans in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                runs = merged([(x["start"], x["end"]) for x in spans or ()])
                pieces, done = [], 0
                for start, end in runs:
                    pieces.append(text[done:start])
                    done = end
                sizes.append(len(text))
                removed.append(runs)
                parts.append(b"".join([*pieces, text[done:]]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array([sum(b - a for a, b in x) for x in removed], pa.int64()),
                    pa.array([len(x) for x in removed], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in parts], pa.string()),
                    pa.array([[{"start": a, "end": b} for a, b in x] for x in removed], kind),
                    pa.array(parts, pa.binary()),
                ],
                schema.names,
            )

    both = texts.join(spans, ["place", "row"], "left").select("doc_id", "text", "spans")
    return both.mapInArrow(kept, schema)
