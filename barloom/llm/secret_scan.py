"""Secrets in texts: base patterns, and a linear-chain conditional random field that adds to them.

Texts are cut into tokens (runs of letters, digits and ``+/_-``, or single other signs) and
lines. The field tags every token as begin, inside or outside of a secret from its shape,
the words and shapes around it and features of line and file; the best tag sequence of a
line is decoded by Viterbi. Weights are learned by maximum likelihood on lines of a bounded
sample whose tags come from the base patterns: ``SAMPLE_ROWS`` documents with the smallest hash of
their id, half of them among the documents with a base match, of ``SAMPLE_BYTES`` of text at
most. Every line with a secret is learned twice, once without its words, so that the field also
knows secrets by their shape alone.

Spans count code points, end exclusive. Base spans are always kept; a decoded span is added,
as kind ``crf``, if it has ``MIN_CHARS`` code points and meets no base span. A null or empty
text has no spans; texts of any length are scanned whole. Repeated rows are scanned each for
itself; an empty table gives no rows. Where no document with an id has a base match, nothing is
added. Columns of the input that bear an output's name are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import codes
from barloom.llm.work import in_one_task, smallest_by_hash, stored, within_bytes

SAMPLE_ROWS = 3000
SAMPLE_BYTES = 32 << 20
SAMPLE_LINES = 2
LINE_TOKENS = 48
STEPS = 50
RATE = 0.1
DECAY = 1e-3
MIN_CHARS = 8
HASHED = 1 << 14
KINDS = ("assign", "access", "hex", "crf")
REDACTED = "[SECRET]"

# The base patterns.
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: a text with a match of any of them
ANY = "(?i:" + ASSIGN.pattern.removesuffix("+)") + "{8,}))|" + ACCESS.pattern + "|" + HEX.pattern

_TAGS = 3  # outside, begin, inside
_NEVER = -1e4
_TEMPLATES = 13

_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_SIGN = np.isin(_BYTES, list(b"+/_-"))
_HEX = _DIGIT | ((_BYTES >= 97) & (_BYTES <= 102))
_RUN = _DIGIT | _UPPER | _LOWER | _SIGN
_GROUP = (_DIGIT * 1 + _UPPER * 2 + _LOWER * 3 + _SIGN * 4).astype(np.int8)


def base_matches(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself) of the base patterns, ordered."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in WORDS):
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= 8:
                found.append((match.start(), 0, match.end(), match.start(2)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


@dataclass
class Tokens:
    start: np.ndarray
    end: np.ndarray
    document: np.ndarray
    lines: np.ndarray  # first token of every line, and the number of tokens
    features: np.ndarray  # [tokens, templates]


def tokens(data: np.ndarray, edges: np.ndarray) -> Tokens:
    """Tokens of a slice with the feature numbers of each."""
    run = _RUN[data]
    border = np.zeros(len(data) + 1, bool)
    border[edges] = True
    sign = ~run & ~codes.SPACE[data]
    first = run.copy()
    first[1:] &= ~run[:-1] | border[1:-1]
    last = run.copy()
    last[:-1] &= ~run[1:] | border[1:-1]
    start, end = np.flatnonzero(first | sign), np.flatnonzero(last | sign) + 1
    document = np.searchsorted(edges, start, "right") - 1
    count = len(start)
    if not count:
        return Tokens(start, end, document, np.zeros(1, np.int64), np.zeros((0, _TEMPLATES), np.int32))

    newlines = np.cumsum(data == 10)[start]
    parted = (np.diff(newlines) != 0) | (np.diff(document) != 0)
    lines = np.concatenate([[0], np.flatnonzero(parted) + 1, [count]])
    line = np.repeat(np.arange(len(lines) - 1), np.diff(lines))

    def inside(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marks[data], dtype=np.int32)])
        return sums[end] - sums[start]

    size = end - start
    digits, uppers, lowers, signs, hexes = (inside(x) for x in (_DIGIT, _UPPER, _LOWER, _SIGN, _HEX))
    group = _GROUP[data]
    turns = np.concatenate([[0], np.cumsum(group[1:] != group[:-1], dtype=np.int32)])
    turns = turns[end - 1] - turns[start]
    length = np.searchsorted([2, 4, 8, 12, 16, 24, 40], size, "right")
    share = np.where(digits == 0, 0, np.where(digits * 10 < 3 * size, 1, np.where(digits * 10 < 7 * size, 2, 3)))
    mixing = np.searchsorted([1, 3, 7], turns, "right")
    shape = length * 4 + share
    for part in (uppers > 0, lowers > 0, signs > 0, hexes == size):
        shape = shape * 2 + part
    shape = shape * 4 + mixing
    shape = np.where(sign[start], 4096 + data[start].astype(np.int64), shape).astype(np.int64)

    word = codes.RollingHash(codes.LOWER[data]).spans(start, end)
    word = np.where((digits > 0) | (size > 16), np.uint64(0), word | np.uint64(1))

    def beside(values: np.ndarray, distance: int) -> np.ndarray:
        """The value so many tokens away on the same line, else a fixed one."""
        moved = np.full(count, 7, values.dtype)
        if abs(distance) < count:
            here, there = (slice(-distance, None), slice(None, distance)) if distance < 0 else (slice(None, -distance), slice(distance, None))
            moved[here] = np.where(line[here] == line[there], values[there], 7)
        return moved

    marks = sign[start].astype(np.float64)
    whole = np.bincount(document, marks, minlength=len(edges) - 1) / np.maximum(np.bincount(document, minlength=len(edges) - 1), 1)
    signed = np.searchsorted([0.1, 0.25, 0.5], whole)[document]
    given = np.bincount(line, np.isin(data[start], list(b"=:")), minlength=len(lines) - 1)[line] > 0
    setting = (signed * 2 + given).astype(np.uint64)
    key = shape.astype(np.uint64)
    columns = [
        word,
        beside(word, -1),
        beside(word, -2),
        beside(word, -3),
        beside(word, 1),
        key,
        beside(key, -1),
        beside(key, 1),
        key * np.uint64(1 << 20) + beside(key, -1),
        (length * 16 + share * 4 + mixing).astype(np.uint64),
        (share * 4 + mixing).astype(np.uint64),
        key * np.uint64(1 << 20) + setting,
        codes.mixed(key) ^ beside(word, -2),
    ]
    features = np.empty((count, _TEMPLATES), np.int32)
    for place, column in enumerate(columns):
        features[:, place] = codes.mixed(column) % np.uint64(HASHED) + place * HASHED
    return Tokens(start, end, document, lines, features)


#: templates that name words; they are hidden in the second copy of a line with a secret
_WORDED = (0, 1, 2, 3, 4, 12)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # [features, tags]
    moves: np.ndarray  # [from, to]


def _character_offsets(data: np.ndarray, edges: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Turns byte offsets of a slice into code points of their document."""
    sums = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return lambda place, document: sums[place] - sums[edges[document]]


def _training_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed, tagged = [], []
        texts = batch.column("text").to_pylist()
        for first, _, data, edges in codes.text_slices(batch):
            made = tokens(data, edges)
            place = _character_offsets(data, edges)
            begin, finish = place(made.start, made.document), place(made.end, made.document)
            tags = np.zeros(len(begin), np.int8)
            span = np.searchsorted(made.document, np.arange(len(edges)))
            for row in range(len(edges) - 1):
                own = slice(span[row], span[row + 1])
                for _, _, stop, secret in base_matches(texts[first + row] or ""):
                    low = np.searchsorted(finish[own], secret, "right") + span[row]
                    high = np.searchsorted(begin[own], stop, "left") + span[row]
                    if low < high:
                        tags[low:high] = 2
                        tags[low] = 1
            lines = len(made.lines) - 1
            if not lines:
                continue
            secret = np.add.reduceat(tags > 0, made.lines[:-1]) > 0
            of = made.document[made.lines[:-1]]
            rank = np.arange(lines) - np.searchsorted(of, of)
            plain = rank % np.maximum(np.bincount(of)[of] // SAMPLE_LINES, 1) == 0
            for line in np.flatnonzero(secret | plain):
                low, high = made.lines[line], made.lines[line + 1]
                if secret[line]:
                    low = max(low, low + int(np.argmax(tags[low:high] > 0)) - LINE_TOKENS // 2)
                high = min(high, low + LINE_TOKENS)
                packed.append(made.features[low:high].tobytes())
                tagged.append(tags[low:high].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), pa.array(tagged, pa.binary())], ["features", "tags"])


def _fitted(found: pa.Table) -> pa.Table:
    lines = sorted(zip(found["tags"].to_pylist(), found["features"].to_pylist(), strict=True))
    model = fit([np.frombuffer(x, np.int32).reshape(-1, _TEMPLATES) for _, x in lines], [np.frombuffer(x, np.int8) for x, _ in lines])
    return pa.table({"weights": pa.array([model.weights.tobytes()], pa.binary()), "moves": pa.array([model.moves.tobytes()], pa.binary())})


def sample(documents: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` ids: half of them of documents with a base match, if there are so many, half of all documents."""
    known = documents.where(F.col("doc_id").isNotNull())
    matched = stored(known.where(F.col("text").rlike(ANY)).select("doc_id").distinct(), "matched")
    whole = smallest_by_hash(known.select("doc_id").distinct(), "doc_id", rows - rows // 2)
    return smallest_by_hash(matched, "doc_id", rows // 2).unionByName(whole).distinct()


def train(documents: DataFrame, rows: int = SAMPLE_ROWS, limit: int = SAMPLE_BYTES) -> Model:
    """Fit the field, in a task, on lines of at most ``rows`` documents of ``limit`` bytes, ``SAMPLE_LINES`` plain lines or so each."""
    texts = documents.select("doc_id", "text").join(F.broadcast(sample(documents, rows)), "doc_id")
    texts = within_bytes(stored(texts, "sampled"), "doc_id", limit).select("text")
    row = in_one_task(texts.mapInArrow(_training_lines, "features binary, tags binary"), _fitted, "weights binary, moves binary")
    if not row:
        return fit([], [])
    weights = np.frombuffer(row["weights"], np.float32).reshape(-1, _TAGS)
    return Model(weights, np.frombuffer(row["moves"], np.float64).reshape(_TAGS, _TAGS))


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    return (np.log(np.exp(values - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def fit(features: list[np.ndarray], tags: list[np.ndarray]) -> Model:
    """Maximum likelihood by Adam; expectations by forward and backward sums over all lines at once."""
    weights = np.zeros((_TEMPLATES * HASHED, _TAGS))
    moves = np.zeros((_TAGS, _TAGS))
    moves[0, 2] = _NEVER
    if not any(x.any() for x in tags):
        weights[:, 1] = _NEVER
        return Model(weights.astype(np.float32), moves)
    for line in range(len(tags)):
        if tags[line].any():
            hidden = features[line].copy()
            for place in _WORDED:
                hidden[:, place] = place * HASHED
            features.append(hidden)
            tags.append(tags[line])
    sizes = np.array([len(x) for x in tags])
    count, longest = len(sizes), sizes.max()
    real = np.arange(longest) < sizes[:, None]
    index = np.zeros((count, longest, _TEMPLATES), np.int32)
    index[real] = np.concatenate(features)
    tag = np.zeros((count, longest), np.int8)
    tag[real] = np.concatenate(tags)
    flat = index[real]
    buckets = [flat[:, place] - place * HASHED for place in range(_TEMPLATES)]

    def gathered(mass: np.ndarray) -> np.ndarray:
        """Sum of each token's mass of tags over the features it has."""
        found = np.empty_like(weights)
        for place, bucket in enumerate(buckets):
            for label in range(_TAGS):
                found[place * HASHED : (place + 1) * HASHED, label] = np.bincount(bucket, mass[:, label], minlength=HASHED)
        return found

    observed = gathered(np.eye(_TAGS)[tag[real]])
    follows = real[:, 1:]
    pairs = np.zeros_like(moves)
    np.add.at(pairs, (tag[:, :-1][follows], tag[:, 1:][follows]), 1)

    total = real.sum()
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    for step in range(1, STEPS + 1):
        emitted = np.zeros((count, longest, _TAGS))
        emitted[real] = sum(weights[flat[:, place]] for place in range(_TEMPLATES))
        ahead = np.empty_like(emitted)
        ahead[:, 0] = emitted[:, 0] + [0, 0, _NEVER]
        for t in range(1, longest):
            step_in = _logsum(ahead[:, t - 1, :, None] + moves, 1) + emitted[:, t]
            ahead[:, t] = np.where(real[:, t, None], step_in, ahead[:, t - 1])
        normal = _logsum(ahead[:, -1], 1)
        behind = np.zeros((count, _TAGS))
        expected = np.zeros_like(pairs)
        chance = np.zeros_like(emitted)
        for t in range(longest - 1, -1, -1):
            chance[:, t] = np.exp(ahead[:, t] + behind - normal[:, None])
            if t:
                joint = ahead[:, t - 1, :, None] + moves + (emitted[:, t] + behind)[:, None, :]
                mass = np.exp(joint - normal[:, None, None]) * real[:, t, None, None]
                expected += mass.sum(0)
                behind = np.where(real[:, t, None], _logsum(joint - ahead[:, t - 1, :, None], 2), behind)
        slopes = [gathered(chance[real]) - observed + DECAY * weights, expected - pairs]
        for which, point in enumerate((weights, moves)):
            slope, first, second = slopes[which] / total, state[2 * which], state[2 * which + 1]
            first += 0.1 * (slope - first)
            second += 0.001 * (slope**2 - second)
            point -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        moves[0, 2] = _NEVER
    return Model(weights.astype(np.float32), moves)


def decode(emitted: np.ndarray, lines: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tag of every token by Viterbi, all lines of a slice side by side."""
    sizes = np.diff(lines)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = lines[:-1][order], sizes[order]
    tags = np.zeros(len(emitted), np.int8)
    if not len(sizes):
        return tags
    longest = sizes[0]
    active = np.searchsorted(-sizes, -np.arange(longest), "left")  # lines longer than t
    back = np.zeros((len(emitted), _TAGS), np.int8)
    reach = emitted[first] + np.array([0, 0, _NEVER])
    for t in range(1, longest):
        at = first[: active[t]] + t
        ways = reach[: active[t], :, None] + moves
        back[at] = ways.argmax(1)
        reach[: active[t]] = ways.max(1) + emitted[at]
    tag = reach.argmax(1)
    for t in range(longest - 1, -1, -1):
        now = slice(0, active[t])
        if t + 1 < longest:
            later = active[t + 1]
            tag[:later] = back[first[:later] + t + 1, tag[:later]]
        tags[first[now] + t] = tag[now]
    return tags


def found_spans(data: np.ndarray, edges: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end (code points) of every decoded secret of a slice."""
    made = tokens(data, edges)
    emitted = np.zeros((len(made.start), _TAGS), np.float32)
    for place in range(_TEMPLATES):
        emitted += model.weights[made.features[:, place]]
    tags = decode(emitted, made.lines, model.moves)
    begin = np.flatnonzero(tags == 1)
    closed = np.flatnonzero(tags != 2)
    after = np.searchsorted(closed, begin, "right")
    stop = np.where(after < len(closed), closed[np.minimum(after, len(closed) - 1)] if len(closed) else 0, len(tags))
    next_line = made.lines[np.searchsorted(made.lines, begin, "right")] if len(begin) else begin
    stop = np.minimum(stop, next_line)
    place = _character_offsets(data, edges)
    document = made.document[begin]
    return document, place(made.start[begin], document), place(made.end[stop - 1], document)


def scan_batch(batch: pa.RecordBatch, model: Model, column: str = "text") -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of all spans of each text of a batch, ordered."""
    texts = batch.column(column).to_pylist()
    spans: list[list[tuple[int, int, int]]] = []
    for text in texts:
        spans.append([(start, kind, end) for start, kind, end, _ in base_matches(text or "")])
    for first, _, data, edges in codes.text_slices(batch, column):
        added: dict[int, list[tuple[int, int, int]]] = {}
        for document, start, end in zip(*(x.tolist() for x in found_spans(data, edges, model)), strict=True):
            if end - start >= MIN_CHARS:
                base = spans[first + document]
                if not any(start < stop and low < end for low, _, stop in base):
                    added.setdefault(first + document, []).append((start, 3, end))
        for row, more in added.items():
            spans[row] = sorted(spans[row] + more)
    return spans


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def scan(documents: DataFrame, model: Model, name: str = "secrets") -> DataFrame:
    """All rows and columns of ``documents`` with an array of spans (kind, start, end)."""
    kept = documents.drop(name)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.ArrayType(_SPAN))])
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in x] for x in scan_batch(batch, shared.value)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], [*batch.schema.names, name])

    return kept.mapInArrow(scanned, schema)


def redact(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with every stretch of secrets replaced by a mark; n_chars follows the text."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def cleaned(text: str, spans: list[tuple[int, int, int]]) -> str:
        parts, done = [], 0
        for start, _, end in spans:
            if start >= done:
                parts += [text[done:start], REDACTED]
            done = max(done, end)
        return "".join([*parts, text[done:]])

    def redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = scan_batch(batch, shared.value)
            new = [cleaned(text, own) if own else text for text, own in zip(texts, spans, strict=True)]
            names = batch.schema.names
            columns = [pa.array(new, batch.schema.field(i).type) if x == "text" else batch.column(i) for i, x in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names)

    changed = documents.mapInArrow(redacted, documents.schema)
    if "n_chars" in documents.columns:
        kind = dict(documents.dtypes)["n_chars"]
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed


def secret_spans(documents: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, digest of the base spans, and all spans as text."""
    model = train(documents)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kept = documents.select("doc_id", "text")
    schema = T.StructType(
        [kept.schema["doc_id"]]
        + [T.StructField(x, T.LongType()) for x in ("n_assign", "n_access", "n_hex")]
        + [T.StructField(x, T.StringType()) for x in ("base_sha256", "spans")]
        + [T.StructField("n_crf", T.LongType())]
    )

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = scan_batch(batch, shared.value)
            base = [[x for x in own if x[1] < 3] for own in spans]
            counts = [pa.array([sum(x[1] == k for x in own) for own in spans], pa.int64()) for k in range(4)]
            digests = [hashlib.sha256(_written(own).encode()).hexdigest() for own in base]
            texts = [_written(own) for own in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts[:3], pa.array(digests, pa.string()), pa.array(texts, pa.string()), counts[3]],
                schema.names,
            )

    return kept.mapInArrow(digested, schema)
