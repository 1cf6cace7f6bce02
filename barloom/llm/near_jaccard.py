"""Jaccard self-join on word n-grams by rare-first prefix filtering.

The join finds all pairs of documents whose sets of word shingles have a Jaccard similarity
of ``least / 100`` or more, and returns their components: one row per document.

1. One pass hashes every document's shingle set, and counts all shingles of the corpus, equal
   sets of a task once, in ``BUCKETS`` hashed buckets. Documents of equal sets become one node.
2. Shingles are ordered rare first (bucket count, then hash: one order for the corpus). Two
   similar sets of n and m shingles share one of the first n - ceil(n t) + 1 and m - ceil(m t)
   + 1 of them, so only these prefixes are joined. Rows that meet at a shingle are paired if
   sizes (length filter), ranks (positional filter) and 256-bit parity sketches of the sets,
   whose distance never exceeds that of the sets (suffix filter), allow the similarity. A
   shingle of over ``HOT`` occurrences more than usual is dealt to a grid of cells that hold ``HOT`` or
   so, each pair of parts in one cell. The rows that such pairs connect are a crowd; crowds of
   the same nodes become one.
3. Sketches of 256 bits tell nothing of sets of more than some 600 shingles, of which any two that
   share one by chance meet. So each set of a crowd brings a signature as long as the set asks
   for (the shingles it has in each of many parts of the hash space; the distance of two never
   exceeds that of the sets), and only a spanning forest of the pairs that signatures allow is
   kept, never the pairs.
4. The components of these candidates are families. Sets travel once to their family (large
   families are cut into a grid of blocks of ``BLOCK_NODES``), where each candidate pair that
   is not yet connected is verified, once, on whole sets. The links give the components.

Shingles and nodes are 64-bit hashes; sizes and similarities are those of the hash sets.
A null text, or one without words, has no shingle and is linked with nothing; a text of fewer
words than a shingle is one shingle. Rows are numbered once in a stored table and told apart by
that number, so that repeated or null ids lose no link: a component is named by its smallest id
that is not null, and has none if all are null. Of equal rows, and of rows with equal ids in one
component, the first stays. An empty table gives no rows. Only doc_id and text are read for links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import codes
from barloom.llm.components import components
from barloom.llm.work import stored

BUCKETS = 1 << 21
COUNT_BLOCK = 1 << 13
HOT = 4096
BLOCK_NODES = 512
SKETCH_WORDS = 4
#: a signature has a part for four to eight shingles, and so many parts
FEWEST_PARTS, MOST_PARTS = 8, 1 << 16


def prefix_sizes(sizes: np.ndarray, least: int) -> np.ndarray:
    """How many rare-first shingles of a set of each size can decide a similarity of least / 100."""
    return np.where(sizes > 0, sizes + 1 + (-least * sizes) // 100, 0)


def needed(n: np.ndarray, m: np.ndarray, least: int) -> np.ndarray:
    """Smallest intersection of sets of n and m with 100 * intersection >= least * union."""
    return -((-least * (n + m)) // (100 + least))


def _sketches(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """256-bit parity sketch of each set: bit i is the parity of its shingles that hash to i."""
    rows = len(edges) - 1
    row = np.repeat(np.arange(rows), np.diff(edges))
    bit = (values >> np.uint64(56)).astype(np.int64)
    odd = (np.bincount(row * 256 + bit, minlength=rows * 256) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(rows, 256), axis=1).view(np.uint64).reshape(rows, SKETCH_WORDS)


def _signatures(values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many shingles, modulo 256, each set has in each part of the hash space, as bytes and the borders of the sets.

    The number of parts is a power of two that grows with the set; an empty set has none.
    """
    size = np.diff(edges)
    bits = np.ceil(np.log2(np.clip(size / 8, FEWEST_PARTS, MOST_PARTS))).astype(np.int64)
    borders = np.concatenate([[0], np.cumsum(np.where(size > 0, 1 << bits, 0))])
    part = values >> (64 - np.repeat(bits, size)).astype(np.uint64)
    at = np.repeat(borders[:-1], size) + part.astype(np.int64)
    return np.bincount(at, minlength=borders[-1]).astype(np.uint8), borders


def _folded(signatures: np.ndarray, parts: int) -> np.ndarray:
    """Signatures (along the last axis) in so many parts, as many as they have or fewer."""
    return signatures.reshape(*signatures.shape[:-1], parts, -1).sum(-1, dtype=np.uint8)


def _apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Distance of signatures of as many parts (along the last axis), never above that of the sets."""
    return np.abs((one - other).view(np.int8).astype(np.int16)).sum(-1, dtype=np.int64)


def _nodes(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One number for each set; equal sets have equal numbers, empty ones 0."""
    size = np.diff(edges)
    total = np.zeros(len(size), np.uint64)
    filled = np.flatnonzero(size)
    if len(filled):
        total[filled] = np.add.reduceat(codes.mixed(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), edges[:-1][filled])
    return np.where(size > 0, codes.mixed(total + size.astype(np.uint64)), np.uint64(0)).view(np.int64)


def _shingled(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for start, stop, data, edges in codes.text_slices(batch):
        found, document = codes.word_hashes(data, edges)
        yield start, stop, *codes.shingles(found, document, stop - start, words)


def survey(documents: DataFrame, words: int) -> DataFrame:
    """One row per document (row, doc_id, node, n, signature), and the tasks' bucket counts (block, counts)."""
    kind = documents.schema["doc_id"]

    def surveyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "node", "n", "signature", "block", "counts"]
        count = np.zeros(BUCKETS, np.int64)
        waiting: list[np.ndarray] = []
        seen: set[int] = set()  # sets of this task: copies count once, as they are joined once
        id_type = None

        def tally() -> None:
            if waiting:
                np.add(count, np.bincount(np.concatenate(waiting), minlength=BUCKETS), out=count)
                waiting.clear()

        for batch in batches:
            id_type = batch.column("doc_id").type
            for start, stop, values, edges in _shingled(batch, words):
                rows, node = stop - start, _nodes(values, edges)
                fresh = np.zeros(rows, bool)
                for row, number in enumerate(node.tolist()):
                    if number not in seen:
                        seen.add(number)
                        fresh[row] = True
                waiting.append((values[np.repeat(fresh, np.diff(edges))] % np.uint64(BUCKETS)).astype(np.int64))
                if sum(map(len, waiting)) > BUCKETS:
                    tally()
                parts, borders = _signatures(values, edges)
                signature = pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(borders), pa.py_buffer(parts)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(start, rows),
                        batch.column("doc_id").slice(start, rows),
                        pa.array(node),
                        pa.array(np.diff(edges)),
                        signature.cast(pa.binary()),
                        pa.nulls(rows, pa.int32()),
                        pa.nulls(rows, pa.binary()),
                    ],
                    names,
                )
        tally()
        blocks = BUCKETS // COUNT_BLOCK
        if id_type is None or not count.any():
            return
        packed = [codes.packed(x) for x in count.reshape(blocks, COUNT_BLOCK)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(blocks, pa.int64()),
                pa.nulls(blocks, id_type),
                pa.nulls(blocks, pa.int64()),
                pa.nulls(blocks, pa.int64()),
                pa.nulls(blocks, pa.binary()),
                pa.array(np.arange(blocks), pa.int32()),
                pa.array(packed, pa.binary()),
            ],
            names,
        )

    return documents.select("row", "doc_id", "text").mapInArrow(
        surveyed, f"row long, doc_id {kind.dataType.simpleString()}, node long, n long, signature binary, block int, counts binary"
    )


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Occurrences in each bucket over the corpus: a table of fixed size, whatever the input."""

    def summed(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNT_BLOCK, np.int64)
        for batch in batches:
            for data in batch.column("counts").to_pylist():
                total += codes.unpacked(data)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([codes.packed(total)], pa.binary())], ["block", "counts"])

    found = rows.where("block is not null").select("block", "counts")
    whole = np.zeros(BUCKETS, np.int64)
    for row in found.groupBy("block").applyInArrow(summed, "block int, counts binary").toLocalIterator():
        whole[row["block"] * COUNT_BLOCK : (row["block"] + 1) * COUNT_BLOCK] = codes.unpacked(row["counts"])
    return whole


def _ranked(values: np.ndarray, edges: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each set in rare-first order, with the count of each."""
    rows = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    count = counts[(values % np.uint64(BUCKETS)).astype(np.int64)].astype(np.int64)
    order = np.lexsort((values, count, rows))
    return values[order], count[order]


_PREFIX = "shingle long, cell long, node long, n int, rank int, sketch binary"


def prefixes(documents: DataFrame, words: int, least: int, shared: Broadcast, usual: int) -> DataFrame:
    """The prefix rows of all sets, each set once per task; hot shingles are dealt to cells.

    ``shared``: the bucket counts; ``usual``: what chance puts into a bucket.
    """

    def prefixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, values, edges in _shingled(batch, words):
                size = np.diff(edges)
                node = _nodes(values, edges)
                fresh = np.zeros(len(node), bool)
                for row, number in enumerate(node.tolist()):
                    if size[row] and number not in seen:
                        seen.add(number)
                        fresh[row] = True
                sketch = _sketches(values, edges)
                values, count = _ranked(values, edges, shared.value)
                width = np.where(fresh, prefix_sizes(size, least), 0)
                row = np.repeat(np.arange(len(size)), width)
                rank = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width)
                at = edges[row] + rank
                # a hot shingle: parts by hash of the node, one cell for each pair of parts
                parts = np.maximum(-(-(count[at] - usual) // HOT), 1)
                again = np.repeat(np.arange(len(row)), parts)
                other = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
                row, rank, at, parts = row[again], rank[again], at[again], parts[again]
                own = (node.view(np.uint64)[row] >> np.uint64(8)).astype(np.int64) % parts
                cell = np.minimum(own, other) * (1 << 31) + np.maximum(own, other)
                raw = sketch.tobytes()
                width_bytes = 8 * SKETCH_WORDS
                pieces = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width_bytes), len(size), [None, pa.py_buffer(raw)])
                for low in range(0, len(row), 1 << 16):
                    part = slice(low, low + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(values.view(np.int64)[at[part]]),
                            pa.array(cell[part]),
                            pa.array(node[row[part]]),
                            pa.array(size[row[part]].astype(np.int32)),
                            pa.array(rank[part].astype(np.int32)),
                            pieces.take(pa.array(row[part])).cast(pa.binary()),
                        ],
                        ["shingle", "cell", "node", "n", "rank", "sketch"],
                    )

    return documents.select("text").mapInArrow(prefixed, _PREFIX)


def _possible(n: np.ndarray, rank: np.ndarray, sketch: np.ndarray, one: int, rest: np.ndarray, least: int) -> np.ndarray:
    """Which of ``rest`` may be similar to row ``one`` of a shingle's rows: length, positional and suffix filter."""
    m, mine = n[rest], n[one]
    kept = (100 * np.minimum(m, mine) >= least * np.maximum(m, mine))
    want = needed(m, np.int64(mine), least)
    kept &= np.minimum(m - rank[rest], mine - rank[one]) >= want
    apart = np.bitwise_count(sketch[rest] ^ sketch[one]).sum(1)
    return kept & (apart <= m + mine - 2 * want)


def _trees(members: np.ndarray, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[list[tuple[int, int]]]:
    """Edges that span each component of ``members``; ``near``: which of the rest one member is paired with."""
    waiting = members
    while len(waiting) > 1:
        edges, frontier, waiting = [], [int(waiting[0])], waiting[1:]
        while frontier and len(waiting):
            one = frontier.pop()
            close = near(one, waiting)
            for other in waiting[close].tolist():
                edges.append((one, other))
                frontier.append(other)
            waiting = waiting[~close]
        if edges:
            yield edges


def _marks(node: np.ndarray) -> np.ndarray:
    """One number for each node; their sum, mixed, names a crowd. Crowds of one name are compared as one."""
    return codes.mixed(node.view(np.uint64) ^ np.uint64(0x5A5A5A5A5A5A5A5A))


def _candidates(least: int):
    """Stream rows ordered by (shingle, cell); a group at a batch's end waits for the next batch."""

    def crowds_of(block: list[np.ndarray]) -> pa.RecordBatch:
        shingle, cell, node, n, rank, sketch = block
        fresh = np.ones(len(shingle), bool)
        fresh[1:] = (shingle[1:] != shingle[:-1]) | (cell[1:] != cell[:-1])
        first = np.append(np.flatnonzero(fresh), len(shingle))
        size = np.diff(first)
        names, members = [], []
        two = first[:-1][size == 2]
        if len(two):
            m, k = n[two], n[two + 1]
            want = needed(m, k, least)
            kept = (node[two] != node[two + 1]) & (100 * np.minimum(m, k) >= least * np.maximum(m, k))
            kept &= np.minimum(m - rank[two], k - rank[two + 1]) >= want
            kept &= np.bitwise_count(sketch[two] ^ sketch[two + 1]).sum(1) <= m + k - 2 * want
            pairs = np.stack([node[two[kept]], node[two[kept] + 1]], 1)
            names.append(np.repeat(codes.mixed(_marks(pairs).sum(1)), 2))
            members.append(pairs.ravel())
        for group in np.flatnonzero(size > 2):
            own = slice(first[group], first[group + 1])
            rows = [x[own] for x in (n, rank, sketch)]
            _, once = np.unique(node[own], return_index=True)
            for edges in _trees(once, lambda one, rest, rows=rows: _possible(*rows, one, rest, least)):
                crowd = node[own][[edges[0][0], *(other for _, other in edges)]]
                names.append(np.repeat(codes.mixed(_marks(crowd).sum(keepdims=True)), len(crowd)))
                members.append(crowd)
        name = np.concatenate(names or [np.zeros(0, np.uint64)]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(name), pa.array(np.concatenate(members or [np.zeros(0, np.int64)]))], ["crowd", "node"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            block = [batch.column(x).to_numpy(zero_copy_only=False) for x in ("shingle", "cell", "node", "n", "rank")]
            block[3:5] = [x.astype(np.int64) for x in block[3:5]]
            sketch = batch.column("sketch")
            raw = np.frombuffer(sketch.buffers()[2], np.uint8)
            start = np.frombuffer(sketch.buffers()[1], np.int32)[sketch.offset]
            size = 8 * SKETCH_WORDS * len(sketch)
            block.append(raw[start : start + size].copy().view(np.uint64).reshape(-1, SKETCH_WORDS))
            if held is not None:
                block = [np.concatenate(x) for x in zip(held, block, strict=True)]
            last = (block[0] == block[0][-1]) & (block[1] == block[1][-1])
            cut = int(np.argmax(last))
            held = [x[cut:] for x in block]
            if cut:
                yield crowds_of([x[:cut] for x in block])
        if held is not None:
            yield crowds_of(held)

    return joined


def crowds(rows: DataFrame, least: int) -> DataFrame:
    """crowd and node: the nodes that the pairs of the prefix join connect at one shingle."""
    dealt = rows.repartition("shingle", "cell").sortWithinPartitions("shingle", "cell")
    return dealt.mapInArrow(_candidates(least), "crowd long, node long").distinct()


def _spanned(least: int):
    """Stream rows ordered by crowd; a crowd at a batch's end waits for the next batch."""

    def near(n: np.ndarray, parts: np.ndarray, signatures: list[np.ndarray]) -> Callable[[int, np.ndarray], np.ndarray]:
        levels = {}
        for level in np.unique(parts).tolist():
            held = np.flatnonzero(parts >= level)
            levels[level] = np.searchsorted(held, np.arange(len(parts))), np.stack([_folded(signatures[i], level) for i in held])

        def close(one: int, rest: np.ndarray) -> np.ndarray:
            m, mine = n[rest], n[one]
            kept = 100 * np.minimum(m, mine) >= least * np.maximum(m, mine)
            most = m + mine - 2 * needed(m, mine, least)
            shared = np.minimum(parts[rest], parts[one])
            for level in np.unique(shared[kept]).tolist():
                place, folded = levels[level]
                asked, step = np.flatnonzero(kept & (shared == level)), max((1 << 22) // level, 1)
                for low in range(0, len(asked), step):
                    some = asked[low : low + step]
                    kept[some] = _apart(folded[place[rest[some]]], folded[place[one]]) <= most[some]
            return kept

        return close

    def edges_of(rows: pa.Table) -> pa.RecordBatch:
        crowd, node, n = (rows[x].to_numpy() for x in ("crowd", "node", "n"))
        data, borders = codes.text_bytes(rows["signature"])
        parts = np.diff(borders)
        first = np.append(np.flatnonzero(np.append(True, crowd[1:] != crowd[:-1])), len(crowd))
        size = np.diff(first)
        found: set[tuple[int, int]] = set()
        two = first[:-1][size == 2]
        m, k = n[two], n[two + 1]
        most = m + k - 2 * needed(m, k, least)
        kept = 100 * np.minimum(m, k) >= least * np.maximum(m, k)
        for one, limit in zip(two[kept].tolist(), most[kept].tolist(), strict=True):
            pair = [data[borders[i] : borders[i + 1]] for i in (one, one + 1)]
            shared = min(map(len, pair))
            if _apart(*(_folded(x, shared) for x in pair)) <= limit:
                found.add((int(node[one]), int(node[one + 1])))
        for group in np.flatnonzero(size > 2):
            own = np.arange(first[group], first[group + 1])
            signatures = [data[borders[i] : borders[i + 1]] for i in own]
            for edges in _trees(np.arange(len(own)), near(n[own], parts[own], signatures)):
                found.update((int(node[own[a]]), int(node[own[b]])) for a, b in edges)
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            crowd = rows["crowd"].to_numpy()
            cut = int(np.argmax(crowd == crowd[-1]))
            held = rows.slice(cut)
            if cut:
                yield edges_of(rows.slice(0, cut))
        if held is not None:
            yield edges_of(held)

    return spanned


def candidate_edges(found: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Edges (a, b) that span the pairs of each crowd (crowd, node) that the signatures of ``sets`` (node, n, signature) allow."""
    signed = found.join(sets.dropDuplicates(["node"]), "node").select("crowd", "node", "n", "signature")
    dealt = signed.repartition("crowd").sortWithinPartitions("crowd")
    return dealt.mapInArrow(_spanned(least), "a long, b long").distinct()


def family_sets(documents: DataFrame, members: DataFrame, words: int, shared: Broadcast) -> DataFrame:
    """family, blocks, node and rare-first shingles of every node of ``members`` (row, family, blocks)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, values, edges in _shingled(batch, words):
                ranked, _ = _ranked(values, edges, shared.value)
                packed = [ranked[edges[i] : edges[i + 1]].tobytes() for i in range(stop - start)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("family").slice(start, stop - start),
                        batch.column("blocks").slice(start, stop - start),
                        pa.array(_nodes(values, edges)),
                        pa.array(packed, pa.binary()),
                    ],
                    ["family", "blocks", "node", "shingles"],
                )

    chosen = members.select("row", "family", "blocks")
    texts = documents.select("row", "text").join(chosen, "row").select("family", "blocks", "text")
    return texts.mapInArrow(made, "family long, blocks long, node long, shingles binary")


def _links(least: int):
    def find(parent: list[int], x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def linked(key: tuple, rows: pa.Table) -> pa.Table:
        node, part = rows["node"].to_pylist(), rows["own"].to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
        order = sorted(range(len(node)), key=lambda i: (len(sets[i]), node[i]))
        order = [i for place, i in enumerate(order) if not place or node[i] != node[order[place - 1]]]
        node, part, sets = [node[i] for i in order], np.array([part[i] for i in order]), [sets[i] for i in order]
        across = key[1].as_py() != key[2].as_py()
        n = np.array([len(x) for x in sets], np.int64)
        ordered = [np.sort(x) for x in sets]
        sketch = _sketches(np.concatenate(ordered), np.concatenate([[0], np.cumsum(n)]))
        width = prefix_sizes(n, least)
        parent = list(range(len(node)))
        index: dict[int, list[tuple[int, int]]] = {}
        found = []
        for one in range(len(node)):
            shared: dict[int, tuple[int, int]] = {}  # ranks of the first shingle two prefixes share
            for rank, shingle in enumerate(sets[one][: width[one]].tolist()):
                held = index.setdefault(shingle, [])
                for other, place in held:
                    if other not in shared:
                        shared[other] = (rank, place)
                held.append((one, rank))
            if not shared:
                continue
            rest = np.fromiter(shared, np.int64, len(shared))
            ranks = np.array(list(shared.values()), np.int64)
            want = needed(n[rest], n[one], least)
            kept = 100 * n[rest] >= least * n[one]
            kept &= np.minimum(n[one] - ranks[:, 0], n[rest] - ranks[:, 1]) >= want
            kept &= np.bitwise_count(sketch[rest] ^ sketch[one]).sum(1) <= n[rest] + n[one] - 2 * want
            if across:
                kept &= part[rest] != part[one]
            for other in rest[kept].tolist():
                root, target = find(parent, one), find(parent, other)
                if root == target:
                    continue
                place = np.minimum(np.searchsorted(ordered[one], ordered[other]), n[one] - 1)
                same = int((ordered[one][place] == ordered[other]).sum())
                if 100 * same >= least * (n[one] + n[other] - same):
                    parent[max(root, target)] = min(root, target)
                    found.append((node[one], node[other]))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return linked


def verified_links(sets: DataFrame, least: int) -> DataFrame:
    """Links (a, b) that connect exactly the nodes that similar pairs connect.

    The sets of a family part into its blocks by hash; each pair of blocks is dealt as its own group.
    """
    dealt = sets.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select(
        "family", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "shingles"
    )
    cells = dealt.repartition("family", "low", "high")
    return cells.groupBy("family", "low", "high").applyInArrow(_links(least), "a long, b long")


def row_components(rows: DataFrame, words: int, least: int) -> DataFrame:
    """row, doc_id, n, component_id and first_row of every row of ``rows`` (row, doc_id, text; a stored table, rows told apart by row).

    The first row of a component is that of the smallest id, ids that are null last, then of the smallest row.
    """
    surveyed = stored(survey(rows, words), "sets")
    nodes = surveyed.where("block is null").select("row", "doc_id", "node", "n")
    counts = bucket_counts(surveyed)
    narrow = next(x for x in (np.uint8, np.uint16, np.uint32, np.uint64) if counts.max() <= np.iinfo(x).max)
    shared = rows.sparkSession.sparkContext.broadcast(counts.astype(narrow))
    found = stored(crowds(prefixes(rows, words, least, shared, int(np.median(counts))), least), "crowds")
    signed = surveyed.where("n > 0").select("node", "n", "signature")
    edges = stored(candidate_edges(found, signed, least), "candidates")
    families = components(edges).select("node", F.col("root").alias("family"))
    first = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "row")
    named = nodes.where("n > 0").groupBy("node").agg(F.min(first).alias("first"))
    sizes = families.groupBy("family").agg(F.ceil(F.count("*") / F.lit(BLOCK_NODES)).alias("blocks"))
    members = named.select("node", "first.row").join(families, "node").join(sizes, "family")
    sets = stored(family_sets(rows, members, words, shared), "family")
    shared.destroy()  # both tables made with it are written
    links = stored(verified_links(sets, least), "links")
    roots = components(links)
    # rows of one node first become one, so a group of copies is no group of rows
    placed = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("of_all"))
    of_node = placed.select("node", "root").join(smallest, "root").select("node", "of_all")
    filled = F.col("n") > 0
    return nodes.join(of_node, "node", "left").select(
        "row",
        "doc_id",
        "n",
        F.when(filled, F.col("of_all.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(filled, F.col("of_all.row")).otherwise(F.col("row")).alias("first_row"),
    )


def jaccard_components(documents: DataFrame, words: int, least: int) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``documents``."""
    rows = stored(documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "documents")
    return row_components(rows, words, least).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def first_of_each(documents: DataFrame, words: int = 5, least: int = 80) -> DataFrame:
    """``documents`` with one row of each component, that of the smallest id; rows without words stay."""
    rows = stored(documents.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("record")), "documents")
    found = row_components(rows.select("row", "record.doc_id", "record.text"), words, least)
    later = found.where("row <> first_row").select("row")
    return rows.join(later, "row", "left_anti").select("record.*")
