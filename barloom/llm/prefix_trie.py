"""The trie of conversations by common first turns, from digests of blocks of turns.

A turn has a 64-bit hash of its place, role and text; the digest of the first d turns is the sum
of their hashes (upper and lower halves each for themselves), so that it is a running sum,
which long conversations take in parts. Turns are gathered into blocks of ``BLOCK_TURNS``, and
conversations are grouped by their successive blocks first: equal blocks after equal digests
become one row with the number of conversations and their sums. Where one digest is followed by
one kind of block only, all turns of the block have the same conversations, and its nodes are
read off it; only where siblings diverge are the blocks taken apart and grouped turn by turn.

What a node tells of its subtree are sums over its conversations, so no walk up or down is
needed, however deep the trie. Each conversation owns the nodes of which it has the smallest
id: a last part of its path. Below a node lie the nodes that its conversations own, and of
its own smallest conversation those from the node on. Let o be the bytes that a conversation owns
and s those of its turns from the node on. Then the sum of (n - 1) x bytes over the subtree is the
sum of s - o over the node's conversations, with s in place of o for the smallest one; leaves are
the leaves owned.

A hot conversation, prefix or group of copies: turns are put in order by range over (conv_id,
turn), so that a long conversation is spread over tasks and chained by its parts' totals;
groups of copies are counted before they are shuffled; the ids that end at one node are joined in
pieces of at most 2^``ID_BITS`` ids and hashed as a stream, as a digest of a list must be.

Defined results: turns are ordered by turn (null first), role and text; a null role or text is
empty; repeated rows are turns of their own; conversations of ``ids`` without rows are members of
the root alone; rows and ids that are null belong to no conversation; an empty table gives no
rows, not even a root. Texts are hashed whole. Only the four columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.work import stored

BLOCK_TURNS = 4
#: ids that differ in their last bits only are joined together, before a node's digest reads them
ID_BITS = 10
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
LOW = (1 << 32) - 1
DIGEST = "struct<high:long,low:long>"


def numbered(rows: DataFrame, kept: Sequence[str | Column], sums: Sequence[str] = ()) -> DataFrame:
    """conv_id, pos (the place of each turn in its conversation) and the columns ``kept``; for each column of ``sums`` (long)
    of these also its total up to the turn (``sum_``) and in the whole conversation (``all_``).

    The rows of a conversation may lie in many parts of the order; the parts are chained by their totals.
    """
    spread = rows.where("conv_id is not null").repartitionByRange("conv_id", F.asc_nulls_first("turn"))
    ordered = spread.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    placed = stored(ordered.select("conv_id", *kept, F.monotonically_increasing_id().alias("_place")), "turns")
    names = [x for x in placed.columns if x != "_place"]
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    parts = placed.groupBy("conv_id", "_part").agg(
        F.min("_place").alias("_first"), F.count("*").alias("_n"), *(F.sum(x).alias(f"_{x}") for x in sums)
    )
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    chained = parts.select(
        "conv_id",
        "_part",
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        *(F.coalesce(F.sum(f"_{x}").over(before), F.lit(0)).alias(f"_before_{x}") for x in sums),
        *(F.sum(f"_{x}").over(whole).alias(f"all_{x}") for x in sums),
    )
    joined = placed.join(chained, ["conv_id", "_part"])
    upto = Window.partitionBy("conv_id", "_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *names,
        (F.col("_place") - F.col("_first") + F.col("_before")).alias("pos"),
        *((F.sum(x).over(upto) + F.col(f"_before_{x}")).alias(f"sum_{x}") for x in sums),
        *(f"all_{x}" for x in sums),
    )


def filled(rows: DataFrame) -> DataFrame:
    """The four columns, with an empty text for a null role or text."""
    return rows.select(F.col("conv_id").cast("long"), "turn", *(F.coalesce(x, F.lit("")).alias(x) for x in ("role", "text")))


def turn_hashes(rows: DataFrame) -> DataFrame:
    """conv_id, pos, halves of the hash of the turn, and the bytes of its text, and of all texts after it."""
    kept = [F.xxhash64("role", "text").alias("said"), F.octet_length("text").cast("long").alias("bytes")]
    own = numbered(filled(rows), kept, ["bytes"]).withColumn("h", F.xxhash64("pos", "said"))
    return own.select(
        "conv_id", "pos", "bytes", (F.col("all_bytes") - F.col("sum_bytes")).alias("bytes_after"), F.shiftright("h", 32).alias("high"), F.col("h").bitwiseAND(F.lit(LOW)).alias("low")
    )


def blocks_of(turns: DataFrame, block_turns: int) -> DataFrame:
    """One row per block of a conversation: its number, turns, hash sums, last place, and bytes after it."""
    return turns.groupBy("conv_id", F.expr(f"pos div {block_turns}").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "high", "low", "bytes"))).alias("turns"),
        F.sum("high").alias("high"),
        F.sum("low").alias("low"),
        F.max("pos").alias("last_pos"),
        F.min("bytes_after").alias("bytes_after"),
    )


def chained_blocks(blocks: DataFrame, span: int = 4096) -> DataFrame:
    """Blocks with the digest at their start, and whether they end their conversation; long ones are summed over spans of blocks."""
    spanned = blocks.withColumn("span", F.expr(f"block div {span}"))
    totals = spanned.groupBy("conv_id", "span").agg(F.sum("high").alias("h"), F.sum("low").alias("l"), F.max("last_pos").alias("m"))
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    chained = totals.select(
        "conv_id",
        "span",
        F.coalesce(F.sum("h").over(earlier), F.lit(0)).alias("h"),
        F.coalesce(F.sum("l").over(earlier), F.lit(0)).alias("l"),
        F.max("m").over(whole).alias("end_pos"),
    )
    inside = Window.partitionBy("conv_id", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.struct(
        (F.coalesce(F.sum("high").over(inside), F.lit(0)) + F.col("h")).alias("high"),
        (F.coalesce(F.sum("low").over(inside), F.lit(0)) + F.col("l")).alias("low"),
    )
    return spanned.join(chained, ["conv_id", "span"]).select(
        "conv_id", "block", start.alias("start"), "turns", "bytes_after", (F.col("last_pos") == F.col("end_pos")).alias("ends")
    )


def digests(start: Column, turns: Column) -> Column:
    """Depth, digest of the node, digest of its parent, bytes of its turn and bytes from it to the block's end, per turn."""

    def further(state: Column, turn: Column) -> Column:
        node = F.struct((state["at"]["high"] + turn["high"]).alias("high"), (state["at"]["low"] + turn["low"]).alias("low"))
        rest = state["rest"] - turn["bytes"]
        one = F.struct((turn["pos"] + 1).alias("depth"), node.alias("node"), state["at"].alias("parent"), turn["bytes"].alias("bytes"), state["rest"].alias("from_here"))
        return F.struct(node.alias("at"), rest.alias("rest"), F.concat(state["nodes"], F.array(one)).alias("nodes"))

    kind = f"array<struct<depth:long,node:{DIGEST},parent:{DIGEST},bytes:long,from_here:long>>"
    whole = F.aggregate(turns, F.lit(0).cast("long"), lambda s, t: s + t["bytes"])
    state = F.struct(start.alias("at"), whole.alias("rest"), F.array().cast(kind).alias("nodes"))
    return F.aggregate(turns, state, further)["nodes"]


def nodes_of(blocks: DataFrame, of_block: dict[str, Column], of_turn: dict[str, tuple[Callable[[Column], Column], Column]]) -> DataFrame:
    """depth and digest (node) of every node, and what is asked for of its conversations.

    ``of_block`` aggregates the equal blocks that follow equal digests; ``of_turn`` tells, from such
    a row and a turn ``t`` of it, a value of the node and how values of one node come together.
    """
    groups = blocks.groupBy("block", "start", "turns").agg(*(value.alias(name) for name, value in of_block.items()))
    kinds = groups.groupBy("block", "start").agg(F.count("*").alias("kinds"), F.min(F.struct(*groups.columns)).alias("only"))
    kinds = stored(kinds, "kinds")
    lone = kinds.where("kinds = 1").select("only.*")
    diverging = groups.join(kinds.where("kinds > 1").select("block", "start"), ["block", "start"], "left_semi")

    def apart(part: DataFrame) -> DataFrame:
        turns = part.withColumn("t", F.explode(digests(F.col("start"), F.col("turns"))))
        return turns.select("t.depth", "t.node", *(value.alias(name) for name, (_, value) in of_turn.items()))

    refined = apart(diverging).groupBy("depth", "node").agg(*(together(F.col(name)).alias(name) for name, (together, _) in of_turn.items()))
    return apart(lone).unionByName(refined)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node from its pieces, which follow each other in order, over all batches."""
    names = ["depth", "node", "ends_sha256"]
    now, running = None, None
    for batch in batches:
        done: list[tuple] = []
        for depth, node, ids in zip(*(batch.column(x).to_pylist() for x in ("depth", "node", "ids")), strict=True):
            key = (depth, node["high"], node["low"])
            if key != now:
                if now is not None:
                    done.append((*now, running.hexdigest()))
                now, running = key, hashlib.sha256()
            else:
                running.update(b",")
            running.update(ids.encode())
        if done:
            yield _rows(done, names)
    if now is not None:
        yield _rows([(*now, running.hexdigest())], names)


def _rows(done: list[tuple], names: list[str]) -> pa.RecordBatch:
    depth, high, low, digest = (list(x) for x in zip(*done, strict=True))
    node = pa.StructArray.from_arrays([pa.array(high, pa.int64()), pa.array(low, pa.int64())], ["high", "low"])
    return pa.RecordBatch.from_arrays([pa.array(depth, pa.int64()), node, pa.array(digest, pa.string())], names)


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, ascending and joined by commas; from depth, node, conv_id."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = ends.groupBy("depth", "node", F.shiftright("conv_id", ID_BITS).alias("piece")).agg(ids.alias("ids"))
    ordered = pieces.repartition("depth", "node").sortWithinPartitions("depth", "node", "piece")
    return ordered.select("depth", "node", "ids").mapInArrow(_hashed, f"depth long, node {DIGEST}, ends_sha256 string")


def prefix_trie(rows: DataFrame, ids: DataFrame | None = None, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """All nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rows``: conv_id, turn, role, text; ``ids``: conv_id of further conversations, which may have no rows.
    """
    blocks = stored(chained_blocks(blocks_of(turn_hashes(rows), block_turns)), "blocks")
    members = blocks.where("block = 0").select("conv_id")
    if ids is not None:
        members = members.unionByName(ids.select(F.col("conv_id").cast("long")).where("conv_id is not null")).distinct()
    members = stored(members, "members")

    # nodes with their conversations; of the smallest one the bytes from the node on
    n, after, here = F.col("n"), F.col("bytes_after"), F.col("t.from_here")
    least = F.struct(F.col("least.conv_id"), (F.col("least.bytes_after") + here).alias("rest"))
    nodes = nodes_of(
        blocks,
        {"n": F.count("*"), "bytes_after": F.sum("bytes_after"), "least": F.min(F.struct("conv_id", "bytes_after"))},
        {
            "parent": (F.first, F.col("t.parent")),
            "bytes": (F.first, F.col("t.bytes")),
            "least": (F.min, least),
            "n_convs": (F.sum, n),
            "below": (F.sum, after + n * here),
        },
    )
    nodes = stored(nodes.select("depth", "node", "parent", "bytes", "least.*", "n_convs", "below"), "nodes")
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, ["depth", "node"], "left").na.fill(0, ["n_children"]), "nodes")

    # what each conversation owns, summed over the conversations of each node
    owned = nodes.groupBy("conv_id").agg(F.sum("bytes").alias("owned"), F.count_if(F.col("n_children") == 0).alias("leaves"))
    below = nodes_of(
        blocks.join(owned, "conv_id"),
        {"owned": F.sum("owned"), "leaves": F.sum("leaves"), "least": F.min(F.struct("conv_id", "owned"))},
        {"owned": (F.sum, F.col("owned")), "leaves": (F.sum, F.col("leaves")), "least": (F.min, F.col("least"))},
    ).select("depth", "node", "owned", F.col("leaves").alias("n_leaves"), F.col("least.owned").alias("own"))
    saved = F.col("below") - (F.col("owned") - F.col("own") + F.col("rest"))
    whole = nodes.join(below, ["depth", "node"]).withColumn("saved_tokens", saved)

    zero = F.struct(F.lit(0).cast("long").alias("high"), F.lit(0).cast("long").alias("low"))
    no = F.lit(0).cast("long")
    counted = members.select("conv_id", F.lit(1).alias("n"), no.alias("heads"), no.alias("leaves"), no.alias("saved")).unionByName(
        nodes.select(
            F.lit(None).cast("long").alias("conv_id"),
            F.lit(0).alias("n"),
            (F.col("depth") == 1).cast("long").alias("heads"),
            (F.col("n_children") == 0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        )
    )
    root = counted.agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("heads").alias("n_children"), F.greatest(F.sum("leaves"), F.lit(1)).alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    ).where("n_convs > 0")
    root = stored(root, "root")
    first = root.first()
    names = ["conv_id", "depth", "node", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    root = root.withColumns({"depth": no, "node": zero, "parent_conv_id": F.lit(None).cast("long")}).select(*names)
    heads = whole.where("depth = 1").withColumn("parent_conv_id", F.lit(first and first["conv_id"]).cast("long")).select(*names)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    deeper = whole.where("depth > 1").join(parents, ["depth", "parent"]).select(*names)

    at = F.element_at(digests(F.col("start"), F.col("turns")), -1)
    last = blocks.where("ends").withColumn("t", at).select("conv_id", "t.depth", "t.node")
    turnless = members.join(last, "conv_id", "left_anti").select("conv_id", no.alias("depth"), zero.alias("node"))
    ends = end_digests(last.unionByName(turnless))
    found = root.unionByName(heads).unionByName(deeper).join(ends, ["depth", "node"], "left")
    return found.select(*(x for x in names if x != "node"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
