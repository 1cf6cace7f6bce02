"""Best-fit packing of documents into sequences of several permitted lengths.

Documents longer than the largest capacity are cut into pieces of that capacity and a rest.
Pieces are spread by hash over shards of about ``SHARD_TOKENS`` tokens, with their row number
in a stored table, so that rows of one id or of none are spread too; each shard is packed by
best fit in decreasing length: a piece goes to the open bin with the least room that
holds it, and if none does, the least-cost bin size the plan allows is opened. The
permitted lengths are optimised jointly: a shard is packed under every plan (each smallest
size at which bins may be opened), every bin is then downsized to the smallest capacity that
holds its content, and the plan of least total cost wins. A bin costs its capacity and
``BIN_COST``.

Lengths count words and one end mark. A null or empty text has length 1, its end mark.
Repeated rows are packed each for itself; ties go by length, id as text, and piece. An empty table
gives no rows. Only doc_id and text of the input are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.work import stored

CAPACITIES = (256, 512, 1024, 2048, 4096)
BIN_COST = 16
SHARD_TOKENS = 4_000_000
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long") + 1


def pieces(documents: DataFrame, capacity: int) -> DataFrame:
    """doc_id as text, piece, start and length of every piece, at most ``capacity`` tokens each."""
    lengths = documents.select(F.col("doc_id").cast("string").alias("doc_id"), token_count(F.col("text")).alias("tokens"))
    parts = F.sequence(F.lit(0).cast("long"), F.col("tokens") - 1, F.lit(capacity).cast("long"))
    cut = lengths.select("doc_id", "tokens", F.posexplode(parts).alias("piece", "start"))
    return cut.select(
        "doc_id", "piece", "start", F.least(F.lit(capacity), F.col("tokens") - F.col("start")).alias("length")
    )


def downsized(filled: np.ndarray, capacities: Sequence[int]) -> np.ndarray:
    """The smallest permitted capacity that holds each content."""
    sizes = np.asarray(sorted(capacities))
    return sizes[np.searchsorted(sizes, filled)]


def best_fit(lengths: Sequence[int], capacities: Sequence[int], smallest: int) -> np.ndarray:
    """Bin of each length, given in decreasing order; new bins hold ``smallest`` at least."""
    sizes = sorted(capacities)
    rooms: list[int] = []
    waiting: dict[int, list[int]] = {}
    chosen = np.zeros(len(lengths), np.int64)
    bins = 0
    for item, length in enumerate(lengths):
        place = bisect_left(rooms, length)
        if place < len(rooms):
            room = rooms[place]
            bin_id = waiting[room].pop()
            if not waiting[room]:
                del waiting[room]
                rooms.pop(place)
        else:
            room = sizes[bisect_left(sizes, max(length, smallest))]
            bin_id = bins
            bins += 1
        chosen[item] = bin_id
        room -= length
        if room in waiting:
            waiting[room].append(bin_id)
        elif room:
            waiting[room] = [bin_id]
            insort(rooms, room)
    return chosen


def pack(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, bin_cost: int = BIN_COST) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each length (decreasing order) and the capacity of each bin, by the cheapest plan."""
    best = None
    for smallest in sorted(capacities, reverse=True):
        chosen = best_fit(lengths, capacities, smallest)
        filled = np.bincount(chosen, np.asarray(lengths, np.float64)).astype(np.int64)
        sizes = downsized(filled, capacities)
        cost = int(sizes.sum()) + bin_cost * len(sizes)
        if best is None or cost < best[0]:
            best = (cost, chosen, sizes)
    return best[1], best[2]


def best_fit_packing(
    documents: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    bin_cost: int = BIN_COST,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin_id, bin_capacity, bin_start."""
    cut = stored(pieces(documents, max(capacities)).withColumn("row", F.monotonically_increasing_id()), "pieces")
    total = cut.agg(F.sum("length")).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True]).reset_index(drop=True)
        chosen, sizes = pack(group["length"].tolist(), capacities, bin_cost)
        before = group["length"].groupby(chosen).cumsum() - group["length"]
        return group.assign(
            bin_id=group["shard"].astype("int64") * (1 << 32) + chosen, bin_capacity=sizes[chosen], bin_start=before
        ).drop(columns="shard")

    kind = dict(documents.dtypes)["doc_id"]
    spread = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(shards))).drop("row")
    found = spread.groupBy("shard").applyInPandas(
        packed,
        "doc_id string, piece int, start long, length long, bin_id long, bin_capacity long, bin_start long",
    )
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
