"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from barloom.llm.work import stored


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges as a stored table, and their number and hash, taken while they are written."""
    seen = Observation()
    now = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40)).alias("h")), "edges")
    return now, (seen.get["n"], seen.get["h"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """node and root (smallest node of its component) of every node of ``edges`` (a, b: long).

    Each round sends, from every node, its larger neighbours and then its smaller ones to
    the smallest node it knows; rounds grow with the logarithm of the longest chain. Every
    round is a written table, so lost executors cost one round at most. Nodes without an
    edge to another node do not appear. Should a repeated task be counted twice, the rounds
    end one later.
    """
    now, state = _kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # the many edges of a hub that become one do so before they are shuffled
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        before = state
        now, state = _kept(small)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
