"""Exact top-k inner products by pivot-table elimination.

Vectors are scaled to whole numbers, floor(scale * x). ``PIVOTS`` vectors, picked far apart
from a bounded sample, serve as pivots, and a table holds every vector's distance to each.
For query q and candidate x the triangle inequality gives d(q, x) >= max |d(q, p) - d(x, p)|,
the largest of many lower bounds, and with it an upper bound of the inner product,
(|q|^2 + |x|^2 - d(q, x)^2) / 2. Candidates are evaluated in the order of their bounds until
the next bound is under the k-th best score: no candidate left out can be among the best.

Queries and candidates are dealt to blocks of bounded size, and each pair of blocks is one
group, so no side is broadcast and no task holds more than two blocks. Every group returns k
rows per query at most, and the best of those are the result.

Vectors that are null or empty or hold null or non-finite components take no part. Only
vectors of the same length are compared. Scores are 64-bit whole numbers; scaled components
beyond 2^31 are refused. Equal scores go to the smaller id. Rows without an id take no part;
of repeated rows each is a candidate, and a query is never compared with rows of its own id.
An empty table gives no rows. Only the id and the vector are read, further columns of any name are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.work import smallest_by_hash

PIVOTS = 24
PIVOT_SAMPLE = 1024
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096
STEP = 64
LARGEST = 1 << 31


def scaled(vectors: DataFrame, scale: int, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """key and whole components of the vectors that take part."""
    value = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    usable = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.col(key).isNotNull()
    usable &= F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    fits = F.forall("v", lambda x: F.abs(x) < LARGEST)
    whole = vectors.where(usable).select(F.col(key).alias("vec_id"), value.alias("v"))
    return whole.withColumn("v", F.when(fits, F.col("v")).otherwise(F.raise_error(F.lit("a scaled component beyond 2^31")).cast("array<bigint>")))


def pivots(vectors: DataFrame) -> list[np.ndarray]:
    """Vectors far apart among a bounded sample: each next one is the farthest from those chosen."""
    rows = smallest_by_hash(vectors, "vec_id", PIVOT_SAMPLE).select("v").collect()
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(len(row["v"]), []).append(row["v"])
    chosen = []
    for length in sorted(by_length):
        sample = np.array(by_length[length], np.float64)
        gap = np.full(len(sample), np.inf)
        next_one = 0
        for _ in range(min(PIVOTS, len(sample))):
            chosen.append(sample[next_one])
            gap = np.minimum(gap, np.linalg.norm(sample - sample[next_one], axis=1))
            next_one = int(gap.argmax())
            if not gap[next_one]:
                break
    return chosen


def _matrix(column: pa.ChunkedArray, length: int) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def best_of_block(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, table: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """(query id, id, score) of the k best candidates of each query; ``table`` holds the pivots."""
    real = rows.astype(np.float64)
    asked = queries.astype(np.float64)
    # floating sums of products are whole and exact below 2^53
    largest = np.abs(real).max(initial=0) * np.abs(asked).max(initial=0) * rows.shape[1]
    left, right = (real, asked) if largest < 2**53 else (rows.astype(np.int64), queries.astype(np.int64))

    def distances(points: np.ndarray) -> np.ndarray:
        if not len(table):
            return np.zeros((len(points), 1))
        return np.stack([np.linalg.norm(points - pivot, axis=1) for pivot in table], 1)

    far, near = distances(real), distances(asked)
    power = (real**2).sum(1)
    found = []
    for one in range(len(queries)):
        apart = np.abs(far - near[one]).max(1)
        own = (asked[one] ** 2).sum()
        bound = (own + power - apart**2) / 2
        bound += 1e-9 * (own + power) + 1  # rounding of the distances
        order = np.argsort(-bound, kind="stable")
        order = order[ids[order] != query_ids[one]]
        best: list[tuple[int, int]] = []
        low, step = 0, STEP
        while low < len(order) and not (len(best) == k and bound[order[low]] < -best[-1][0]):
            part = order[low : low + step]
            scores = (left[part] @ right[one]).astype(np.int64)
            if len(best) == k:
                hopeful = scores >= -best[-1][0]
                part, scores = part[hopeful], scores[hopeful]
            best = sorted([*best, *zip((-scores).tolist(), ids[part].tolist(), strict=True)])[:k]
            low, step = low + step, step * 2
        found += [(int(query_ids[one]), number, -score) for score, number in best]
    return found


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id and score of the k best other rows of every row that ``is_query`` marks."""
    whole = scaled(vectors, scale, vector, key).withColumn("length", F.size("v"))
    asked = whole.where(is_query)
    query_blocks = whole.where(is_query).count() // QUERY_BLOCK + 1
    blocks = whole.count() // CANDIDATE_BLOCK + 1
    table = vectors.sparkSession.sparkContext.broadcast(pivots(whole))

    def dealt(frame: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        place = F.pmod(F.xxhash64("vec_id", "v"), F.lit(own_blocks))
        return frame.withColumn(own, place).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_blocks - 1).cast("long"))))

    def searched(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        length = key[0].as_py()
        rows = []
        if left.num_rows and right.num_rows:
            chosen = np.array([x for x in table.value if len(x) == length])
            rows = best_of_block(
                _matrix(left["v"], length),
                left["vec_id"].to_numpy(),
                _matrix(right["v"], length),
                right["vec_id"].to_numpy(),
                chosen,
                k,
            )
        kinds = pa.int64()
        return pa.table({n: pa.array([r[i] for r in rows], kinds) for i, n in enumerate(("query_id", "vec_id", "score"))})

    keys = ("length", "q_block", "c_block")
    left = dealt(asked, "q_block", query_blocks, "c_block", blocks).select("vec_id", "v", *keys).groupBy(*keys)
    right = dealt(whole, "c_block", blocks, "q_block", query_blocks).select("vec_id", "v", *keys).groupBy(*keys)
    near = left.cogroup(right).applyInArrow(searched, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
