import math
import random

import numpy as np
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from barloom.llm import queries, top_k


def expected(rows, k):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for i, q in whole:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in whole if j != i and len(v) == len(q))[:k]
            found += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores, 1)]
    return sorted(found)


def got(spark, rows, k=5):
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    return sorted(tuple(r) for r in top_k.top_k(frame, F.col("vec_id") % 50 == 0, k).collect())


@pytest.mark.parametrize("block", [4096, 40])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 3)
    monkeypatch.setattr(top_k, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(top_k, "STEP", 8)
    rng = random.Random(block)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [rng.gauss(c, 0.2) / 4 for c in rng.choice(centres)]) for i in range(300)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(20)]  # ties
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert got(spark, rows) == expected(rows, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [0.5, -0.5]), (1, None), (2, []), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0])]
    rows += [(6, [0.25, 0.25]), (7, [0.25, 0.25]), (100, [1.0, 1.0, 1.0]), (None, [9.0, 9.0]), (8, [-inf, 0.0])]
    assert got(spark, rows) == expected(rows, 5)
    # repeated rows are candidates each, and a repeated query still has k answers
    assert got(spark, [(0, [1.0]), (0, [1.0]), (3, [2.0]), (3, [2.0])], 2) == [(0, 1, 3, 131072), (0, 2, 3, 131072)]
    assert got(spark, []) == []
    with pytest.raises(Exception, match="beyond"):
        got(spark, [(0, [1e30]), (1, [1.0])])


def test_sql(spark, folder):
    frame = queries.QUERIES["op3_exact_top_k"](spark, folder)
    assert not differences(frame, connect(folder).sql(queries.SQL["op3_exact_top_k"]))
