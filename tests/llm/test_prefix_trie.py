import hashlib
import random
import zlib
from collections import defaultdict

import pytest

import oracle
from barloom.llm import prefix_trie, queries

ROWS = "conv_id long, turn long, role string, text string, n_convs long, depth string"


def rows_frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], ROWS)


def ordered(rows):
    """Conversations as lists of (role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [x[2:] for x in sorted(turns)] for conv, turns in own.items()}


def naive(conversations):
    """Every node by walking all of it."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    saved, leaves, found = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * (len(path[-1][1].encode()) if path else 0)
        saved[path] = own + sum(saved[x] for x in children[path])
        leaves[path] = sum(leaves[x] for x in children[path]) or 1
        digest = hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()
        above = min(members[path[:-1]]) if path else None
        found.append((min(members[path]), len(path), above, len(members[path]), len(children[path]), leaves[path], saved[path], digest))
    return sorted(found, key=lambda x: (x[1], x[0]))


def nodes(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda x: (x[1], x[0]))


def branching(rng, count):
    """Conversations that branch off each other at any turn, copies and beginnings of others among them."""
    known = [[]]
    rows = []
    for conv in rng.sample(range(-50, 5000), count):
        turns = list(rng.choice(known))
        turns = turns[: rng.randint(0, len(turns))] if rng.random() < 0.6 else turns
        if not turns or rng.random() < 0.7:
            turns = turns + [(rng.choice(["user", "assistant"]), rng.choice(["ä", "b", "cc", ""])) for _ in range(rng.randint(1, 7))]
        known.append(turns)
        rows += [(conv, 3 * i - 2, *turn) for i, turn in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_turns,seed", [(1, 1), (3, 2), (4, 3), (64, 4)])
def test_nodes_against_walking(spark, block_turns, seed):
    rows = branching(random.Random(seed), 150)
    more = [(9000 + i, None, None, None) for i in range(3)]
    ids = spark.createDataFrame([(i,) for i in [*(r[0] for r in rows), *(r[0] for r in more), None]], "conv_id long")
    found = prefix_trie.prefix_trie(rows_frame(spark, rows), ids, block_turns)
    assert nodes(found) == naive(ordered(rows) | {r[0]: [] for r in more})


def test_one_long_conversation_among_copies(spark, monkeypatch):
    """A conversation in many parts, with spans of few blocks, and thousands of copies of another."""
    long = [(5, i, "user", f"t{i % 7}") for i in range(3000)] + [(8, i, "user", f"t{i % 7}") for i in range(1500)]
    copies = [(i, t, "user", "same") for i in range(100, 4100) for t in range(2)]
    whole = prefix_trie.chained_blocks
    monkeypatch.setattr(prefix_trie, "chained_blocks", lambda blocks: whole(blocks, 16))
    found = prefix_trie.prefix_trie(rows_frame(spark, long + copies).repartition(5))
    assert nodes(found) == naive(ordered(long + copies))


def test_rows_of_all_kinds(spark):
    rows = [(1, None, None, None), (1, None, "user", "é"), (1, 0, "user", None), (1, 0, "user", None), (2, None, "", ""), (2, None, "user", "é"), (3, 1, "user", "x" * 200_000), (4, 9, "user", "x" * 200_000), (None, 1, "user", "x"), (-(1 << 62), 1, "user", "é")]
    frame = rows_frame(spark, rows)
    assert nodes(prefix_trie.prefix_trie(frame)) == naive(ordered(rows))
    assert prefix_trie.prefix_trie(frame.limit(0)).count() == 0
    only = prefix_trie.prefix_trie(frame.limit(0), spark.createDataFrame([(4,), (2,)], "conv_id long"))
    assert nodes(only) == naive({4: [], 2: []})


def rebuilt(rows):
    own = ordered(rows)
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: h[c]] + turns[h[c] :] for c, turns in own.items()}


def test_query_against_walking_and_sql(spark, folder, tmp_path):
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    more = [(10_000 + i, t, "user", f"{i} {t}") for i in range(1, 30) for t in range(i % 4 + 1)]
    spark.createDataFrame(given + more, ROWS.split(", n_convs")[0]).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op12_prefix_trie(spark, str(tmp_path))
    assert nodes(found) == naive(rebuilt(given + more))
    connection = oracle.duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert not oracle.differences(found, connection.sql(queries.SQL["op12_prefix_trie"]))
