import random
import re
import string

import pytest

from barloom.llm import near_jaccard
from barloom.llm.components import components
from barloom.llm.work import stored

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected(rows, size, least):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(words[k : k + size]) for k in range(max(len(words) - size + 1, 1))} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * same >= least * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    found = []
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if find(b) == find(a) and rows[b][0] is not None]
        found.append((i, len(sets[a]), min(ids) if sets[a] and ids else i))
    return sorted(found, key=str)


def got(frame, size=4, least=85):
    return sorted((tuple(r) for r in near_jaccard.jaccard_components(frame, size, least).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(string.ascii_letters) for _ in range(5)) for _ in range(3000)]
    passage = rng.choices(vocabulary, k=50)
    base = rng.choices(vocabulary, k=160)
    rows = []
    for i in range(120):
        kind = rng.random()
        if kind < 0.5:  # near copies with more and less change
            words = list(base)
            for _ in range(rng.randint(0, 7)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind < 0.7:
            words = rng.choices(vocabulary, k=rng.randint(0, 60)) + passage
        elif kind < 0.8 and rows:
            words = rng.choice(rows)[1].upper().split()
        else:
            words = rng.choices(vocabulary, k=rng.randint(0, 80))
        rows.append((rng.randint(0, 10**9), " ".join(words)))
    return rows


@pytest.mark.parametrize("hot, block, size, least", [(4096, 512, 4, 85), (3, 8, 5, 80)])
def test_against_brute_force(frame, monkeypatch, hot, block, size, least):
    monkeypatch.setattr(near_jaccard, "HOT", hot)
    monkeypatch.setattr(near_jaccard, "BLOCK_NODES", block)
    rows = corpus(size)
    assert got(frame(rows), size, least) == expected(rows, size, least)


def test_odd_rows(frame, odd_rows):
    rows = [*odd_rows, (20, "A b  c"), (21, "a\nB c"), (22, "a b"), (23, "a b"), (24, "A"), (25, "no id at all")]
    assert got(frame(rows)) == expected(rows, 4, 85)
    assert got(frame([])) == []


def test_first_of_each_keeps_columns(frame):
    text = " ".join(f"w{i}" for i in range(60))
    whole = frame([(3, text), (7, text + " more"), (9, "another text"), (None, text), (2, None)])
    kept = near_jaccard.first_of_each(whole)
    assert kept.columns == whole.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "9"]


def test_rows_of_repeated_and_null_ids(frame):
    """One row of each component stays, whatever its id; nothing else goes with it."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, a), (2, a + " more"), (2, b), (None, c), (None, c + " more"), (None, c), (None, "d e f g"), (None, None), (None, None), (5, "")]
    kept = sorted(((r["doc_id"], r["text"]) for r in near_jaccard.first_of_each(frame(rows)).collect()), key=str)
    assert (1, a) in kept and (2, b) in kept and kept.count((1, a)) == 1 and kept.count((None, None)) == 2
    assert sum(t is not None and t.startswith("c0") for _, t in kept) == 1 and len(kept) == 7


def test_links_through_rows_without_an_id(frame):
    words = [f"w{i}" for i in range(200)]
    near = [*words[:100], *(f"x{i}" for i in range(4)), *words[104:]]
    far = [*near[:20], *(f"y{i}" for i in range(4)), *near[24:]]
    rows = [(8, " ".join(words)), (None, " ".join(near)), (9, " ".join(far)), (10, "other text of some words")]
    assert got(frame(rows), 5, 90) == expected(rows, 5, 90)
    assert {r[2] for r in expected(rows, 5, 90)} == {8, 10} and {r[2] for r in expected([rows[0], rows[2]], 5, 90)} == {8, 9}


def test_prefix_and_overlap_bounds():
    import numpy as np

    for least in (80, 85):
        n = np.arange(1, 300)
        for m in range(1, 300, 7):
            exact = [next(i for i in range(a + m + 1) if 100 * i >= least * (a + m - i)) for a in n.tolist()]
            assert near_jaccard.needed(n, np.int64(m), least).tolist() == exact
        assert near_jaccard.prefix_sizes(n, least).tolist() == [a - -(-a * least // 100) + 1 for a in n.tolist()]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7), (201, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[100 + i] == 100 for i in range(30))
    assert found[201] == found[200] == 200 and len(found) == 73
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_texts_that_share_a_part_are_no_family(frame, monkeypatch):
    """A chain of long texts, each sharing a third of its shingles with the next: only those that are alike bring their sets."""
    rng = random.Random(3)
    parts = [[f"p{i}w{rng.randrange(10**6)}" for _ in range(750)] for i in range(31)]
    rows = [(i, " ".join(parts[i] + parts[i + 1])) for i in range(30)]
    rows += [(100 + i, " ".join([*parts[i], *parts[i + 1][:-40], *(f"x{i}y{k}" for k in range(40))])) for i in (4, 17)]
    held = {}
    monkeypatch.setattr(near_jaccard, "stored", lambda made, name: held.setdefault(name, stored(made, name)))
    assert got(frame(rows), 5, 80) == expected(rows, 5, 80)
    assert held["family"].count() == 4 and held["links"].count() == 2


def test_signatures_are_never_further_apart_than_their_sets():
    import numpy as np

    rng = np.random.default_rng(5)
    sizes = [0, 1, 63, 65, 700, 900, 5000, 6000]
    pool = rng.integers(0, 1 << 64, 6000, np.uint64)
    sets = [np.unique(np.concatenate([pool[: n // 2], rng.integers(0, 1 << 64, n - n // 2, np.uint64)])) for n in sizes]
    data, borders = near_jaccard._signatures(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]))
    signatures = [data[borders[i] : borders[i + 1]] for i in range(len(sets))]
    assert [len(x) for x in signatures] == [0, 8, 8, 16, 128, 128, 1024, 1024]
    for a in range(1, len(sets)):
        for b in range(1, len(sets)):
            parts = min(len(signatures[a]), len(signatures[b]))
            apart = int(near_jaccard._apart(*(near_jaccard._folded(signatures[x], parts) for x in (a, b))))
            assert apart <= len(np.setxor1d(sets[a], sets[b])) and (a != b or apart == 0)
            if a != b and parts > 16:  # half of the texts alike: well beyond what a similarity of 0.8 allows
                n, m = len(sets[a]), len(sets[b])
                assert apart > n + m - 2 * near_jaccard.needed(np.int64(n), np.int64(m), 80)


def test_crowds_of_many_sizes(frame):
    """A crowd of sets whose signatures have unlike numbers of parts, cut anywhere between batches."""
    rng = random.Random(8)
    base = [f"b{rng.randrange(10**7)}" for _ in range(1400)]
    rows = [(k, " ".join([*base[: 1400 - 23 * k], *(f"u{k}v{j}" for j in range(rng.randrange(60)))])) for k in range(40)]
    frame(rows).sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert got(frame(rows), 5, 80) == expected(rows, 5, 80)
    finally:
        frame(rows).sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
