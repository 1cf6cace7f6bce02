"""Segmentation of Han text against all ways to cut a run."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom.operators import segments as S

SIGNS = "天地玄黃宇宙洪荒"


def all_ways(run, words, unknown):
    """Cheapest cut of a run by trying every one; of equal ones that with the longer words first."""
    best = None
    for count in range(len(run)):
        for borders in combinations(range(1, len(run)), count):
            edges = (0, *borders, len(run))
            parts = [run[a:b] for a, b in zip(edges, edges[1:])]
            if all(p in words or len(p) == 1 for p in parts):
                cost = sum(words.get(p, unknown) for p in parts)
                key = (cost, [-len(p) for p in parts])
                if best is None or key < best[0]:
                    best = (key, parts)
    return best[1]


@pytest.mark.parametrize("seed", range(6))
def test_cheapest_way_against_all_ways(seed):
    rng = random.Random(seed)
    some = ["".join(rng.choices(SIGNS, k=rng.randint(1, 4))) for _ in range(30)]
    words = {w: rng.randint(1, 9) * len(w) for w in some}  # many equal costs
    unknown = max(words.values()) + 1
    trie = S.build_trie(words, unknown)
    runs = ["".join(rng.choices(SIGNS + "丁", k=rng.randint(1, 11))) for _ in range(40)]
    assert S.cut_runs(runs, trie) == [all_ways(r, words, unknown) for r in runs]
    assert S.cut_runs([], trie) == []


def test_trie_holds_its_words_only():
    words = {"天": 1, "天地玄": 2, "地": 3, "地玄": 4, "𠀀𠀁": 5}
    trie = S.build_trie(words, 9)
    text = "天地玄黃𠀀𠀁"
    signs = np.array([ord(c) for c in text])
    costs = trie.word_costs(signs, np.arange(len(text), 0, -1))
    found = {text[i : i + n + 1]: int(c[i]) for n, c in enumerate(costs) for i in range(len(text)) if c[i] < S._NEVER}
    assert found == words | {"玄": 9, "黃": 9, "𠀀": 9, "𠀁": 9}
    assert S.cut_runs(["天天"], S.build_trie({}, 1)) == [["天", "天"]]


@pytest.fixture
def articles(spark):
    rng = random.Random(4)
    words = ["天地", "玄黃宇", "洪", "荒日月", "宙"]
    rows = [(i, "，".join("".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(3)) + " Mixed Ünd text ") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "no signs"), (103, "天"), (104, "天地" * 3000), (107, "天地洪"), (107, "天地洪"), (None, "宙宙 b")]
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, term string").repartition(3)


def test_words_of_a_language_are_learned(spark, articles):
    learned = S.learn_words(articles.where("doc_id < 60"), min_cohesion=1.0, min_entropy=0.7)
    found = {r["word"] for r in learned.collect() if len(r["word"]) > 1}
    assert {"天地", "玄黃宇", "荒日月"} <= found
    assert not found & {"地玄", "黃宇", "玄黃", "荒日", "日月"}  # parts of words, or signs that chance put together
    assert S.learn_words(articles.limit(0)).count() == 0


def test_both_ways_to_look_up_agree(spark, articles, tmp_path):
    S.learn_words(articles.where("doc_id < 60"), min_cohesion=1.0, min_entropy=0.7).write.parquet(f"{tmp_path}/words")
    dictionary = spark.read.parquet(f"{tmp_path}/words").where("word <> '宙'")  # an unknown sign
    one = S.segments(articles, dictionary)
    other = S.segments(articles, dictionary, most_words=3)
    assert one.columns == ["doc_id", "pos", "term"] == other.columns
    rows = sorted(map(tuple, one.collect()), key=str)
    assert rows == sorted(map(tuple, other.collect()), key=str) and len(rows) > 6000
    by = {}
    for i, pos, term in rows:
        by.setdefault(i, []).append((pos, term))
    assert sorted(by[107]) == sorted([(0, "天地"), (1, "洪")] * 2) and sorted(by[None]) == [(0, "宙"), (1, "宙"), (2, "b")]
    assert sorted(by[102]) == [(0, "no"), (1, "signs")] and not by.keys() & {100, 101}
    assert len(by[104]) == 3000 and {t for _, t in by[104]} == {"天地"}


def test_longer_dictionaries_are_joined_not_sent(spark, articles, tmp_path):
    S.learn_words(articles).write.parquet(f"{tmp_path}/words")
    dictionary = spark.read.parquet(f"{tmp_path}/words")
    whole = S.segments(articles, dictionary, most_words=1).where(F.col("doc_id") < 60).groupBy("doc_id").agg(F.count("*").alias("n"))
    assert whole.count() == 60


def test_strings_are_added_up_in_their_task(spark, monkeypatch):
    """A task hands on a distinct string once for all it holds, not for each place; all counts are whole."""
    rng = random.Random(7)
    runs = ["".join(rng.choices("天地𠀀玄", k=rng.choice([1, 2, 3, 5, 9, 700]))) for _ in range(80)]
    expected = Counter()
    for framed in (f"^{run}^" for run in runs):
        expected.update(framed[i : i + n] for i in range(len(framed)) for n in range(1, 6) if i + n <= len(framed))
    rows = [("，".join(runs[i : i + 4]) + " and more",) for i in range(0, len(runs), 4)] + [(None,), ("",), ("no sign",)]
    docs = spark.createDataFrame(rows, "text string").repartition(3)
    found = S.string_counts(docs, 5).collect()
    assert {(r["word"], r["n"], r["count"]) for r in found} == {(w, len(w), c) for w, c in expected.items()}
    assert len(found) == len(expected)

    framed = pa.RecordBatch.from_arrays([pa.array([f"^{run}^\0\0\0\0" for run in runs])], ["framed"])
    for strings, most in ((1 << 20, 1), (300, 200)):
        monkeypatch.setattr(S, "_STRINGS", strings)
        longest = Counter()
        batches = list(S._counted(iter([framed] * 3), 5))
        for batch in batches:
            words = batch.column("word").to_pylist()
            assert len(words) == len(set(words))
            longest.update(dict(zip(words, batch.column("count").to_pylist(), strict=True)))
        assert len(batches) <= most
        assert longest == Counter(f"^{run}^"[i : i + 5] for run in runs * 3 for i in range(len(run) + 2))


def test_rows_are_cut_in_slices(spark, monkeypatch):
    """The signs that a task lays out at once are bounded, whatever the rows of its batch; one row is the least."""
    texts = [["天地" * 5], None, [], ["天", "word", "地玄"], ["天" * 40], ["x"]]
    kind = pa.list_(pa.struct([("piece", pa.string()), ("han", pa.bool_())]))
    pieces = pa.array([t and [{"piece": p, "han": p[0] in SIGNS} for p in t] for t in texts], kind)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pieces], ["doc_id", "pieces"])
    monkeypatch.setattr(S, "_SIGNS", 16)
    slices = list(S._slices(batch))
    assert [x for s in slices for x in s.column("doc_id").to_pylist()] == list(range(len(texts)))
    assert len(slices) > 2
    assert list(S._slices(batch.slice(0, 0))) == []
