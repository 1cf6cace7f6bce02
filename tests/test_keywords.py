"""Pages of the keyword index against a search through all texts."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom.operators import keywords, terms


@pytest.fixture(scope="module")
def articles(spark):
    rng = random.Random(11)
    rows = [(i, "".join(rng.choices("ab cß日\U0001f600", k=rng.randint(0, 60))), "s") for i in rng.sample(range(10_000), 700)]
    rows += [(20_000, None, "s"), (20_001, "", "s"), (20_002, "a", "s"), (20_003, "ab" * 40_000, "s"), (20_004, "\0a\0b", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


@pytest.fixture(scope="module")
def index(spark, articles, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("keywords"))
    keywords.build(articles, f"{folder}/index", part_rows=60)
    return f"{folder}/index"


WORDS = ["a", "日\U0001f600", "abc", "abab", "ababababa", "abz", "\0a"]


@pytest.mark.parametrize("word", WORDS)
def test_pages_against_reading_all_texts(spark, articles, index, word):
    expected = [r.doc_id for r in articles.where(F.contains("text", F.lit(word))).orderBy("doc_id").collect()]
    rows = keywords.matches(spark, index, word)
    assert sum(len(r["rows"]) for r in rows.collect()) == len(expected)
    for first, last, size in ((2, 4, 7), (1, 3, 50)):
        page = [r.doc_id for r in keywords.pages(spark, index, word, first, last, size).collect()]
        assert page == expected[(first - 1) * size : last * size]


def test_pages_as_without_an_index(spark, articles, index):
    for first, last in ((1, 1), (3, 9)):
        plain = [r.doc_id for r in terms.keyword_range(articles, "ab", first, last, 7).collect()]
        assert plain == [r.doc_id for r in keywords.pages(spark, index, "ab", first, last, 7).collect()]


def test_a_part_holds_its_rows_only(spark, articles, index):
    sizes = spark.read.parquet(f"{index}/articles").groupBy("part").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    parts = sorted(sizes.collect(), key=lambda r: r["part"])
    assert len(parts) > 8 and max(r["n"] for r in parts) < 180
    assert all(a["high"] < b["low"] for a, b in zip(parts, parts[1:]))


def test_lists_of_hits_are_cut(spark, articles, tmp_path, monkeypatch):
    """Hits that a task writes in several lists are found as in one."""
    monkeypatch.setattr(keywords, "_FLUSH", 500)
    keywords.build(articles, f"{tmp_path}/index", part_rows=400)
    lists = spark.read.parquet(f"{tmp_path}/index/hits").groupBy("gram", "part").count()
    for word in ("ab", "abab"):
        expected = articles.where(F.contains("text", F.lit(word))).count()
        assert sum(len(r["rows"]) for r in keywords.matches(spark, f"{tmp_path}/index", word).collect()) == expected
    assert lists.count() > 0


def test_an_empty_table_and_keyword(spark, articles, tmp_path):
    keywords.build(articles.limit(0), f"{tmp_path}/index")
    assert keywords.pages(spark, f"{tmp_path}/index", "abc", 1, 2).count() == 0
    with pytest.raises(ValueError, match="keyword"):
        keywords.matches(spark, f"{tmp_path}/index", "")


def test_repeated_rows(spark, tmp_path):
    rows = [(5, "one two"), (5, "one two"), (5, "one three"), (None, "one")]
    keywords.build(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/index", part_rows=1)
    found = [(r.doc_id, r.text) for r in keywords.pages(spark, f"{tmp_path}/index", "one", 1, 1).collect()]
    assert found[0] == (None, "one") and sorted(found[1:]) == [(5, "one three"), (5, "one two"), (5, "one two")]


def _batch(rows):
    part, row, text = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(row, pa.int64()), pa.array(text)], ["part", "row", "text"])


def _places(batches):
    """(part, trigram) to the hits of all its lists."""
    found = {}
    for batch in keywords._opened(iter(batches)):
        for gram, part, hits in zip(*(batch.column(x).to_pylist() for x in ("gram", "part", "hits")), strict=True):
            found.setdefault((part, gram), []).extend((x >> 32, x & 0xFFFFFFFF) for x in hits)
    return found


def test_a_task_holds_no_whole_part(monkeypatch):
    """Lists are written while a part is read, also inside of a long text, and hold all places."""
    monkeypatch.setattr(keywords, "_FLUSH", 400)
    rng = random.Random(3)
    rows = [(p, r, "".join(rng.choices("abß😀", k=rng.choice([0, 1, 2, 90, 1500])))) for p in (4, 5) for r in range(0, 3000, 100)]
    read = []

    def batches():
        for low in range(0, len(rows), 5):
            read.append(low)
            yield _batch(rows[low : low + 5])

    written, before = [], []
    for batch in keywords._hits(batches()):
        before.append(len(read))
        written.append(batch)
    assert before[0] < 3 and len(written) > 20
    expected = {}
    for part, row, text in rows:
        signs = [ord(c) for c in text] + [0, 0]
        for i in range(len(text)):
            expected.setdefault((part, signs[i] << 42 | signs[i + 1] << 21 | signs[i + 2]), []).append((row, i))
    assert _places(written) == expected


def test_hits_take_few_bytes():
    """Hits of a text of usual size take some three bytes on the average, not eight."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(900)]
    rows = [(0, r, " ".join(rng.choices(words, k=300))) for r in range(300)]
    sizes = [sum(len(x.as_py()) for x in batch.column("hits")) for batch in keywords._hits(iter([_batch(rows)]))]
    assert sum(sizes) < 3.2 * sum(len(text) for _, _, text in rows)


def test_large_steps_between_hits():
    gram = np.array([3, 3, 3, 9, 9], np.int64)
    row = np.array([0, 0, (1 << 33) - 1, 5, 70], np.int64)
    place = np.array([0, (1 << 31) - 2, 3, 8, 1 << 20], np.int64)
    grams, data, borders = keywords._lists(gram, row % (1 << 31), place)
    hits, own = keywords._unpacked(data, borders)
    assert grams.tolist() == [3, 9] and own.tolist() == [0, 3, 5]
    assert hits.tolist() == (row % (1 << 31) << 32 | place).tolist()
    assert keywords._unpacked(np.zeros(0, np.uint8), np.zeros(1, np.int64))[0].tolist() == []


def test_small_parts_share_the_rows_of_a_trigram():
    """A task that holds many small parts, in any order, writes one row for a trigram, not one for each part."""
    rng = random.Random(7)
    rows = [(p, r, "".join(rng.choices("abcß", k=40))) for p in (*range(300, 200, -1), 9000) for r in range(3)]
    written = list(keywords._hits(_batch(rows[low : low + 50]) for low in range(0, len(rows), 50)))
    expected = {}
    for part, row, text in rows:
        signs = [ord(c) for c in text] + [0, 0]
        for i in range(len(text)):
            expected.setdefault((part, signs[i] << 42 | signs[i + 1] << 21 | signs[i + 2]), []).append((row, i))
    assert _places(written) == expected
    assert sum(len(batch) for batch in written) == len({gram for _, gram in expected}) < len(expected) / 20
