import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import codes, periodic_runs, queries


def naive(words):
    """Every maximal stretch at every lag, in words; a stretch of several periods is one run of the smallest."""
    found = {}
    for lag in range(1, len(words) // 4 + 1):
        i = 0
        while i + lag < len(words):
            start = i
            while i + lag < len(words) and words[i] == words[i + lag]:
                i += 1
            length = i - start + lag
            if i > start and length >= max(6, 4 * lag):
                found.setdefault((start, length), lag)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def without(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def runs_of(texts):
    raw = [t.encode() for t in texts]
    edges = np.cumsum([0, *map(len, raw)])
    _, _, runs, at, _ = periodic_runs.searched(np.frombuffer(b"".join(raw), np.uint8), edges)
    rows = list(zip(*(x.tolist() for x in runs), strict=True))
    return [rows[at[i] : at[i + 1]] for i in range(len(texts))]


def made(rng, size, letters, parts):
    words = []
    for _ in range(parts):
        period = [rng.choice(letters) for _ in range(rng.randint(1, size))]
        words += (period * rng.randint(1, 9))[: rng.randint(1, 9 * size)]
        words += [rng.choice(letters) for _ in range(rng.randint(0, 9))]
    return words


@pytest.mark.parametrize("size,letters,parts", [(3, "ab", 8), (12, "abc", 6), (40, "abcdefgh", 5), (130, "abcdefghijklmnopqrst", 3), (300, "ab", 2)])
def test_runs_against_every_lag(size, letters, parts):
    rng = random.Random(size)
    texts = [made(rng, size, letters, parts) for _ in range(25)]
    assert runs_of([" ".join(t) for t in texts]) == [naive(t) for t in texts]


@settings(deadline=None, max_examples=200)
@given(st.lists(st.sampled_from("ab"), max_size=120), st.integers(1, 40), st.integers(4, 7), st.lists(st.sampled_from("ab"), max_size=40))
def test_runs_of_few_words(before, period, times, after):
    words = before + (before * 9 + ["c"] * period)[-period:] * times + after
    assert runs_of([" ".join(words), " ".join(after)]) == [naive(words), naive(after)]


def test_every_period_length():
    rng = random.Random(5)
    for period in [*range(1, 60), 97, 250, 1001]:
        unit = [str(rng.random()) for _ in range(period)]
        for extra in (0, rng.randrange(period)):
            words = ["x", *(unit * 8)[: max(6, 4 * period) + extra], "y"]
            assert runs_of([" ".join(words)]) == [[(1, max(6, 4 * period) + extra, period)]], period
            short = (unit * 8)[: max(6, 4 * period) - 1]
            assert runs_of([" ".join(["x", *short, "y"])]) == [[]]


def test_minimizers_are_the_first_least():
    rng = np.random.default_rng(3)
    values = codes.mixed(rng.integers(0, 9, 200))
    for width in (1, 2, 5, 16, 31):
        expected = {i + int(np.argmin(values[i : i + width])) for i in range(200 - width + 1)}
        assert periodic_runs.minimizers(values, width).tolist() == sorted(expected)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_rows_of_all_kinds(spark, frame, odd_rows):
    rows = [*odd_rows, (20, "a\tb " * 50), (21, "A a " * 9), (22, "no\x85break\xa0here " * 12), (23, "x " * 5), (24, "x\n" * 6)]
    found = periodic_runs.periodic_runs(frame(rows)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(i) for i, _ in rows)
    text = {i: t for i, t in rows}
    for r in found:
        words = words_of(text[r["doc_id"]])
        runs = [tuple(x) for x in r["runs"]]
        assert r["n_words"] == len(words)
        if len(words) < 1000:
            assert runs == naive(words)
        assert r["collapsed"] == " ".join(without(words, runs))
    by = {r["doc_id"]: r for r in found}
    assert by[20]["collapsed"] == "a b" and by[21]["collapsed"] == "A a"
    assert by[23]["runs"] == [] and by[24]["collapsed"] == "x"
    assert periodic_runs.periodic_runs(frame([])).count() == 0


def test_query_against_every_lag(spark, folder, tmp_path):
    """The registered query, its planted periods and digests, against plain Python on all documents of up to 2,000 words."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [r for r in documents.select("doc_id", "text").collect() if len(words_of(r["text"])) <= 2000]
    odd = [(10**6 + i, t) for i, t in enumerate([None, "", " \n", "a", "ü ü ü ü ü ü", "p q " * 70])] + [(None, "z " * 9)]
    kind = "doc_id long, text string"
    spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows] + odd, kind).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows) + len(odd)
    planted = 0
    for i, text in [(r["doc_id"], r["text"]) for r in rows] + odd:
        words = words_of(text)
        if i is not None and words:
            h = zlib.crc32(str(i).encode())
            g, n = h // 10, len(words)
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
                planted += 1
        runs = naive(words)
        row = found[i]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(" ".join(without(words, runs)).encode()).hexdigest()
    assert planted > 10
