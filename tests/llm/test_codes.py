import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import codes


@settings(deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=30), min_size=1, max_size=6))
def test_words_and_shingles(texts):
    data, edges = codes.text_bytes(pa.array(texts, pa.string()))
    words, document = codes.word_hashes(data, edges)
    lists = [t.split() for t in texts]
    assert np.bincount(document, minlength=len(texts)).tolist() == [len(x) for x in lists]
    named = dict(zip(words.tolist(), [w for x in lists for w in x], strict=True))
    assert len(named) == len({w for x in lists for w in x})
    _, borders = codes.shingles(words, document, len(texts), 3)
    sets = [{tuple(x[i : i + 3]) for i in range(max(len(x) - 2, 1))} if x else set() for x in lists]
    assert np.diff(borders).tolist() == [len(x) for x in sets]


@settings(deadline=None)
@given(st.binary(min_size=1, max_size=60), st.integers(1, 8))
def test_equal_stretches_hash_alike(data, size):
    array = np.frombuffer(data, np.uint8)
    rolling = codes.RollingHash(array)
    fixed = rolling.fixed(size)
    known = {}
    for start in range(len(data) - size + 1):
        assert known.setdefault(data[start : start + size], fixed[start]) == fixed[start]
    assert len(set(known.values())) == len(known)


def test_nulls_and_slices():
    column = pa.array(["ab", None, "", "cdé"]).slice(1)
    data, edges = codes.text_bytes(column)
    assert bytes(data) == "cdé".encode() and edges.tolist() == [0, 0, 0, 4]
    assert list(codes.slices(np.array([0, 3, 4, 4, 10]), 4)) == [(0, 3), (3, 4)]
    assert [len(x) for _, _, x, _ in codes.text_slices(pa.record_batch({"text": pa.array([], pa.string())}))] == []


def test_grams_stay_in_their_text():
    points, edges = codes.code_points(["abc", "", "éa"])
    found = {}
    for size, (bucket, inside) in zip((1, 2), codes.gram_buckets(points, edges, (1, 2), 1 << 16), strict=True):
        found[size] = bucket[inside]
    assert len(found[1]) == 5 and len(found[2]) == 3
    assert found[1][0] == found[1][4]
    assert codes.segment_sums(np.ones(5), edges).tolist() == [3, 0, 2]
