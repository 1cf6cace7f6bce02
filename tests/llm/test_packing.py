import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import packing


def naive(lengths, sizes, smallest):
    """Best fit by looking at every open bin."""
    rooms = []
    for length in lengths:
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms[rooms.index(min(fitting))] -= length
        else:
            rooms.append(min(s for s in sizes if s >= max(length, smallest)) - length)
    return sorted(rooms)


@settings(deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60), st.sampled_from([16, 32, 64]))
def test_best_fit_against_naive(lengths, smallest):
    sizes = (16, 32, 64)
    lengths = sorted(lengths, reverse=True)
    chosen = packing.best_fit(lengths, sizes, smallest)
    filled = np.bincount(chosen, lengths).astype(int) if lengths else np.zeros(0, int)
    first = [lengths[int(np.argmax(chosen == b))] for b in range(len(filled))]
    opened = [min(s for s in sizes if s >= max(x, smallest)) for x in first]
    assert sorted((np.array(opened, int) - filled).tolist()) == naive(lengths, sizes, smallest)


def test_cheapest_plan_and_downsizing():
    lengths = sorted([60, 30, 30, 10, 5, 5], reverse=True)
    chosen, sizes = packing.pack(lengths, (16, 32, 64), 1)
    filled = np.bincount(chosen, lengths)
    assert (filled <= sizes).all()
    costs = []
    for smallest in (16, 32, 64):
        other = np.bincount(packing.best_fit(lengths, (16, 32, 64), smallest), lengths).astype(int)
        costs.append(packing.downsized(other, (16, 32, 64)).sum() + len(other))
    assert sizes.sum() + len(sizes) == min(costs)
    assert all(s == min(x for x in (16, 32, 64) if x >= f) for s, f in zip(sizes, filled, strict=True))


def check(rows, found, capacities):
    """Every token of every document is in one place, bins do not overflow or overlap."""
    bins, parts = {}, {}
    for r in found:
        bins.setdefault((r["bin_id"], r["bin_capacity"]), []).append((r["bin_start"], r["length"]))
        parts.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), places in bins.items():
        at = 0
        for start, length in sorted(places):
            assert start == at
            at += length
        assert capacity == min(c for c in capacities if c >= at)
    whole = {}
    for i, text in rows:
        whole.setdefault(i, []).append(len([w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]) + 1)
    assert parts.keys() == whole.keys()
    for i, tokens in whole.items():
        assert sum(length for _, length in parts[i]) == sum(tokens)


@pytest.mark.parametrize("shard", [4_000_000, 500])
def test_documents_are_packed_whole(frame, shard):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(int(rng.expovariate(0.02))))) for i in range(200)]
    found = packing.best_fit_packing(frame(rows), (16, 64, 128), 4, shard).collect()
    check(rows, found, (16, 64, 128))
    assert max(r["length"] for r in found) <= 128
    used = sum(r["length"] for r in found) / sum(c for _, c in {(r["bin_id"], r["bin_capacity"]) for r in found})
    assert used > (0.9 if shard > 1000 else 0.6)


def test_odd_rows(frame, odd_rows):
    check(odd_rows, packing.best_fit_packing(frame(odd_rows)).collect(), packing.CAPACITIES)
    large = (1 << 62) + 1
    found = packing.best_fit_packing(frame([(large, "a"), (None, None)])).collect()
    assert {r["doc_id"] for r in found} == {large, None}
    assert packing.best_fit_packing(frame([])).count() == 0


def test_rows_of_one_id_are_spread_over_shards(frame):
    rows = [(7 if i % 2 else None, "word " * 99) for i in range(400)]
    found = packing.best_fit_packing(frame(rows), shard_tokens=4_000).toPandas()
    held = found.groupby(found["bin_id"] // (1 << 32))["length"].sum()
    assert found["length"].sum() == 40_000 and len(found) == 400
    assert len(held) > 5 and held.max() <= 10_000
