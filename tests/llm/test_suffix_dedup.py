import hashlib
import random

import numpy as np
import pytest

from barloom.llm import suffix_dedup


def expected(rows):
    """Brute force over all strings, in order of id and place."""
    seen, found = {}, []
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, text in ordered:
        data = (text or "").encode()
        for at in range(len(data) - 99):
            place = ((i is not None, i or 0), at)
            string = data[at : at + 100]
            seen[string] = min(seen.get(string, place), place)
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            if seen[data[at : at + 100]] < ((i is not None, i or 0), at):
                gone[at : at + 100] = b"\1" * 100
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        found.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def got(frame):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r) for r in suffix_dedup.deduplicated(frame).select(*columns).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    passages = [" ".join(rng.choices(words, k=k)) for k in (12, 25, 40, 60)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) if rng.random() < 0.6 else rng.choice(passages) for _ in range(rng.randint(0, 6))]
        rows.append((rng.randint(-5, 10**12), rng.choice(["", " "]).join(parts)))
    rows += [(i + 10**13, rows[i % 7][1]) for i in range(20)]
    rows += [(50, "x" * 700), (51, "xy" * 300), (52, "x" * 99), (53, "x" * 100), (54, ("z" * 150 + "q") * 3)]
    return rows


@pytest.mark.parametrize("hot", [8192, 2])
def test_against_brute_force(frame, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 20_000)
    rows = corpus(hot)
    assert got(frame(rows)) == expected(rows)


def test_odd_rows(frame, odd_rows):
    assert got(frame(odd_rows)) == expected(odd_rows)
    assert got(frame([])) == []


def test_outputs(frame):
    text = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(80))
    rows = {r["doc_id"]: r for r in suffix_dedup.deduplicated(frame([(1, text), (2, "head " + text + " tail")])).collect()}
    assert rows[1]["removed"] == [] and bytes(rows[1]["kept"]) == text.encode()
    assert [tuple(x) for x in rows[2]["removed"]] == [(5, 5 + len(text))] and bytes(rows[2]["kept"]) == b"head  tail"


def test_pairs_by_hash():
    """Pairs meet as in a set of pairs, also of the largest and smallest numbers."""
    rng = np.random.default_rng(2)
    few = np.array([-(1 << 63), (1 << 63) - 1, -1, 0, 1, 7])
    for size, known in ((0, 0), (5, 0), (0, 5), (400, 9), (9, 400)):
        own, other = ((rng.choice(few, n), rng.choice(few, n)) for n in (size, known))
        there = set(zip(*(x.tolist() for x in other), strict=True))
        assert suffix_dedup._among(own, other).tolist() == [x in there for x in zip(*(x.tolist() for x in own), strict=True)]
        pairs = list(zip(*(x.tolist() for x in own), strict=True))
        first = {x: i for i, x in enumerate(dict.fromkeys(pairs))}
        assert suffix_dedup._numbered(*own).tolist() == [first[x] for x in pairs]
