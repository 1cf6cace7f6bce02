import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from barloom.llm import decontamination


def bm25(items, passage):
    """Share of each item's own BM25 score that the words of a passage give, word by word."""
    split = [re.findall(r"[0-9a-z]+", t.lower()) for t in items]
    average = sum(map(len, split)) / len(split)
    seen = Counter(w for x in split for w in set(x))
    shares = []
    for words in split:
        gain = {}
        for word, times in Counter(words).items():
            rarity = math.log1p((len(split) - seen[word] + 0.5) / (seen[word] + 0.5))
            gain[word] = rarity * times * 2.2 / (times + 1.2 * (0.25 + 0.75 * len(words) / average))
        shares.append(sum(gain[w] for w in set(passage) & set(gain)) / sum(gain.values()))
    return shares


def index_of(items):
    words = [decontamination.text_words(t) for t in items]
    seen = Counter(x for w in words for x in set(w.tolist()))
    return decontamination.build_index(list(enumerate(items)), len(items), float(np.mean([len(w) for w in words])), seen)


@pytest.mark.parametrize("block", [1, 8, 64])
def test_search_finds_all_above_threshold(monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK", block)
    rng = random.Random(block)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randint(3, 12), weights=range(1, 61))) for _ in range(40)]
    index = index_of(items)
    number = {i.item_id: n for n, i in enumerate(index.items)}
    passages = [rng.sample(vocabulary, k=rng.randint(1, 30)) for _ in range(50)]
    place = dict(zip(index.words.tolist(), range(len(index.words)), strict=True))
    pairs = sorted({(p, place[h]) for p, ws in enumerate(passages) for h in decontamination.text_words(" ".join(ws)).tolist() if h in place})
    passage, word = (np.array(x) for x in zip(*pairs, strict=True))
    found = {(p, i): s for p, i, s in zip(*decontamination.search(index, passage, word, len(passages), 0.4), strict=True)}
    expected = {(p, number[i]): s for p, ws in enumerate(passages) for i, s in enumerate(bm25(items, ws)) if s >= 0.4}
    assert found.keys() == expected.keys() and len(found) > 20
    assert all(found[k] == pytest.approx(expected[k]) for k in found)


@pytest.mark.parametrize("shard", [8 << 20, 300])
def test_planted_items(spark, frame, monkeypatch, shard):
    monkeypatch.setattr(decontamination, "SHARD_BYTES", shard)
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4000)]

    def prose(k):
        return " ".join(rng.choices(vocabulary, k=k))

    items = [f"{prose(20)}. {prose(12)}." for _ in range(20)] + [prose(8)]
    rows = [(i, prose(300)) for i in range(30)]
    rows += [(100 + i, f"{prose(rng.randint(0, 300))} {item.upper()} {prose(rng.randint(0, 300))}") for i, item in enumerate(items)]
    rows += [(200, prose(90) + " " + items[0].split(". ")[0] + " " + prose(50)), (201, " ".join(items[1].split()[:12]))]
    rows += [(202, " ".join(x for x in items[2].split()[::-1]))]
    benchmark = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, "  ")], "item_id long, text string")
    found = decontamination.contaminated(decontamination.retrieve(frame(rows), benchmark)).collect()
    pairs = {(r["doc_id"], r["item_id"]): r for r in found}
    assert pairs.keys() == {(100 + i, i) for i in range(len(items))} | {(200, 0)}
    assert pairs[100, 0]["answer_found"] and pairs[100, 0]["item_overlap"] == 1 and not pairs[200, 0]["answer_found"]
    # rows are judged each for itself, also those without an id or with the id of another
    whole = frame([*rows, (None, items[0]), (None, "clean"), (100, "clean too"), (300, None), (301, "")])
    kept = decontamination.clean(whole, benchmark)
    assert kept.columns == whole.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [*range(30), 201, 202, 300, 301, None, 100]))


def test_documents(spark, folder, documents):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(decontamination.retrieve(documents, benchmark)).collect()}

    def plain(text):
        return " " + " ".join(re.findall(r"\w+", text)) + " "

    texts = [(r["doc_id"], plain(r["text"])) for r in documents.collect()]
    planted = {(i, b["item_id"]) for b in benchmark.collect() for i, t in texts if plain(b["text"]) in t}
    assert planted and planted <= found


def test_odd_rows(spark, frame, odd_rows):
    benchmark = spark.createDataFrame([(1, "no id at all")], "item_id long, text string")
    found = decontamination.retrieve(frame(odd_rows), benchmark).collect()
    assert [(r["doc_id"], r["item_id"], r["item_overlap"]) for r in found] == [(None, 1, 1.0)]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.retrieve(frame(odd_rows), none).count() == 0
    assert decontamination.clean(frame(odd_rows), none).count() == len(odd_rows)
    assert decontamination.retrieve(frame([]), benchmark).count() == 0


def test_every_word_is_in_a_passage():
    item = " ".join(f"q{i}" for i in range(30))
    index = index_of([item, "other words here"])
    for before in (0, 40, 64, 100, 127, 128, 500):
        data = np.frombuffer((" ".join(f"x{i}" for i in range(before)) + " " + item).encode(), np.uint8)
        found = list(decontamination.match_slice(data, np.array([0, len(data)]), index))
        assert [(r[1], r[4]) for r in found] == [([x.item_id for x in index.items].index(0), 1.0)]


def test_question_without_its_answer(spark, frame):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4000)]

    def prose(k):
        return " ".join(rng.choices(vocabulary, k=k))

    question = prose(8) + "?"
    benchmark = spark.createDataFrame([(1, f"{question} {prose(40)}."), (2, f"Why? {prose(40)}.")], "item_id long, text string")
    rows = [(1, f"{prose(150)} {question} {prose(150)}"), (2, f"{prose(70)} why {prose(70)}"), (3, prose(300))]
    found = decontamination.contaminated(decontamination.retrieve(frame(rows), benchmark)).collect()
    assert [(r["doc_id"], r["item_id"], r["question_overlap"], r["answer_found"]) for r in found] == [(1, 1, 1.0, False)]
    assert found[0]["score"] == pytest.approx(1)


@pytest.mark.parametrize("size", [65, 300, 700, 1500])
def test_long_items(spark, frame, size):
    rng = random.Random(size)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(20_000)]

    def prose(k):
        return " ".join(rng.choices(vocabulary, k=k))

    items = [f"{prose(size)}. {prose(8)}.", f"{prose(20)}. {prose(size)}.", prose(size)]
    benchmark = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    question = items[0].split(". ")[0].split()
    half = size // 2
    rows = [(i, f"{prose(50)} {item} {prose(33)}") for i, item in enumerate(items)]
    rows.append((10, f"{prose(50)} {' '.join(question)} {prose(50)}"))
    rows.append((11, f"{' '.join(question[:half])} {prose(400)} {' '.join(question[half:])}"))
    rows.append((12, f"{prose(50)} {' '.join(question[:half])} {prose(50)}"))
    found = decontamination.contaminated(decontamination.retrieve(frame(rows), benchmark)).collect()
    pairs = {(r["doc_id"], r["item_id"]): r for r in found}
    assert pairs.keys() == {(0, 0), (1, 1), (2, 2), (10, 0), (11, 0)}
    assert all(pairs[i, i]["item_overlap"] == 1 and pairs[i, i]["answer_found"] for i in range(3))
