import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import language_model as lm
from barloom.llm.queries import VOCABULARY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")] + ["\n"]


def check_base(rows, found):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    counts = Counter(w for i, t in rows if i is not None and not held[i] for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    assert len(found) == len(rows)
    for row in found:
        own = [tokens(t) for i, t in rows if i == row["doc_id"]][0]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert row["held_out"] == held[row["doc_id"]] and row["train_tokens"] == total
        assert row["n_tokens"] == len(own) and row["n_known"] == sum(counts[w] > 0 for w in own)
        assert row["base_score"] == pytest.approx(base) and row["score"] < 0


@pytest.mark.parametrize("frequent", [1 << 20, 5])
def test_documents(documents, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    check_base(rows, lm.corpus_scores(documents, VOCABULARY).collect())


def test_odd_rows(frame, odd_rows):
    rows = [*odd_rows, (30, "A a É É\x0bx \x85y"), (31, "<|endoftext|> a")]
    check_base(rows, lm.corpus_scores(frame(rows), VOCABULARY).collect())
    assert lm.corpus_scores(frame([]), VOCABULARY).count() == 0
    found = lm.corpus_scores(frame([(None, "never learned"), (None, "never learned")]), VOCABULARY).collect()
    assert [r["train_tokens"] for r in found] == [0, 0] and all(math.isfinite(r["score"]) and not r["n_known"] for r in found)


def test_windows_score_each_place_once():
    borders = np.array([0, 1, 3, 3 + lm.WINDOW, 200, 201 + 5 * lm.STRIDE])
    of, start, skipped = lm.windows(borders)
    scored = np.zeros(borders[-1], int)
    for document, at, skip in zip(of, start, skipped, strict=True):
        assert at == borders[document] or skip == lm.WINDOW - lm.STRIDE
        scored[at + skip : min(at + lm.WINDOW, borders[document + 1])] += 1
    assert (scored == 1).all()


def test_gradient():
    rng = np.random.default_rng(2)
    weights = lm.first_weights().astype(np.float64) * 3
    rows = rng.integers(0, 9, (2, lm.WINDOW))
    group = rng.integers(0, lm.CLASSES, (2, lm.WINDOW))
    real = np.ones((2, lm.WINDOW), bool)
    real[1, 7:] = False

    def loss(point):
        w = lm.parts(point)
        logs = lm._class_logs(w, lm._flat(lm._attended(w, rows)[0]))
        return -logs[np.arange(len(logs)), group.ravel()][real.ravel()].mean()

    slope = lm.slopes(weights, rows, group, real)
    at = lm._SIZE - sum(int(np.prod(s)) for n, s in lm._SHAPES.items() if n != "vectors")
    for place in [0, 5, *rng.integers(at, lm._SIZE, 40)]:
        step = np.zeros_like(weights)
        step[place] = 1e-5
        assert slope[place] == pytest.approx((loss(weights + step) - loss(weights - step)) / 2e-5, rel=2e-3, abs=1e-7)


def test_model_is_causal_and_a_distribution():
    counts = np.zeros(lm.subword_count(VOCABULARY) + 1, np.int64)
    counts[:500] = np.arange(500, 0, -1)
    counts[-1] = 40
    lex = lm.lexicon(counts)
    shares = np.bincount(lex.group, np.exp(lex.share), minlength=lm.CLASSES)
    assert shares[shares > 0] == pytest.approx(1)
    weights = lm.first_weights() * 4
    w = lm.parts(weights)
    ids = np.arange(lm.WINDOW)[None] % 50
    changed = ids.copy()
    changed[0, 10:] = 77
    one, two = (lm._class_logs(w, lm._attended(w, lex.row[x])[0][0]) for x in (ids, changed))
    assert np.allclose(one[:10], two[:10]) and not np.allclose(one[10:], two[10:])
    assert np.exp(one).sum(1) == pytest.approx(1, abs=1e-5)


def plain_score(ids, lex, weights, end):
    """Log probability of one text, place by place, in double precision."""
    w = {name: part.astype(np.float64) for name, part in lm.parts(weights).items()}
    held = lambda x: np.clip(x, -lm.LARGEST, lm.LARGEST)
    total, read = 0.0, [end, *ids[:-1]]
    for place, coming in enumerate(ids):
        nth = max(0, -(-(place + 1 - lm.WINDOW) // lm.STRIDE))
        seen = read[nth * lm.STRIDE : place + 1]
        x = np.array([w["vectors"][lex.row[i]] + w["places"][n] for n, i in enumerate(seen)])
        a = np.exp(held(x @ w["key"] @ (x[-1] @ w["ask"]) / lm.WIDTH**0.5))
        h = x[-1] + (a / a.sum()) @ (x @ w["value"]) @ w["mix"]
        logits = held(h @ w["out"] + w["bias"])
        total += logits[lex.group[coming]] - np.log(np.exp(logits).sum()) + lex.share[coming]
    return total


@pytest.mark.parametrize("scale", [1, 4, 40])
def test_scores_are_those_of_each_text_for_itself(scale):
    rng = np.random.default_rng(scale)
    counts = np.zeros(lm.subword_count(VOCABULARY) + 1, np.int64)
    counts[:500] = np.arange(500, 0, -1)
    end = len(counts) - 1
    lex, weights = lm.lexicon(counts), lm.first_weights() * np.float32(scale)
    texts = [[*rng.integers(0, 600, size).tolist(), end] for size in (0, 1, lm.WINDOW - 1, lm.WINDOW, lm.WINDOW + 1, 100, 3, 0, 61)]

    def scores(some):
        borders = np.cumsum([0, *map(len, some)])
        return lm.log_probabilities(np.concatenate(some).astype(np.int64), borders, lex, weights, end)

    together = scores(texts)
    assert together == pytest.approx([plain_score(t, lex, weights, end) for t in texts], rel=1e-4)
    assert together == pytest.approx([scores([t])[0] for t in texts], rel=1e-6)
    assert together[::-1] == pytest.approx(scores(texts[::-1]), rel=1e-6)


def test_words_by_first_place_and_subwords_by_word():
    texts = ["b a B  a c", "", "it's 'll x,y 12ab \u00e9t\u00e9 \u4f60\u597d a\u00a0b \u2003 end", "a"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    edges = np.cumsum([0, *[len(t.encode()) for t in texts]])
    words = lm.slice_words(data, edges)
    assert len(set(words.texts)) == len(words.texts)
    split = [[w.lower() for w in WORD.findall(t)] for t in texts]
    found = [words.texts[n].decode() for n in words.number]
    assert found == [w for row in split for w in row]
    encoding, subwords = lm._encoding(VOCABULARY), lm.Subwords(VOCABULARY)
    for some in (words.texts, [w for w in words.texts if len(w.decode().split()) == 1 and w.decode().strip() == w.decode()]):
        ids, borders = subwords.of(some)
        each = [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:], strict=True)]
        assert each == [encoding.encode_ordinary(" " + w.decode()) for w in some]


def test_learning_beats_shares_of_classes(frame):
    rng = random.Random(5)
    follows = {w: rng.sample("red blue green one two three big small old new".split(), 2) for w in "red blue green one two three big small old new".split()}

    def text():
        words = ["red"]
        while len(words) < 60:
            words.append(rng.choice(follows[words[-1]]))
        return " ".join(words)

    whole = frame([(i, text()) for i in range(1500)])
    before = lm.score(whole, lm.train(whole, VOCABULARY, 1, 0)).toPandas()
    after = lm.score(whole, lm.train(whole, VOCABULARY, 1, 3)).toPandas()
    assert after["score"].sum() > 0.8 * before["score"].sum()


def test_every_training_document_teaches_once(frame, monkeypatch):
    taught = []

    def learn(part, path, lex, weights):
        taught.extend(r["doc_id"] for r in part.select("doc_id").collect())
        return weights

    monkeypatch.setattr(lm, "learn", learn)
    lm.corpus_scores(frame([(i, f"text {i}") for i in range(400)]), VOCABULARY)
    assert sorted(taught) == [i for i in range(400) if zlib.crc32(str(i).encode()) % 10]


def test_each_text_is_read_twice(frame, monkeypatch, tmp_path):
    """Once for the counts of words, once for its subwords, which learning and scoring read from a table."""
    split = lm.slice_words

    def counted(data, edges):
        with open(tmp_path / "read", "a") as log:
            log.write(f"{len(edges) - 1}\n")
        return split(data, edges)

    monkeypatch.setattr(lm, "slice_words", counted)
    rows = [(i, f"text {i} of some") for i in range(60)]
    found = lm.corpus_scores(frame(rows), VOCABULARY).collect()
    training = sum(zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows)
    assert len(found) == 60 and sum(map(int, (tmp_path / "read").read_text().split())) == 60 + training


def test_stored_subwords():
    for end in (50_000, 100_000):
        ids, borders = np.array([0, end, end, 7, end - 1, end]), np.array([0, 2, 3, 6])
        size = pa.array([600_000, 0, 600_000])
        batch = pa.RecordBatch.from_arrays([size, lm.packed_ids(ids, borders, end)], ["n_bytes", "subwords"])
        (_, _, one, first), (start, stop, two, second) = lm.id_slices(batch, end)
        assert (start, stop) == (2, 3) and [*one, *two] == ids.tolist()
        assert (first == [0, 2, 3]).all() and (second == [0, 3]).all()


def test_parted_logits_are_the_logits():
    rng = np.random.default_rng(4)
    states = rng.normal(size=(50, lm.WIDTH))
    group = rng.integers(0, lm.CLASSES, 50)
    for scale in (1, 100):
        w = {"out": rng.normal(size=(lm.WIDTH, lm.CLASSES)) * scale, "bias": rng.normal(size=lm.CLASSES)}
        both, bias = lm._parted_logits(w, states, lm.Room())
        assert np.allclose(both + bias, np.clip(states @ w["out"] + w["bias"], -lm.LARGEST, lm.LARGEST))
        assert np.allclose(lm._chosen_logs(w, states, group, lm.Room()), lm._class_logs(w, states)[np.arange(50), group])


def test_frequent_words_are_parted_into_subwords_once(frame):
    """A slice parts only words that are not in the table of frequent ones, whose ids are the same."""
    parted = []

    class Counted(lm.Subwords):
        def of(self, words):
            parted.extend(words)
            return super().of(words)

    rng = random.Random(3)
    known = [f"wörd{i} of'{i}x" for i in range(40)] + ["a\u00a0b", "end"]
    texts = [" ".join(rng.choices(known, k=30)) for _ in range(20)]
    frequent = lm.count(frame(list(enumerate(texts))), VOCABULARY).frequent
    none = lm.FrequentWords(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint16), np.zeros(1, np.int64))
    subwords = Counted(VOCABULARY)
    for more in ([], ["never seen, and\u2003odd", "", "unseen end"]):
        whole = [t.encode() for t in (*texts, *more)]
        words = lm.slice_words(np.frombuffer(b"".join(whole), np.uint8), np.cumsum([0, *map(len, whole)]))
        found = {}
        for table in (frequent, none):
            parted.clear()
            found[table is none] = lm.subword_rows(words, *lm.slice_subwords(words, subwords, table, table.places(words.hashes)), subwords.end)
            assert table is none or {x.decode() for x in parted} == set(" ".join(more).split(" ")) - {"", "end"}
        assert all((one == other).all() for one, other in zip(found[False], found[True], strict=True))


def test_slices_are_counted_together():
    texts = ["b a B  a c", "é a \u4f60\u597d", "", "a d é"]
    held = []
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        words = lm.slice_words(data, np.array([0, len(data)]))
        held.append((words, np.bincount(words.number, minlength=len(words.hashes))))
    found = lm.counted_together(held).to_pylist()
    assert {r["word"]: r["count"] for r in found} == Counter(w for t in texts for w in tokens(t)[:-1]) and len({r["hash"] for r in found}) == len(found) == 6


def test_biases_stay_apart_where_the_logits_allow_it():
    states = np.eye(lm.WIDTH) * 30
    w = {"out": np.zeros((lm.WIDTH, lm.CLASSES)), "bias": np.full(lm.CLASSES, -5.0)}
    w["out"][0, 1] = w["out"][1, 2:] = 0.5
    w["bias"][3] = -35
    both, bias = lm._parted_logits(w, states[:1], lm.Room())
    assert bias is w["bias"] and both.max() == 15
    w["bias"][3] = -45
    both, bias = lm._parted_logits(w, states, lm.Room())
    assert not bias.any() and both.min() == -lm.LARGEST
