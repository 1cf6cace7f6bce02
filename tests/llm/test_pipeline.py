import hashlib
import random
import re

import corpus_pipeline
from test_near_jaccard import expected

from barloom.llm import packing, secret_scan


def test_stages_on_documents(spark, folder, documents):
    docs, kept, rows = documents, [], []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == documents.columns, name
        docs = corpus_pipeline.stored(after, name)
        rows.append(sorted((r["doc_id"], r["text"]) for r in docs.collect()))
        kept.append({i for i, _ in rows[-1]})
    # near copies by brute force over the first stage's result
    assert kept[1] == {i for i, _, first in expected(rows[0], 5, 80) if i == first}
    items = [" ".join(re.findall(r"\w+", r["text"])) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    holds = {i for i, t in rows[1] if any(item in " ".join(re.findall(r"\w+", t)) for item in items)}
    assert holds and not holds & kept[2] and len(kept[1] - kept[2] - holds) <= 2
    assert not any(secret_scan.base_matches(t) for _, t in rows[3])
    assert all(t == dict(rows[2])[i] for i, t in rows[3] if secret_scan.REDACTED not in t)
    assert all(b <= a for a, b in zip(kept, kept[1:], strict=False)) and len(kept[-1]) > 100
    assert kept[2] == kept[3]
    whole = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in whole} == kept[-1]
    lengths = {r["doc_id"]: r["n"] for r in docs.select("doc_id", packing.token_count(docs["text"]).alias("n")).collect()}
    found = {}
    for r in whole:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["length"]
    assert found == lengths


def test_planted_cases(spark, frame, tmp_path):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdeghilnorstu") for _ in range(rng.randint(2, 7))) for _ in range(900)]

    def prose(k):
        return " ".join(rng.choices(vocabulary, k=k))

    rows = [(i, prose(rng.randint(60, 200))) for i in range(300)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(300)]
    rows = [(i, t if i % 3 else t.replace(" ", " scum ", 8)) for i, t in rows]
    clean = {i for i, _ in rows if i % 3}
    item = prose(30) + ". " + prose(6) + "."
    key = hashlib.sha1(b"k").hexdigest()
    near = rows[4][1].split()
    near[10] = "changed"
    rows += [(1000, rows[1][1]), (1001, " ".join(near)), (1002, prose(50) + " " + item + " " + prose(50))]
    rows += [(1003, prose(40) + f' token = "{key}" ' + prose(40)), (1004, None), (1005, "")]
    where = str(tmp_path / "sf")
    frame(rows).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    docs = spark.read.parquet(f"{where}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, where)
    found = {r["doc_id"]: r for r in docs.collect()}
    assert docs.columns == frame([]).columns
    assert found.keys() == clean | {1003, 1004, 1005}
    assert key not in found[1003]["text"] and secret_scan.REDACTED in found[1003]["text"]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, where).collect()} == found.keys()
