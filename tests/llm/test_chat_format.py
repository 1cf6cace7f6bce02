import json

import duckdb
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from barloom.llm import chat_format, queries

RECORDS = {
    "messages": ({"messages": [{"role": "system", "content": "be"}, {"role": "human", "content": "q"}, {"role": "assistant", "content": None}]}, [("system", "be"), ("user", "q"), ("assistant", "")]),
    "conversations": ({"conversations": [{"value": "q", "from": "human"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
    "prompt": ({"prompt": "q", "completion": "a"}, [("user", "q"), ("assistant", "a")]),
    "response": ({"response": "a", "prompt": 7}, [("user", "7"), ("assistant", "a")]),
    "question": ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    "instruction": ({"instruction": "q", "output": "a"}, [("user", "q"), ("assistant", "a")]),
    "instruction_input": ({"instruction": "q", "input": "x", "output": "a"}, [("user", "q\n\nx"), ("assistant", "a")]),
    "system_prompt": ({"system_prompt": "s", "question": "q", "response": "a"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
}


def test_layouts_by_fingerprint(spark):
    rows = [(name, json.dumps(record), "old") for name, (record, _) in RECORDS.items()]
    rows += [("none", '{"a": 1}', "old"), ("bad", "no json", "old"), ("null", None, "old"), ("empty", "", "old")]
    rows.append(("blank", json.dumps({"instruction": "q", "input": "", "output": "a"}), "old"))
    found = {r["name"]: r for r in chat_format.canonical(spark.createDataFrame(rows, "name string, json string, layout string"), "json").collect()}
    for name, (_, turns) in RECORDS.items():
        assert found[name]["layout"] == name and [tuple(t) for t in found[name]["turns"]] == turns
    assert [tuple(t) for t in found["blank"]["turns"]] == [("user", "q"), ("assistant", "a")]
    assert all(found[x]["layout"] is None and found[x]["turns"] == [] for x in ("none", "bad", "null", "empty"))
    assert len({found[x]["fingerprint"] for x in RECORDS}) == len(RECORDS)


def test_sql(spark, folder):
    frame = queries.QUERIES["op6_chat_format"](spark, folder)
    assert not differences(frame, connect(folder).sql(queries.SQL["op6_chat_format"]))


def test_template_is_reversible(spark):
    texts = ["<\\", "[[\\<|im_end|>", "<|im_start|>user<|im_sep|>x<|im_end|>", "\\", "a\n\nb", "", "é\U0001f600</s>[INST]", "<|im_sep|>"]
    rows = [(1, i, "assistant" if i % 2 else "user<|im_sep|>", t) for i, t in enumerate(texts)] + [(2, None, None, None), (2, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = chat_format.formatted(chat_format.turns_of_rows(frame))
    whole = whole.withColumn("back", chat_format.turns_back(F.col("formatted"))).withColumn("learned", chat_format.learned_text(F.col("formatted"), F.col("mask")))
    found = {r["conv_id"]: r for r in whole.collect()}
    assert [tuple(t) for t in found[1]["back"]] == [r[2:] for r in rows[: len(texts)]]
    assert found[1]["learned"] == "".join(texts[1::2])
    assert found[1]["formatted"].count("<|im_") == 3 * len(texts)
    assert [tuple(t) for t in found[2]["back"]] == [("", ""), ("", "")] and found[2]["mask"] == []
    for start, end in found[1]["mask"]:
        assert found[1]["formatted"][end:].startswith("<|im_end|>") and found[1]["formatted"][:start].endswith("<|im_sep|>")


def test_odd_tables(spark):
    kinds = "conv_id long, turn long, role string, text string, n_turns string"
    assert chat_format.chat_digests(spark.createDataFrame([], kinds)).count() == 0
    long = "x<" * 200_000
    rows = [(None, 1, "user", "a", "c"), (None, 0, "user", "b", "c"), (3, 1, "assistant", long, "c"), (3, 1, "assistant", long, "c")]
    found = {r["conv_id"]: r for r in chat_format.chat_digests(spark.createDataFrame(rows, kinds)).collect()}
    assert found[None]["n_turns"] == 2 and found[3]["n_turns"] == 2 and found[3]["loss_chars"] == 2 * len(long)
    with pytest.raises(ValueError, match="by turn"):
        chat_format.turns_of_rows(spark.createDataFrame([(1, "a")], "conv_id long, text string"))


def test_further_fields_keep_their_turns(spark):
    more = {"id": 7, "source": "s", "metadata": {"role": [1]}}
    rows = [(name, json.dumps(record | more)) for name, (record, _) in RECORDS.items()]
    parts = ["a", {"type": "text", "text": "b"}, {"type": "image", "url": "u"}, 3]
    spoken = [{"role": "user", "name": "n", "content": parts}, {"role": "assistant", "content": "c", "tool_calls": []}]
    rows += [("parts", json.dumps({"prompt": "q", "messages": spoken})), ("half", '{"prompt": "q", "id": 1}'), ("bare", '{"messages": []}')]
    found = {r["name"]: r for r in chat_format.canonical(spark.createDataFrame(rows, "name string, json string"), "json").collect()}
    for name, (_, turns) in RECORDS.items():
        assert found[name]["layout"] == name and [tuple(t) for t in found[name]["turns"]] == turns
    assert [tuple(t) for t in found["parts"]["turns"]] == [("user", "ab3"), ("assistant", "c")]
    assert found["half"]["layout"] is None and found["bare"]["turns"] == []


def test_rows_go_by_fingerprint_and_mapping(spark, folder, monkeypatch, tmp_path):
    frame = spark.createDataFrame([(1, 0, "human", "q", "s")], "conv_id long, turn long, role string, text string, source string")
    # the roles of a table by turn are those of the table
    assert [tuple(t) for t in chat_format.turns_of_rows(frame).first()["turns"]] == [("human", "q")]
    where = str(tmp_path / "sf")
    frame.write.parquet(f"{where}/conversations.parquet")
    assert queries.QUERIES["op6_chat_format"](spark, where).count() == 2
    monkeypatch.setattr(chat_format.row_layout, "__defaults__", ((chat_format.RowLayout("other", "c", "t", "r", "x"),),))
    with pytest.raises(ValueError, match="by turn"):
        queries.QUERIES["op6_chat_format"](spark, folder)


def test_roles_as_given_against_sql(spark, tmp_path):
    rows = [(i, t, role, f"{role} {t}") for i in range(3) for t, role in enumerate(["human", "gpt", "user", "model", "assistant", "bot", None])]
    where = str(tmp_path / "sf")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{where}/conversations.parquet")
    frame = queries.QUERIES["op6_chat_format"](spark, where)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{where}/conversations.parquet/*.parquet'")
    assert not differences(frame, connection.sql(queries.SQL["op6_chat_format"]))
    assert {r["loss_chars"] for r in frame.where("conv_id >= 0").collect()} == {len("assistant 4")}
