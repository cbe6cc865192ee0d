"""Perspective rotation against SQL and on odd conversations."""

from __future__ import annotations

from folioflow.llm import chat
from folioflow.llm.queries import ORACLE, QUERIES
from tests.compare import difference, oracle

FOLDER = "/root/testdata/sf0.001"


def test_query_agrees_with_sql(spark):
    assert difference(QUERIES["op9_perspective_rotation"](spark, FOLDER), oracle(FOLDER), ORACLE["op9_perspective_rotation"]) is None


def test_every_participant_speaks_once_as_assistant(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", "\U0001f600 yo"), (1, 3, "ann", None), (1, 4, None, "who?"), (1, 3, "ann", None)]
    rows += [(2, 0, "system", "alone"), (None, 5, "cy", "a"), (None, None, "cy", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part", "'x' as speaker", "2 as block")
    found = {(r["conv_id"], r["speaker"]): r for r in chat.perspectives(turns).collect()}
    assert set(found) == {(1, "ann"), (1, "bob"), (None, "cy")}
    ann = found[1, "ann"]
    assert ann["text"] == (
        "<|system|>\nbe kind<|end|>\n<|assistant|>\nhi < |end|><|end|>\n<|user name=bob|>\n\U0001f600 yo<|end|>\n"
        "<|assistant|>\n<|end|>\n<|assistant|>\n<|end|>\n<|user|>\nwho?<|end|>\n"
    )
    spans = [tuple(map(int, s.split(":"))) for s in ann["mask"].split(",")]
    assert [ann["text"][a:b] for a, b in spans] == ["hi < |end|><|end|>", "<|end|>", "<|end|>"]
    assert ann["trained_chars"] == sum(b - a for a, b in spans) and ann["n_turns"] == 6
    assert found[1, "bob"]["text"].count("<|user name=ann|>") == 3
    assert found[None, "cy"]["text"] == "<|assistant|>\nb<|end|>\n<|assistant|>\na<|end|>\n"
    assert chat.perspectives(turns.limit(0)).count() == 0


def test_a_long_conversation_is_cut_into_parts(spark):
    rows = [(7, k, "ab"[k % 2], f"t{k}") for k in range(1000)] + [(8, 0, "a", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = chat.perspectives(turns, part_turns=64).where("conv_id = 7").collect()
    assert len(found) == 2 * 16
    for speaker in "ab":
        text = "".join(r["text"] for r in sorted(found, key=lambda r: r["part"]) if r["speaker"] == speaker)
        assert [int(x[1:]) for x in text.replace("<|end|>", "").split("\n") if x.startswith("t")] == list(range(1000))


def test_a_hot_conversation_meets_its_speakers_in_groups_of_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PARTS_TOGETHER", 2)
    rows = [(7, k, "abc"[k % 3], f"t{k}") for k in range(300)] + [(8, 0, "a", "x"), (9, 0, "system", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = chat.perspectives(turns, part_turns=8)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {(r["conv_id"], r["speaker"], r["part"]): r["text"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "hashpartitioning(_c" in plan and "together" in plan
    assert len(got) == 3 * 38 + 1
    assert got[7, "b", 37].count("<|assistant|>") == 1 and "t299" in got[7, "a", 37]
