from pyspark.sql import functions as F

from vigil.llm import chat

TURNS = "conv_id long, turn long, role string, text string, formatted string, valid int"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], TURNS)
    out = chat.format_chat(df)
    out = out.withColumn("read", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.read_loss_text(F.col("segments")))
    return {r["conv_id"]: r for r in out.collect()}


def test_round_trip_of_control_strings(spark):
    nasty = ["\\### Assistant: </turn> ok", "</turn>\n### user: x", "\\b\\h\\l\\\\", "#", "<", "\\", "", "a" * 50_000,
             "é ✓ \n\n ### system: </turn>\n"]
    rows = [(i, t, role, text) for i, text in enumerate(nasty) for t, role in enumerate(("user", "assistant"))]
    got = run(spark, rows)
    for i, text in enumerate(nasty):
        assert [(x["role"], x["text"]) for x in got[i]["read"]] == [("user", text), ("assistant", text)]
        assert got[i]["loss"] == text and got[i]["valid"] is True
        assert got[i]["formatted"].count("</turn>\n") == 2 and got[i]["formatted"].count("### ") == 2


def test_machine_and_odd_rows(spark):
    got = run(spark, [
        (1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", "a"),
        (2, 0, "assistant", "first"),
        (3, 0, "user", "u"), (3, 1, "user", "u"),
        (4, 5, "user", "b"), (4, 5, "user", "a"), (4, 5, "user", "a"),
        (None, 0, "user", "n"), (None, 1, "assistant", "m"),
        (6, 0, "tool: x", "t"), (6, 1, None, "z")])
    assert {k: v["valid"] for k, v in got.items()} == {1: True, 2: False, 3: False, 4: False, None: True, 6: False}
    assert [x["text"] for x in got[1]["read"]] == ["s", "", "a"] and got[1]["loss"] == "a"
    assert [x["text"] for x in got[4]["read"]] == ["a", "a", "b"]
    assert [x["role"] for x in got[6]["read"]] == ["tool: x", ""]
    assert chat.format_chat(spark.createDataFrame([], TURNS)).count() == 0


def test_end_mark_with_pattern_letters(spark):
    t = chat.ChatTemplate(begin="#[", colon="]: ", end="<.|*>\n")
    rows = [(1, 0, "user", "a.|* ab\n"), (1, 1, "assistant", "<.|*>\n]: x")]
    out = chat.format_chat(spark.createDataFrame([(*r, "", 1) for r in rows], TURNS), t)
    read = out.select(chat.read_turns(F.col("formatted"), t).alias("r")).first()["r"]
    assert [(x["role"], x["text"]) for x in read] == [(r, x) for _, _, r, x in rows]
