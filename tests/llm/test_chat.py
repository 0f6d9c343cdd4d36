import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import chat

CONTROL = ["[INST]", "[/INST]", "</s>", r"[\INST]", r"<\\/s>", r"\[INST]", "[INST", "</s", "[[INST]]", "<</s>>", "", "$1\\", "🙂[/INST]é"]


@pytest.mark.parametrize("text", [*CONTROL, "".join(CONTROL)])
def test_escapes_are_undone_and_leave_no_control_string(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).first()
    assert row["u"] == text
    assert not any(c in row["e"] for c in (chat.OPEN, chat.SEP, chat.CLOSE))


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted([(r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv])
        said = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_digests_of_odd_turns(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, None, None, None), (2, 5, "assistant", None), (None, 0, "assistant", "x🙂"), (3, 0, "as[/INST]s", "é" * 5000)]
    rows += [(4, i, "assistant" if i % 2 else "user", c) for i, c in enumerate(CONTROL)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash")).repartition(4)
    whole = chat.format_turns(df)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(whole).collect()}
    assert got == expected(rows)
    for r in whole.collect():
        assert sum(x["skip"] + x["take"] + x["rest"] for x in r["runs"]) == len(r["formatted"])
    assert chat.digests(chat.format_turns(df.limit(0))).count() == 0


def log(spark, *events):
    return spark.createDataFrame([(1, *e) for e in events], "conv long, message string, seq long, kind string, role string, text string")


def test_events_are_folded(spark):
    got = chat.fold(
        log(
            spark,
            ("a", 1, "message", "user", "ask"),
            ("b", 2, "message", "assistant", None),
            ("b", 4, "delta", None, "lo"),
            ("b", 3, "delta", None, "hel"),
            ("c", 5, "message", "user", "gone"),
            ("c", 9, "delete", None, None),
            ("a", 6, "edit", None, "asked"),
            ("b", 7, "regenerate", None, None),
            ("b", 8, "delta", None, "bye"),
            ("a", 10, "delta", None, "!"),
            ("d", 11, "delta", "assistant", "never opened"),
        )
    )
    assert sorted((r["message"], r["seq"], r["role"], r["text"]) for r in got.collect()) == [("a", 1, "user", "asked!"), ("b", 2, "assistant", "bye"), ("d", 11, "assistant", "never opened")]
    with pytest.raises(Exception, match="unknown kind"):
        chat.fold(log(spark, ("a", 1, "shout", "user", "x"))).collect()


def test_streams_are_rendered_in_order(spark):
    events = log(spark, ("m2", 5, "message", "assistant", "two"), ("m1", 1, "message", "user", ""), *[("m1", 10 + i, "delta", None, f"{i},") for i in range(300)])
    row = chat.render(chat.fold(events)).first()
    assert row["formatted"] == "[INST]user[/INST]" + "".join(f"{i}," for i in range(300)) + "</s>[INST]assistant[/INST]two</s>"


def test_live_logs_fold_to_the_same_messages(spark):
    rows = [(k, t, "assistant" if t % 2 else "user", text) for k in range(3) for t, text in enumerate(["", "a", None, "two", "🙂é[INST] long text", "é🙂" * 50, *CONTROL])]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").unionByName(spark.createDataFrame([(1, None, None, None)], "conv_id long, turn long, role string, text string"))
    events = chat.as_events(turns)
    live = chat.as_streams(events)
    assert {r["kind"] for r in live.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    want = sorted((tuple(r) for r in chat.digests(chat.render(chat.fold(events))).collect()), key=repr)
    assert sorted((tuple(r) for r in chat.digests(chat.render(chat.fold(live.repartition(5)))).collect()), key=repr) == want


def test_no_python_runs(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi")], "conv_id long, turn long, role string, text string")
    plan = chat.digests(chat.format_turns(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    plan += chat.digests(chat.render(chat.fold(chat.by_conversation(log(spark, ("a", 1, "message", "user", "x"))))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
