import json

from pyspark.sql import functions as F

from taskloom.operators import trajectories
from taskloom.streaming import incremental


def test_two_increments_equal_one(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "id int, v string"
    first = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], schema).coalesce(1)
    second = spark.createDataFrame([(2, "late copy"), (3, "c"), (3, "c")], schema).coalesce(1)
    first.write.parquet(source)
    run = lambda: sorted(str((r.id, r.v)) for r in incremental.run_increment(spark, source, str(tmp_path / "w"), ["id"], schema=first.schema).collect())
    assert run() == sorted(["(1, 'a')", "(2, 'b')", "(None, 'n')"])
    assert len(run()) == 3  # nothing new
    second.write.mode("append").parquet(source)
    assert run() == sorted(["(1, 'a')", "(2, 'b')", "(None, 'n')", "(3, 'c')"])


def msg(role, **more):
    return {"role": role, **more}


def test_styles(spark):
    call = {"function": {"name": "edit", "arguments": json.dumps({"path": "p", "old_str": "a", "z": 1})}}
    query = [msg("system", content="S"), msg("user", content=[{"text": "U"}]), msg("assistant", content="C", thought="T", action="ls", tool_calls=[call]),
             msg("tool", content=[{"text": "O"}])]
    new = {"trajectory": [{"query": query, "response": "r"}, {"query": [], "response": "Exit due to cost limit"}]}
    old = {"trajectory": [{"messages": [*query, msg("assistant", content="last")]}]}
    rows = [(1, json.dumps(new)), (2, json.dumps(old)), (3, "broken"), (4, None), (5, json.dumps({"trajectory": []}))]
    t = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: r for r in trajectories.messages_of(t, ["id"], "text", "xml", "NEW").collect()}
    want = [("system", "NEW"), ("user", "U"), ("assistant", "T\n\n<function=edit>\n<parameter=path>p</parameter>\n<parameter=old_str>\na\n</parameter>\n<parameter=z>1</parameter>\n</function>"), ("user", "O")]
    assert [tuple(m) for m in got[1].messages] == want == [tuple(m) for m in got[2].messages]
    assert got[3].messages is None and got[3].error and got[4].messages is None and got[4].error is None and got[5].messages == []
    ticks = {r.id: r for r in trajectories.messages_of(t, ["id"], "text", "ticks").collect()}
    assert ticks[1].messages[2].content == "T\n\n```\nls\n```" and ticks[1].messages[0].content == "S"
    tool = {r.id: r for r in trajectories.messages_of(t, ["id"], "text", "tool").collect()}
    assert tool[1].messages[3].role == "tool"


def test_transcripts_and_chat(spark):
    text = "SYSTEM: be\nTHOUGHT: a\nb\nACTION: ls\nOBSERVATION:\nout\nline\n"
    t = spark.createDataFrame([(text,), ("no parts",), (None,)], "t string")
    got = [r[0] for r in t.select(trajectories.transcript_messages(F.col("t"))).collect()]
    assert [tuple(m) for m in got[0]] == [("system", "be"), ("assistant", "a\nb"), ("assistant", "ls"), ("user", "out\nline")]
    assert got[1] == [] and got[2] is None
    chat = t.select(trajectories.chat_text(trajectories.transcript_messages(F.col("t")))).first()[0]
    assert chat.startswith("<|im_start|>system\nbe<|im_end|>\n<|im_start|>assistant\na\nb<|im_end|>")


def test_training_rows(spark):
    m = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "instance_id string, messages int")
    r = spark.createDataFrame([("a", True), ("b", None)], "instance_id string, resolved boolean")
    p = spark.createDataFrame([("a", "diff")], "instance_id string, model_patch string")
    assert sorted(tuple(x) for x in trajectories.training_rows(m, r, p).collect()) == [("a", 1, True, "diff"), ("b", 2, False, "")]


def test_training_set(spark):
    a = spark.createDataFrame([("i", f"t{n}") for n in range(5)], "instance_id string, traj_id string")
    b = spark.createDataFrame([("j", "u1", True)], "instance_id string, traj_id string, resolved boolean")
    got = [(r.instance_id, r.traj_id) for r in trajectories.training_set([a, b], most=3).collect()]
    assert len(got) == 4 and ("j", "u1") in got
    assert got == [(r.instance_id, r.traj_id) for r in trajectories.training_set([b, a.repartition(3)], most=3).collect()]
