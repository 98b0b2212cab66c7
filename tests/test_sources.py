import json

import pytest
from pyspark.sql import functions as F

from taskloom.sources import readers, sinks

ROW = {"instance_id": "a__b.c8a816ae.pr_1", "repo": "a/b", "patch": "p", "image_name": "i.x86_64", "problem_statement": None, "FAIL_TO_PASS": ["t"], "PASS_TO_PASS": []}


def test_datasets(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([ROW, ROW], indent=1))
    (tmp_path / "a.jsonl").write_text(json.dumps(ROW) + "\n{broken\n" + json.dumps({"instance_id": "x", "more": 1}) + "\n")
    assert readers.good(readers.dataset(spark, str(tmp_path / "a.json"))).count() == 2
    lines = readers.dataset(spark, str(tmp_path / "a.jsonl")).cache()
    assert lines.count() == 3 and readers.good(lines).count() == 2
    with pytest.raises(ValueError, match="unsupported"):
        readers.dataset(spark, "a.csv")


def test_predictions(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"a": {"model_patch": "x", "model_name_or_path": "m"}, "b": {"instance_id": "b", "model_patch": None}}))
    got = {tuple(r) for r in readers.predictions(spark, str(tmp_path / "p.json")).collect()}
    assert got == {("a", "x", "m"), ("b", None, None)}
    gold = readers.predictions(spark, "gold", spark.createDataFrame([("a", "p")], "instance_id string, patch string")).collect()
    assert [tuple(r) for r in gold] == [("a", "p", "gold")]


def test_keyed_files(spark, tmp_path):
    for name, text in (("bug__func_pm_x__ab12.diff", "d1"), ("metadata__func_pm_x__ab12.json", "{}"), ("bug__lm__cd34.diff", "d2"), ("other.txt", "z")):
        (tmp_path / "repo").mkdir(exist_ok=True)
        (tmp_path / "repo" / name).write_text(text)
    got = {tuple(r) for r in readers.patch_files(spark, str(tmp_path)).collect()}
    assert got == {("func_pm_x", "ab12", "d1", "{}"), ("lm", "cd34", "d2", None)}
    assert readers.patch_files(spark, str(tmp_path), "func", 1).count() == 1
    run = tmp_path / "run1" / "inst"
    run.mkdir(parents=True)
    (run / "test_output.txt").write_text("log\nmore")
    (run / "report.json").write_text(json.dumps({"inst": {"FAIL_TO_PASS": ["t"], "timed_out": True}}))
    flat = tmp_path / "run1" / "inst2"
    flat.mkdir()
    (flat / "report.json").write_text(json.dumps({"FAIL_TO_PASS": ["u"]}))
    assert [tuple(r) for r in readers.run_logs(spark, str(tmp_path)).collect()] == [("run1", "inst", "test_output.txt", "log\nmore")]
    got = {(r.instance_id, tuple(r.FAIL_TO_PASS), r.timed_out) for r in readers.run_reports(spark, str(tmp_path)).collect()}
    assert got == {("inst", ("t",), True), ("inst2", ("u",), None)}


def test_source_tree(spark, tmp_path):
    for name, text in (("src/a.py", b"x = 1"), ("src/a_test.py", b"t"), ("tests/b.py", b"t"), ("lib/c.go", b"go"), ("src/bad.py", b"\xff\xfe"), ("src/d.txt", b"no")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(text)
    got = {tuple(r) for r in readers.source_tree(spark, str(tmp_path), ["py", "go"]).collect()}
    assert got == {("src/a.py", "py", "x = 1"), ("lib/c.go", "go", "go")}
    assert {r.path for r in readers.source_tree(spark, str(tmp_path), ["py"], tests=True, exclude=["tests"]).collect()} == {"src/a.py", "src/a_test.py"}
    assert readers.source_tree(spark, str(tmp_path), ["py", "go"], include=["lib"], skip_files=["c.*"]).collect() == []


def test_paged_source(spark, tmp_path):
    (tmp_path / "page-1.json").write_text(json.dumps([{"n": 1}, {"n": 2}]))
    (tmp_path / "page-2.json").write_text(json.dumps([{"n": 3}]))
    spark.dataSource.register(readers.PagedSource)
    rows = spark.read.format("paged").option("path", str(tmp_path)).option("pages", "3").load()
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 0, '{"n": 1}'), (1, 1, '{"n": 2}'), (2, 0, '{"n": 3}')]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "instance_id string, v int")
    sinks.write_lines(rows, str(tmp_path / "l"))
    sinks.write_lines(rows, str(tmp_path / "l"), append=True)
    assert spark.read.schema("instance_id string, v int").json(str(tmp_path / "l")).count() == 6
    sinks.write_arrays(rows, str(tmp_path / "arr"), per_file=2)
    assert sum(len(json.loads(r.value)) for r in spark.read.text(str(tmp_path / "arr")).collect()) == 3
    sinks.write_reports(rows, str(tmp_path / "r"), "instance_id")
    assert spark.read.parquet(str(tmp_path / "r")).where("instance_id = 'a'").count() == 2
    assert tuple(sinks.run_metadata(rows, 24, 3).first()) == (3, 2, 24, 3)
    t = spark.createDataFrame([("x.x86_64.y", None), ("z.arm64", "s")], "image_name string, problem_statement string")
    assert [tuple(r) for r in sinks.normalised(t).collect()] == [("x.y", ""), ("z", "s")]
    f = spark.createDataFrame([("d/a.traj",), ("d/b.log",), ("d/keep.log",)], "path string")
    assert [tuple(r) for r in sinks.removable(f, [".log", ".traj"], "keep.log").collect()] == [("d", 2)]
    sinks.export_files(rows.select(F.concat("instance_id", F.col("v")).alias("n"), F.lit("c").alias("c")), str(tmp_path / "x"), "n", "c")
    assert sorted(p.name for p in (tmp_path / "x").iterdir()) == ["a1", "a3", "b2"]
