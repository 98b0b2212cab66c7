import pytest
from pyspark.sql import functions as F

from taskloom.operators import scores, status

STATUS = "instance_id string, run string, test string, status string, pos bigint, extra int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], STATUS)


def test_transitions_and_last_write(spark):
    rows = [("i", "buggy", "a", "FAILED", 0), ("i", "clean", "a", "PASSED", 0), ("i", "buggy", "b", "PASSED", 0), ("i", "buggy", "b", "FAILED", 5),
            ("i", "clean", "b", "FAILED", 1), ("i", "buggy", "c", "PASSED", 0), ("i", "clean", "c", "PASSED", 0), ("i", "clean", "c", "PASSED", 0),
            ("i", "buggy", "d", "PASSED", 0), ("i", "clean", "d", "FAILED", 0), ("i", "buggy", "e", "ERROR", 0), ("i", "clean", "e", "PASSED", 0),
            ("i", "clean", "f", "PASSED", 0), ("j", "clean", "a", None, 0), ("k", "gold", "a", "PASSED", 0), ("i", "buggy", None, "FAILED", 0)]
    got = {r.instance_id: r for r in status.transition_report(table(spark, rows), "buggy", "clean").collect()}
    assert set(got) == {"i", "j"}
    assert [got["i"][t] for t in status.TRANSITIONS] == [["a"], ["c"], ["b"], ["d"]]
    assert [got["j"][t] for t in status.TRANSITIONS] == [[], [], [], []]
    other = {r.instance_id: r for r in status.transition_report(table(spark, rows), "clean", "buggy").collect()}
    assert other["i"].PASS_TO_FAIL == ["a"] and other["i"].FAIL_TO_PASS == ["d"]
    assert status.transition_report(table(spark, []), "buggy", "clean").collect() == []


def test_gather_under_both_conventions(spark):
    schema = "instance_id string, FAIL_TO_PASS array<string>, PASS_TO_PASS array<string>, PASS_TO_FAIL array<string>, timed_out boolean"
    rows = [("o__r.c.lm__1", ["a"], ["b"], [], None), ("o__r.c.pr_1", ["a"], [], ["x"], True), ("o__r.c.lm__2", ["a"], [], ["x"], None),
            ("o__r.c.lm__3", ["a"], ["b"], ["x"], True), ("o__r.c.ref", ["a"], ["b"], [], None), ("o__r.c.lm__4", [], ["b"], ["x"], None)]
    reports = spark.createDataFrame(rows, schema)
    patches = spark.createDataFrame([(r[0], "p") for r in rows] + [(rows[0][0], "p")], "instance_id string, patch string")
    got = {r.instance_id for r in status.gather(reports, patches).collect()}
    assert got == {"o__r.c.lm__1", "o__r.c.pr_1"}
    got = {r.instance_id: r for r in status.gather(reports, patches, broken="PASS_TO_FAIL").collect()}
    assert set(got) == {"o__r.c.lm__4", "o__r.c.pr_1"} and got["o__r.c.lm__4"].repo_key == "o__r.c"
    one = status.outcome_counts(reports).first()
    assert (one.n_reports, one.n_timed_out, one.n_some, one.n_none) == (6, 2, 3, 1)


def test_grading_matrix(spark):
    gold = spark.createDataFrame(
        [(1, "i", ["p", "x", "f", "e", "absent", "s"], ["p"]), (2, "j", ["p"], ["x"]), (3, "k", None, []), (4, "i", ["p"], None)],
        "row_id int, instance_id string, FAIL_TO_PASS array<string>, PASS_TO_PASS array<string>",
    )
    names = {"p": "PASSED", "x": "XFAIL", "f": "FAILED", "e": "ERROR", "s": "SKIPPED"}
    rows = [(i, "eval", t, s, 0) for i in "ij" for t, s in names.items()]
    got = {r.row_id: r for r in status.grade(gold, table(spark, rows), "row_id", "eval").collect()}
    assert got[1].f2p_success == ["p", "x"] and got[1].f2p_failure == ["absent", "e", "f"] and not got[1].resolved
    assert got[2].resolved and got[4].resolved and not got[3].resolved
    p = spark.createDataFrame([("i",), ("j",), ("j",), ("gone",)], "instance_id string")
    one = status.eval_summary(p, status.grade(gold, table(spark, rows), "row_id", "eval")).first()
    assert (one.total, one.n_resolved, one.n_unresolved, one.n_ungraded) == (3, 2, 1, 1)


def test_relevant_tests(spark):
    t = spark.createDataFrame([(["a/x::1", "b::1"], ["a/"]), (["a"], [])], "tests array<string>, files array<string>")
    assert [r[0] for r in t.select(status.relevant_tests(F.col("tests"), F.col("files"))).collect()] == [["a/x::1"], ["a"]]


GOLDEN = [(438, 1408, 446, 5.014), (93, 197, 10, 3.893), (173, 284, 43, 3.96), (55, 265, 186, 6.036), (288, 1456, 664, 5.625), (67, 156, 4, 3.89),
          (441, 542, 17, 3.304), (68, 796, 136, 5.272), (374, 603, 23, 3.596), (206, 619, 175, 4.876), (52, 716, 232, 5.72)]


@pytest.mark.parametrize(("easy", "medium", "hard", "score"), GOLDEN)
def test_published_difficulty_scores(spark, easy, medium, hard, score):
    labels = spark.range(easy + medium + hard + 2).select(
        F.when(F.col("id") < easy, "<15 min fix").when(F.col("id") < easy + medium, "15 min - 1 hour")
        .when(F.col("id") < easy + medium + hard, ">4 hours").when(F.col("id") == easy + medium + hard, "unknown").alias("d")
    )
    one = scores.weighted_score(labels.select(scores.merged_label(F.col("d")).alias("d")), "d").first()
    assert (one.n_easy, one.n_medium, one.n_hard, one.n_rated, one.score) == (easy, medium, hard, easy + medium + hard, score)


def test_issue_references(spark):
    t = spark.createDataFrame([("Fixes #12 and closes  #3, see #9 <!-- fix #1\n -->\nfix #12",), ("prefix #4 fixing #5",), (None,)], "t string")
    assert [r[0] for r in t.select(scores.resolved_issues(F.col("t"))).collect()] == [["12", "3"], [], None]
