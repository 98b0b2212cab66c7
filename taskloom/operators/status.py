"""Test statuses of runs: last write, transitions, grading and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import repo_part

REF_SUFFIX = ".ref"
TRANSITIONS = {
    "FAIL_TO_PASS": ("FAILED", "PASSED"),
    "PASS_TO_PASS": ("PASSED", "PASSED"),
    "FAIL_TO_FAIL": ("FAILED", "FAILED"),
    "PASS_TO_FAIL": ("PASSED", "FAILED"),
}


def last_wins(status: DataFrame) -> DataFrame:
    """(instance_id, run, test, status): the status at the greatest position; of several there, the greatest.

    The maximum of (pos, status) combines on the map side, so no test's rows are sorted or gathered.
    """
    last = F.max(F.struct("pos", "status"))
    return status.groupBy("instance_id", "run", "test").agg(last["status"].alias("status"))


def _last_of_both(status: DataFrame, before: str, after: str) -> DataFrame:
    """(instance_id, test, transition) of every test of either run; null if it is none of the four."""
    last = lambda run: F.max(F.when(F.col("run") == run, F.struct("pos", "status")))["status"]
    both = (
        status.where(F.col("run").isin(before, after))
        .groupBy("instance_id", "test")
        .agg(last(before).alias("b"), last(after).alias("a"))
    )
    kind = F.lit(None).cast("string")
    for name, (b, a) in TRANSITIONS.items():
        kind = F.when((F.col("b") == b) & (F.col("a") == a), F.lit(name)).otherwise(kind)
    return both.select("instance_id", "test", kind.alias("transition"))


def transitions(status: DataFrame, before: str, after: str) -> DataFrame:
    """(instance_id, test, transition) of tests that have PASSED or FAILED in both runs.

    One aggregation by test holds both runs' last statuses, in place of a join of two.
    """
    return _last_of_both(status, before, after).where("transition is not null")


def transition_report(status: DataFrame, before: str, after: str) -> DataFrame:
    """One row per instance with rows in either run: its four sorted lists of tests. The statuses are read once."""
    return _last_of_both(status, before, after).groupBy("instance_id").agg(
        *(F.array_sort(F.collect_list(F.when(F.col("transition") == t, F.col("test")))).alias(t) for t in TRANSITIONS)
    )


def outcome_counts(reports: DataFrame) -> DataFrame:
    """How many reports timed out, have no newly passing test, have some; one row (``timed_out`` boolean)."""
    late = F.coalesce("timed_out", F.lit(False))
    some = F.size("FAIL_TO_PASS") > 0
    return reports.agg(
        F.count(F.lit(1)).alias("n_reports"),
        F.count_if(late).alias("n_timed_out"),
        F.count_if(~late & some).alias("n_some"),
        F.count_if(~late & ~some).alias("n_none"),
    )


def gather(reports: DataFrame, patches: DataFrame, broken: str = "FAIL_TO_PASS") -> DataFrame:
    """Reports into task instances: both lists filled, or a ``.pr_`` id whose kept tests are empty.

    broken: the list that holds the tests the bug breaks; it depends on which run the reports call
    before (``PASS_TO_FAIL`` if that's the clean one). Baseline runs and instances without a patch are no
    tasks; a timed-out report is one only under the exception.
    """
    late = F.coalesce("timed_out", F.lit(False))
    n_f2p, n_p2p = F.size(broken), F.size("PASS_TO_PASS")
    pr = F.contains("instance_id", F.lit(".pr_")) & (n_p2p == 0) & (n_f2p > 0)
    kept = reports.where(
        ~F.col("instance_id").endswith(REF_SUFFIX) & (pr | (~late & (n_f2p > 0) & (n_p2p > 0)))
    ).select("instance_id", F.col(broken).alias("FAIL_TO_PASS"), "PASS_TO_PASS")
    tasks = kept.join(patches.select("instance_id", "patch"), "instance_id").select(
        "instance_id", repo_part(F.col("instance_id")).alias("repo_key"), "patch", "FAIL_TO_PASS", "PASS_TO_PASS"
    )
    return tasks.dropDuplicates(["instance_id", "patch"])  # where the join put them: patches move once, those of tasks only


def passed(status: Column) -> Column:
    """PASSED and XFAIL pass; FAILED, ERROR and absent fail; any other is null: neither."""
    return F.when(status.isin("PASSED", "XFAIL"), True).when(status.isNull() | status.isin("FAILED", "ERROR"), False)


def grade(gold: DataFrame, status: DataFrame, key: str, run: str) -> DataFrame:
    """One row per ``key`` of gold: sorted success and failure lists of both groups, and ``resolved``.

    gold: key, instance_id, FAIL_TO_PASS, PASS_TO_PASS. A test listed twice counts twice. Resolved needs
    no failure in either list and some success.
    """
    lists = gold.select(
        key, "instance_id",
        F.explode(F.concat(
            F.transform(F.coalesce("FAIL_TO_PASS", F.array().cast("array<string>")), lambda t: F.struct(F.lit("f2p").alias("g"), t.alias("test"))),
            F.transform(F.coalesce("PASS_TO_PASS", F.array().cast("array<string>")), lambda t: F.struct(F.lit("p2p").alias("g"), t.alias("test"))),
        )).alias("x"),
    ).select(key, "instance_id", "x.g", "x.test")
    seen = last_wins(status.where(F.col("run") == run)).select("instance_id", "test", "status")
    graded = lists.join(seen, ["instance_id", "test"], "left").withColumn("ok", passed(F.col("status")))
    pick = lambda g, ok: F.array_sort(
        F.collect_list(F.when((F.col("g") == g) & (F.col("ok") == F.lit(ok)), F.col("test")))
    ).alias(f"{g}_{'success' if ok else 'failure'}")
    out = graded.groupBy(key).agg(*(pick(g, ok) for g in ("f2p", "p2p") for ok in (True, False)))
    none = F.array().cast("array<string>")
    names = ["f2p_success", "f2p_failure", "p2p_success", "p2p_failure"]
    out = gold.select(key, "instance_id").join(out, key, "left").select(
        key, "instance_id", *(F.coalesce(n, none).alias(n) for n in names)
    )
    done = (F.size("f2p_failure") + F.size("p2p_failure") == 0) & (F.size("f2p_success") + F.size("p2p_success") > 0)
    return out.withColumn("resolved", done)


def relevant_tests(tests: Column, files: Column) -> Column:
    """Tests whose name starts with one of ``files``; all if there are none."""
    return F.when(F.size(files) == 0, tests).otherwise(
        F.filter(tests, lambda t: F.exists(files, lambda f: t.startswith(f)))
    )


def eval_summary(predictions: DataFrame, graded: DataFrame) -> DataFrame:
    """One row: predictions, how many are resolved, unresolved (graded or not), and ungraded."""
    ids = predictions.select("instance_id").distinct()
    joined = ids.join(graded.groupBy("instance_id").agg(F.max("resolved").alias("resolved")), "instance_id", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce("resolved", F.lit(False))).alias("n_resolved"),
        F.count_if(~F.coalesce("resolved", F.lit(False))).alias("n_unresolved"),
        F.count_if(F.col("resolved").isNull()).alias("n_ungraded"),
    )


def without_failures(reports: DataFrame, graded: DataFrame) -> DataFrame:
    """Reports with the tests that failed in the grading taken out of both lists; order and copies stay."""
    both = reports.join(graded.select("instance_id", "f2p_failure", "p2p_failure"), "instance_id")
    drop = lambda c, bad: F.filter(c, lambda t: ~F.array_contains(bad, t)).alias(c)
    return both.select("instance_id", drop("FAIL_TO_PASS", F.col("f2p_failure")), drop("PASS_TO_PASS", F.col("p2p_failure")))


def passing_repos(status: DataFrame, run: str) -> DataFrame:
    """(repo_key, n_passed): repositories whose baseline has a passing test; the others are gated out."""
    base = last_wins(status.where(F.col("run") == run))
    return (
        base.groupBy(repo_part(F.col("instance_id")).alias("repo_key"))
        .agg(F.count_if(F.col("status") == "PASSED").alias("n_passed"))
        .where("n_passed > 0")
    )
