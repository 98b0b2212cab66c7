"""Queries over runs, instances, predictions and labels, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import aggregates, diffs, joins, scores, status, windows
from ..session import table

T = table

# Pieces of SQL that several queries share.
_LAST = """
    last AS (SELECT instance_id, run, test, status FROM (
        SELECT *, row_number() OVER (PARTITION BY instance_id, run, test ORDER BY pos DESC, status DESC NULLS LAST) AS r
        FROM test_status) WHERE r = 1)
"""
_BUG_TYPE = r"""
    CASE WHEN starts_with(regexp_replace(regexp_extract(instance_id, '([^.]*)$', 1), '_[^_]*$', ''), 'func_pm') THEN 'func_pm'
         ELSE regexp_replace(regexp_extract(instance_id, '([^.]*)$', 1), '_[^_]*$', '') END
"""
_REPO = r"regexp_replace(instance_id, '\.[^.]*$', '')"
_NONE = "[]::VARCHAR[]"


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    """Reports of the buggy run against the clean one; a report is late if its rows came after March."""
    rows = T(spark, folder, "test_status")
    late = rows.groupBy("instance_id").agg((F.max("recorded_at") >= F.lit("2025-12-01").cast("timestamp_ntz")).alias("timed_out"))
    return status.transition_report(rows, "buggy", "clean").join(late, "instance_id")


_TRANSITIONS = f"""
    {_LAST}, pairs AS (
        SELECT c.instance_id, c.test, b.status AS before, c.status AS after
        FROM last c JOIN last b ON c.instance_id = b.instance_id AND c.test = b.test AND c.run = 'clean' AND b.run = 'buggy'),
    kinds AS (SELECT instance_id, test, CASE
        WHEN before = 'FAILED' AND after = 'PASSED' THEN 'F2P' WHEN before = 'PASSED' AND after = 'PASSED' THEN 'P2P'
        WHEN before = 'FAILED' AND after = 'FAILED' THEN 'F2F' WHEN before = 'PASSED' AND after = 'FAILED' THEN 'P2F' END AS k FROM pairs),
    reports AS (
        SELECT s.instance_id, s.timed_out,
               coalesce(list_sort(list(k.test) FILTER (k.k = 'F2P')), {_NONE}) AS FAIL_TO_PASS,
               coalesce(list_sort(list(k.test) FILTER (k.k = 'P2P')), {_NONE}) AS PASS_TO_PASS,
               coalesce(list_sort(list(k.test) FILTER (k.k = 'F2F')), {_NONE}) AS FAIL_TO_FAIL,
               coalesce(list_sort(list(k.test) FILTER (k.k = 'P2F')), {_NONE}) AS PASS_TO_FAIL
        FROM (SELECT instance_id, max(recorded_at) >= TIMESTAMP '2025-12-01' AS timed_out FROM test_status
              WHERE run IN ('clean', 'buggy') GROUP BY 1) s
        LEFT JOIN kinds k USING (instance_id) GROUP BY ALL)
"""


def status_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    return status.last_wins(T(spark, folder, "test_status"))


def transition_report(spark: SparkSession, folder: str) -> DataFrame:
    return status.transition_report(T(spark, folder, "test_status"), "buggy", "clean")


def validation_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return status.outcome_counts(_reports(spark, folder))


def gather_tasks(spark: SparkSession, folder: str) -> DataFrame:
    patches = T(spark, folder, "task_instances").where("patch is not null")
    return status.gather(_reports(spark, folder), patches)


def _gold(spark: SparkSession, folder: str) -> DataFrame:
    return T(spark, folder, "task_instances").select("row_id", "instance_id", "FAIL_TO_PASS", "PASS_TO_PASS")


def eval_grading(spark: SparkSession, folder: str) -> DataFrame:
    return status.grade(_gold(spark, folder), T(spark, folder, "test_status"), "row_id", "clean")


_GRADED = f"""
    {_LAST}, lists AS (
        SELECT row_id, instance_id, 'f2p' AS g, unnest(FAIL_TO_PASS) AS test FROM task_instances
        UNION ALL SELECT row_id, instance_id, 'p2p', unnest(PASS_TO_PASS) FROM task_instances),
    marks AS (SELECT l.row_id, l.g, l.test, CASE WHEN s.status IN ('PASSED', 'XFAIL') THEN 1
                     WHEN s.status IS NULL OR s.status IN ('FAILED', 'ERROR') THEN 0 END AS ok
              FROM lists l LEFT JOIN last s ON l.instance_id = s.instance_id AND l.test = s.test AND s.run = 'clean'),
    graded AS (
        SELECT t.row_id, any_value(t.instance_id) AS instance_id,
               coalesce(list_sort(list(m.test) FILTER (m.g = 'f2p' AND ok = 1)), {_NONE}) AS f2p_success,
               coalesce(list_sort(list(m.test) FILTER (m.g = 'f2p' AND ok = 0)), {_NONE}) AS f2p_failure,
               coalesce(list_sort(list(m.test) FILTER (m.g = 'p2p' AND ok = 1)), {_NONE}) AS p2p_success,
               coalesce(list_sort(list(m.test) FILTER (m.g = 'p2p' AND ok = 0)), {_NONE}) AS p2p_failure,
               count(*) FILTER (ok = 0) = 0 AND count(*) FILTER (ok = 1) > 0 AS resolved
        FROM task_instances t LEFT JOIN marks m USING (row_id) GROUP BY t.row_id)
"""


def eval_summary(spark: SparkSession, folder: str) -> DataFrame:
    return status.eval_summary(T(spark, folder, "predictions"), eval_grading(spark, folder))


def trimmed_reports(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "test_status")
    report = status.transition_report(rows, "buggy", "clean")
    once = T(spark, folder, "task_instances").groupBy("instance_id").agg(F.min("row_id").alias("row_id"))
    gold = once.join(_gold(spark, folder).drop("instance_id"), "row_id")
    return status.without_failures(report, status.grade(gold, rows, "row_id", "buggy"))


def baseline_gate(spark: SparkSession, folder: str) -> DataFrame:
    return status.passing_repos(T(spark, folder, "test_status"), "clean")


def predictions_todo(spark: SparkSession, folder: str) -> DataFrame:
    done = T(spark, folder, "test_status").where("run = 'buggy'")
    return joins.todo(T(spark, folder, "predictions"), done, "instance_id").select("instance_id", "model_name_or_path")


def prediction_instances(spark: SparkSession, folder: str) -> DataFrame:
    instances = T(spark, folder, "task_instances").groupBy("instance_id").agg(F.min("row_id").alias("row_id"))
    found, missing = joins.matched(T(spark, folder, "predictions"), instances, "instance_id")
    none = F.lit(None).cast("bigint")
    both = found.select("instance_id", "row_id").unionByName(missing.select("instance_id", none.alias("row_id")))
    return both.groupBy("instance_id", "row_id").agg(F.count(F.lit(1)).alias("n"))


def gold_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return T(spark, folder, "task_instances").select(
        "row_id", "instance_id", F.col("patch").alias("model_patch"), F.lit("gold").alias("model_name_or_path")
    )


def validated_predictions(spark: SparkSession, folder: str) -> DataFrame:
    out = joins.validated(T(spark, folder, "predictions"), T(spark, folder, "task_instances"))
    return out.groupBy("model_name_or_path").agg(F.count(F.lit(1)).alias("n"))


def difficulty_left_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances").select("row_id", "instance_id")
    return joins.with_metadata(rows, T(spark, folder, "difficulties"), "instance_id")


def instance_glob_filter(spark: SparkSession, folder: str) -> DataFrame:
    globs = ["*.func_pm_*__[a-m]*", "*__*.core.????????.pr_*", "no such id"]
    rows = T(spark, folder, "task_instances").select("row_id", "instance_id")
    return rows.where(scalar.matches_any(F.col("instance_id"), globs))


def profile_lookup(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances").select("row_id", "repo", "instance_id")
    key = F.coalesce("repo", scalar.repo_part(F.col("instance_id")))
    return joins.profile_of(rows, T(spark, folder, "profiles"), key)


def patch_fallback(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances").select("instance_id", "patch").dropDuplicates(["instance_id", "patch"])
    first = rows.groupBy("instance_id").agg(F.min(F.nullif("patch", F.lit(""))).alias("patch"))
    p = T(spark, folder, "predictions").groupBy("instance_id").agg(F.min(F.nullif("model_patch", F.lit(""))).alias("model_patch"))
    both = first.join(p, "instance_id", "full_outer")
    return both.select(
        "instance_id",
        F.md5(F.coalesce("patch", "model_patch", F.lit(""))).alias("used"),
        F.length(F.concat_ws("\n", "model_patch", "patch")).alias("n_joined"),
    )


def status_diff(spark: SparkSession, folder: str) -> DataFrame:
    last = status.last_wins(T(spark, folder, "test_status"))
    side = lambda run: last.where(F.col("run") == run).drop("run")
    return joins.compared(side("buggy"), side("clean"), ["instance_id", "test"], "status")


def bug_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.type_counts(T(spark, folder, "task_instances"))


def repo_counts(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.repo_counts(T(spark, folder, "task_instances"))


def difficulty_score(spark: SparkSession, folder: str) -> DataFrame:
    labels = T(spark, folder, "difficulties").withColumn("difficulty", scores.merged_label(F.col("difficulty")))
    return scores.weighted_score(labels, "difficulty")


def label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.label_distribution(T(spark, folder, "difficulties"), "difficulty")


def rater_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    labels = T(spark, folder, "difficulties").select("instance_id", scores.merged_label(F.col("difficulty")).alias("truth"))
    size = F.length(F.coalesce("patch", F.lit("")))
    guess = F.when(size < 600, "<15 min fix").when(size < 900, "15 min - 1 hour").otherwise("1-4 hours")
    guesses = T(spark, folder, "task_instances").groupBy("instance_id").agg(F.min(guess).alias("guess"))
    return aggregates.accuracy(labels.join(guesses, "instance_id"), "truth", "guess", ("<15 min fix", "1-4 hours"))


def modifier_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances")
    return aggregates.modifier_stats(rows, F.size("FAIL_TO_PASS") > 0)


def repo_size_spread(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.spread(aggregates.repo_counts(T(spark, folder, "task_instances")), "n")


def patch_diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    out = diffs.diagnostics(T(spark, folder, "task_instances"))
    return out.select("row_id", "has_patch", "f2p_count", "p2p_count", "patch_files", "patch_marks")


def patch_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = diffs.patch_lines(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])
    return lines.select(
        "row_id", "new_path", "file_no", "hunk_no", "section", "line_no", "kind", "old_lineno", "new_lineno", "content"
    )


_LINES = r"""
    raw AS (SELECT row_id, unnest(string_split(patch, chr(10))) AS line, generate_subscripts(string_split(patch, chr(10)), 1) AS n
            FROM task_instances WHERE patch <> ''),
    filed AS (SELECT *, sum(CASE WHEN starts_with(line, 'diff --git a/') THEN 1 ELSE 0 END) OVER w AS f,
                     sum(CASE WHEN regexp_matches(line, '^@@ -\d+(,\d+)? \+\d+(,\d+)? @@') THEN 1 ELSE 0 END) OVER w AS h
              FROM raw WINDOW w AS (PARTITION BY row_id ORDER BY n)),
    heads AS (SELECT row_id, f, any_value(regexp_extract(line, ' b/(.*)$', 1)) AS new_path, min(h) AS before
              FROM filed WHERE starts_with(line, 'diff --git a/') GROUP BY 1, 2),
    hunks AS (SELECT row_id, h, CAST(regexp_extract(line, '^@@ -(\d+)', 1) AS INT) AS old_start,
                     CAST(coalesce(nullif(regexp_extract(line, '^@@ -\d+,(\d+)', 1), ''), '1') AS INT) AS old_lines,
                     CAST(regexp_extract(line, '\+(\d+)', 1) AS INT) AS new_start,
                     CAST(coalesce(nullif(regexp_extract(line, '\+\d+,(\d+)', 1), ''), '1') AS INT) AS new_lines,
                     trim(regexp_extract(line, '^@@[^@]*@@(.*)$', 1)) AS section
              FROM filed WHERE regexp_matches(line, '^@@ -\d+(,\d+)? \+\d+(,\d+)? @@')),
    body AS (SELECT b.row_id, b.f, b.h, b.n, b.line, CASE left(b.line, 1) WHEN '+' THEN 'addition' WHEN '-' THEN 'removal' ELSE 'context' END AS kind
             FROM filed b JOIN heads g ON b.row_id = g.row_id AND b.f = g.f
             WHERE b.h > g.before AND b.line <> '' AND NOT starts_with(b.line, '@@ -') AND NOT contains(b.line, '\ No newline at end of file')),
    lines AS (SELECT b.row_id, g.new_path, b.f - 1 AS file_no, b.h - g.before - 1 AS hunk_no, k.section,
                     row_number() OVER w - 1 AS line_no, b.kind,
                     CASE WHEN b.kind <> 'addition' THEN k.old_start + count(*) FILTER (b.kind <> 'addition') OVER w - 1 END AS old_lineno,
                     CASE WHEN b.kind <> 'removal' THEN k.new_start + count(*) FILTER (b.kind <> 'removal') OVER w - 1 END AS new_lineno,
                     CASE WHEN left(b.line, 1) IN ('+', '-', ' ') THEN substr(b.line, 2) ELSE b.line END AS content
              FROM body b JOIN heads g ON b.row_id = g.row_id AND b.f = g.f JOIN hunks k ON b.row_id = k.row_id AND b.h = k.h
              WINDOW w AS (PARTITION BY b.row_id, b.h ORDER BY b.n))
"""


def patch_hunks(spark: SparkSession, folder: str) -> DataFrame:
    hunks = diffs.patch_hunks(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])
    sound = (F.col("old_lines") == F.col("real_old")) & (F.col("new_lines") == F.col("real_new"))
    return hunks.groupBy("row_id").agg(
        F.count(F.lit(1)).alias("n_hunks"), F.count_if(sound).alias("n_sound"), F.sum("real_new").alias("n_new_lines")
    )


def patch_changes(spark: SparkSession, folder: str) -> DataFrame:
    rows = diffs.patch_summaries(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])
    return rows.select("row_id", "n_files", "n_hunks", "n_added", "n_removed", "places")


def changed_functions(spark: SparkSession, folder: str) -> DataFrame:
    return diffs.changed_functions(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])


def patch_inverted(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances").where("patch <> ''")
    return rows.select("row_id", F.md5(diffs.text_map(F.col("patch"), diffs.inverted)).alias("inverse"))


def patch_repaired(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "predictions").where("model_patch <> ''").select("model_patch").distinct()
    return rows.select(
        F.md5("model_patch").alias("patch_key"), diffs.text_map(F.col("model_patch"), diffs.repaired).alias("patch")
    )


def patch_test_parts(spark: SparkSession, folder: str) -> DataFrame:
    parts = diffs.split_tests(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])
    return parts.select("row_id", F.md5("fix").alias("fix"), F.md5("tests").alias("tests"))


def bug_kinds(spark: SparkSession, folder: str) -> DataFrame:
    rows = diffs.patch_summaries(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])
    return rows.select("row_id", scores.bug_kind(F.col("removed"), F.col("added")).alias("bug_kind"))


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances").where("patch is not null")
    parts = scores.quality(
        F.col("patch"), F.coalesce("problem_statement", F.lit("")), scalar.occurrences(F.col("patch"), "diff --git")
    )
    return rows.select("row_id", *(F.round(c, 4).alias(n) for n, c in parts.items()))


def challenging_patches(spark: SparkSession, folder: str) -> DataFrame:
    return T(spark, folder, "task_instances").where(scores.challenging(F.col("patch"))).select("row_id")


def pr_complexity(spark: SparkSession, folder: str) -> DataFrame:
    changed = scalar.occurrences(F.col("patch"), "\n+") + scalar.occurrences(F.col("patch"), "\n-")
    score = scores.complexity(
        scalar.occurrences(F.col("patch"), "diff --git"), changed, F.coalesce("problem_statement", F.lit("")),
        F.coalesce(F.array_size("FAIL_TO_PASS"), F.lit(0)),
    )
    scored = T(spark, folder, "task_instances").select("row_id", score.cast("int").alias("score"))
    return scored.withColumn("level", scores.level(F.col("score")))


def complexity_levels(spark: SparkSession, folder: str) -> DataFrame:
    return pr_complexity(spark, folder).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


def capped_predictions(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "predictions").select("instance_id", "model_name_or_path").distinct()
    return windows.cap_per_key(rows, "instance_id", 1, 24, ["instance_id", "model_name_or_path"])


def diverse_selection(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances").select("row_id", "repo").where("repo is not null")
    return windows.diverse(rows, "repo", 250, 42, ["row_id"])


def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    return windows.sample(T(spark, folder, "task_instances").select("row_id"), 100, 24, ["row_id"])


def split_train_test(spark: SparkSession, folder: str) -> DataFrame:
    return windows.split_by_hash(T(spark, folder, "task_instances").select("row_id"), 0.8, 42, ["row_id"])


def near_equal_parts(spark: SparkSession, folder: str) -> DataFrame:
    return windows.near_equal_parts(T(spark, folder, "task_instances").select("row_id"), 7, ["row_id"])


def chunk_groups(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "test_status").select("instance_id", "test").distinct()
    return windows.chunks(rows, "instance_id", ["test"], 4)


def template_choice(spark: SparkSession, folder: str) -> DataFrame:
    weights = {"basic": 5, "files": 10, "files_funcs": 15, "tests": 10, "tests_f2p": 10, "type": 5, "type_files": 15,
               "type_files_tests": 15, "type_files_funcs_tests": 15}
    rows = T(spark, folder, "task_instances").select("row_id")
    return windows.weighted_choice(rows, weights, 24, ["row_id"], "template")


def failing_streak(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "test_status").select("instance_id", "run", "pos", "test", "status").distinct()
    keyed = rows.withColumn("g", F.concat_ws("|", "instance_id", "run"))
    kept = windows.prefix_until(keyed, "g", ["pos", "test", "status"], F.col("status") == "PASSED")
    return kept.groupBy("instance_id", "run").agg(F.count(F.lit(1)).alias("n"))


def last_failure(spark: SparkSession, folder: str) -> DataFrame:
    last = F.struct("pos", "status")
    rows = T(spark, folder, "test_status").groupBy("instance_id", "run", "pos", "test").agg(F.max(last)["status"].alias("status"))
    rows = rows.withColumn("g", F.concat_ws("|", "instance_id", "run")).withColumn("o", F.struct("pos", "test"))
    failed = F.when(F.col("status") == "FAILED", F.col("test"))
    out = windows.carry_forward(rows, "g", "o", failed, "last_failed")
    return out.select("instance_id", "run", "pos", "test", "last_failed")


def status_changes(spark: SparkSession, folder: str) -> DataFrame:
    last = status.last_wins(T(spark, folder, "test_status").where("status is not null"))
    rows = last.withColumn("g", F.concat_ws("|", "instance_id", "run"))
    out = windows.previous(rows, "g", "test", "status", "before")
    return out.where("before <> status").groupBy("instance_id", "run").agg(F.count(F.lit(1)).alias("n"))


def _windows_of(spark: SparkSession, folder: str) -> DataFrame:
    hunks = diffs.patch_hunks(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])
    path = F.concat_ws("|", F.col("row_id").cast("string"), "new_path")
    return hunks.select(
        path.alias("file"), F.concat_ws(":", "file_no", "hunk_no").alias("hunk"),
        F.greatest(F.col("old_start") - 200, F.lit(0)).alias("s"), (F.col("old_start") + 200).alias("e"),
    )


def hunk_windows(spark: SparkSession, folder: str) -> DataFrame:
    return windows.merged_intervals(_windows_of(spark, folder), "file", "s", "e")


def hunk_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return windows.overlapping_pairs(_windows_of(spark, folder), "file", "hunk", "s", "e", 400)


def disjoint_hunks(spark: SparkSession, folder: str) -> DataFrame:
    return windows.disjoint_ranges(_windows_of(spark, folder), "file", "hunk", "s", "e")


def module_groups(spark: SparkSession, folder: str) -> DataFrame:
    lines = diffs.patch_hunks(T(spark, folder, "task_instances").select("row_id", "instance_id", "patch"), ["row_id", "instance_id"])
    files = lines.select("row_id", scalar.repo_part(F.col("instance_id")).alias("repo_key"), "new_path").distinct()
    return aggregates.module_groups(files, "row_id", "new_path", 1)


def patch_pairs(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances").where("patch <> ''").select(scalar.repo_part(F.col("instance_id")).alias("repo_key"), "row_id")
    return windows.capped_combinations(rows, "repo_key", "row_id", 2, 20)


def incremental_status(spark: SparkSession, folder: str) -> DataFrame:
    from ..streaming.incremental import counts_by_increments

    return counts_by_increments(spark, f"{folder}/test_status.parquet")


def tests_per_instance_run(spark: SparkSession, folder: str) -> DataFrame:
    last = status.last_wins(T(spark, folder, "test_status"))
    by = last.groupBy("instance_id").pivot("run", ["clean", "buggy"]).agg(F.count_if(F.col("status") == "PASSED"))
    return by.select("instance_id", F.coalesce("clean", F.lit(0)).alias("clean"), F.coalesce("buggy", F.lit(0)).alias("buggy"))


def latest_instance(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances").select("row_id", "instance_id", "collected_at", "image_name")
    w = Window.partitionBy("instance_id").orderBy(F.desc_nulls_last("collected_at"), F.desc("row_id"))
    last = rows.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    return last.withColumn("image_name", F.regexp_replace("image_name", r"\.(x86_64|arm64)", ""))


_MODIFIER = r"regexp_extract(CASE WHEN contains(instance_id, '__') THEN regexp_replace(instance_id, '^(.*)__.*$', '\1') ELSE instance_id END, '([^.]*)$', 1)"
_HASH = "md5(concat_ws('|', '{0}', {1}))"
_UNIT = "(('0x' || substr(md5(concat_ws('|', '{0}', {1})), 1, 7))::BIGINT / 268435456.0)"
_CHANGED = "(length(patch) - length(replace(patch, chr(10) || '+', '')) + length(patch) - length(replace(patch, chr(10) || '-', ''))) // 2"
_FILES = "(length(patch) - length(replace(patch, 'diff --git', ''))) // 10"


def _contains_any(column: str, pieces: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in pieces) + ")"


def _swap(*pairs: tuple[str, str]) -> str:
    return "(" + " OR ".join(
        f"(contains(o, '{a}') AND contains(w, '{b}')) OR (contains(o, '{b}') AND contains(w, '{a}'))" for a, b in pairs
    ) + ")"


_WINDOWS = r"""
    WITH raw AS (SELECT row_id, unnest(string_split(patch, chr(10))) AS line, generate_subscripts(string_split(patch, chr(10)), 1) AS n
                 FROM task_instances WHERE patch <> ''),
    filed AS (SELECT *, sum(CASE WHEN starts_with(line, 'diff --git a/') THEN 1 ELSE 0 END) OVER w AS f,
                     sum(CASE WHEN starts_with(line, '@@ -') THEN 1 ELSE 0 END) OVER w AS h
              FROM raw WINDOW w AS (PARTITION BY row_id ORDER BY n)),
    heads AS (SELECT row_id, f, any_value(regexp_extract(line, ' b/(.*)$', 1)) AS new_path, min(h) AS before
              FROM filed WHERE starts_with(line, 'diff --git a/') GROUP BY 1, 2),
    spans AS (SELECT x.row_id || '|' || g.new_path AS file, (x.f - 1) || ':' || (x.h - g.before - 1) AS hunk,
                     greatest(CAST(regexp_extract(line, '^@@ -(\d+)', 1) AS INT) - 200, 0) AS s,
                     CAST(regexp_extract(line, '^@@ -(\d+)', 1) AS INT) + 200 AS e
              FROM filed x JOIN heads g ON x.row_id = g.row_id AND x.f = g.f WHERE starts_with(line, '@@ -'))
"""

SQL = {
    "status_last_wins": f"WITH {_LAST} SELECT * FROM last",
    "transition_report": f"WITH {_TRANSITIONS} SELECT * EXCLUDE (timed_out) FROM reports",
    "validation_outcomes": f"""WITH {_TRANSITIONS} SELECT count(*) AS n_reports, count(*) FILTER (timed_out) AS n_timed_out,
        count(*) FILTER (NOT timed_out AND len(FAIL_TO_PASS) > 0) AS n_some,
        count(*) FILTER (NOT timed_out AND len(FAIL_TO_PASS) = 0) AS n_none FROM reports""",
    "gather_tasks": f"""WITH {_TRANSITIONS} SELECT r.instance_id, {_REPO.replace("instance_id", "r.instance_id")} AS repo_key, t.patch, r.FAIL_TO_PASS, r.PASS_TO_PASS
        FROM reports r JOIN (SELECT DISTINCT instance_id, patch FROM task_instances WHERE patch IS NOT NULL) t ON r.instance_id = t.instance_id
        WHERE NOT ends_with(r.instance_id, '.ref') AND len(r.FAIL_TO_PASS) > 0 AND (
            (contains(r.instance_id, '.pr_') AND len(r.PASS_TO_PASS) = 0) OR (NOT timed_out AND len(r.PASS_TO_PASS) > 0))""",
    "eval_grading": f"WITH {_GRADED} SELECT * FROM graded",
    "eval_summary": f"""WITH {_GRADED}, best AS (SELECT instance_id, bool_or(resolved) AS resolved FROM graded GROUP BY 1)
        SELECT count(*) AS total, count(*) FILTER (coalesce(resolved, false)) AS n_resolved,
               count(*) FILTER (NOT coalesce(resolved, false)) AS n_unresolved, count(*) FILTER (resolved IS NULL) AS n_ungraded
        FROM (SELECT DISTINCT instance_id FROM predictions) LEFT JOIN best USING (instance_id)""",
    "baseline_gate": f"""WITH {_LAST} SELECT {_REPO} AS repo_key, count(*) FILTER (status = 'PASSED') AS n_passed
        FROM last WHERE run = 'clean' GROUP BY 1 HAVING count(*) FILTER (status = 'PASSED') > 0""",
    "predictions_todo": """SELECT instance_id, model_name_or_path FROM predictions p
        WHERE NOT EXISTS (SELECT 1 FROM test_status s WHERE s.run = 'buggy' AND s.instance_id = p.instance_id)""",
    "prediction_instances": """SELECT p.instance_id, i.row_id, count(*) AS n FROM predictions p
        LEFT JOIN (SELECT instance_id, min(row_id) AS row_id FROM task_instances GROUP BY 1) i USING (instance_id) GROUP BY 1, 2""",
    "gold_predictions": "SELECT row_id, instance_id, patch AS model_patch, 'gold' AS model_name_or_path FROM task_instances",
    "validated_predictions": """SELECT model_name_or_path, count(*) AS n FROM predictions
        WHERE instance_id IN (SELECT instance_id FROM task_instances) GROUP BY 1""",
    "difficulty_left_join": "SELECT t.row_id, t.instance_id, d.difficulty FROM task_instances t LEFT JOIN difficulties d USING (instance_id)",
    "instance_glob_filter": r"""SELECT row_id, instance_id FROM task_instances
        WHERE regexp_matches(instance_id, '^.*\.func_pm_.*__[a-m].*$') OR regexp_matches(instance_id, '^.*__.*\.core\.........\.pr_.*$')""",
    "profile_lookup": f"""SELECT t.row_id, t.repo, t.instance_id, p.mirror_name AS profile_mirror_name, p.owner AS profile_owner,
               p.repo AS profile_repo, p.commit_sha AS profile_commit_sha
        FROM task_instances t LEFT JOIN profiles p
        ON coalesce(t.repo, {_REPO.replace("instance_id", "t.instance_id")}) IN (p.mirror_name, p.repo_name)""",
    "patch_fallback": """SELECT instance_id, md5(coalesce(patch, model_patch, '')) AS used,
               length(concat_ws(chr(10), model_patch, patch))::INT AS n_joined
        FROM (SELECT instance_id, min(nullif(patch, '')) AS patch FROM task_instances GROUP BY 1)
        FULL JOIN (SELECT instance_id, min(nullif(model_patch, '')) AS model_patch FROM predictions GROUP BY 1) USING (instance_id)""",
    "status_diff": f"""WITH {_LAST}, b AS (SELECT * FROM last WHERE run = 'buggy'), c AS (SELECT * FROM last WHERE run = 'clean')
        SELECT coalesce(b.instance_id, c.instance_id) AS instance_id, coalesce(b.test, c.test) AS test,
               CASE WHEN b.test IS NULL THEN 'added' WHEN c.test IS NULL THEN 'removed' ELSE 'modified' END AS status,
               b.status AS before, c.status AS after
        FROM b FULL JOIN c ON b.instance_id = c.instance_id AND b.test = c.test
        WHERE b.test IS NULL OR c.test IS NULL OR b.status IS DISTINCT FROM c.status""",
    "bug_type_counts": f"SELECT {_BUG_TYPE} AS bug_type, count(*) AS n FROM task_instances GROUP BY 1",
    "repo_counts": f"SELECT {_REPO} AS repo_key, count(*) AS n FROM task_instances GROUP BY 1",
    "difficulty_score": """WITH d AS (SELECT CASE difficulty WHEN '>4 hours' THEN '1-4 hours' ELSE difficulty END AS l FROM difficulties),
        v AS (SELECT l, CASE l WHEN '<15 min fix' THEN 1 WHEN '15 min - 1 hour' THEN 5 WHEN '1-4 hours' THEN 9 END AS w FROM d)
        SELECT count(*) AS n_instances, count(w) AS n_rated, count(*) FILTER (w = 1) AS n_easy, count(*) FILTER (w = 5) AS n_medium,
               count(*) FILTER (w = 9) AS n_hard, round(sum(w) / count(w), 3) AS score FROM v""",
    "label_distribution": """SELECT difficulty AS label, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM difficulties), 2) AS pct
        FROM difficulties GROUP BY 1""",
    "rater_accuracy": """WITH g AS (SELECT instance_id, min(CASE WHEN length(coalesce(patch, '')) < 600 THEN '<15 min fix'
               WHEN length(coalesce(patch, '')) < 900 THEN '15 min - 1 hour' ELSE '1-4 hours' END) AS guess FROM task_instances GROUP BY 1),
        b AS (SELECT CASE difficulty WHEN '>4 hours' THEN '1-4 hours' ELSE difficulty END AS truth, guess
              FROM difficulties JOIN g USING (instance_id) WHERE difficulty IS NOT NULL)
        SELECT count(*) AS n, round(avg((truth = guess)::INT), 6) AS accuracy,
               count(*) FILTER ((truth = '<15 min fix' AND guess = '1-4 hours') OR (truth = '1-4 hours' AND guess = '<15 min fix')) AS n_extreme FROM b""",
    "modifier_rollup": f"""WITH b AS (SELECT {_REPO} AS repo_key, {_MODIFIER} AS modifier, coalesce(len(FAIL_TO_PASS) > 0, false) AS ok FROM task_instances)
        SELECT repo_key, modifier, count(*) AS n_generated, count(*) FILTER (ok) AS n_valid,
               round(count(*) FILTER (ok) * 100.0::DOUBLE / count(*), 2) AS pct,
               CASE grouping(repo_key, modifier) WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS level
        FROM b GROUP BY ROLLUP (repo_key, modifier)""",
    "repo_size_spread": f"""WITH c AS (SELECT {_REPO} AS k, count(*) AS v FROM task_instances GROUP BY 1)
        SELECT count(v) AS n, round(avg(v), 6) AS mean, round(coalesce(stddev_samp(v), 0), 6) AS std, min(v) AS least,
               median(v) AS median, max(v) AS greatest FROM c""",
    "patch_diagnostics": r"""SELECT row_id, trim(coalesce(patch, '')) <> '' AS has_patch,
               coalesce(len(FAIL_TO_PASS), 0)::INT AS f2p_count, coalesce(len(PASS_TO_PASS), 0)::INT AS p2p_count,
               len(regexp_extract_all(coalesce(patch, ''), '(?m)^diff --git'))::INT AS patch_files,
               len(regexp_extract_all(coalesce(patch, ''), '@@'))::INT AS patch_marks FROM task_instances""",
    "patch_lines": f"""WITH {_LINES} SELECT row_id, new_path, file_no::INT AS file_no, hunk_no::INT AS hunk_no, section, line_no::INT AS line_no,
        kind, old_lineno::INT AS old_lineno, new_lineno::INT AS new_lineno, content FROM lines""",
    "patch_hunks": f"""WITH {_LINES}, real AS (SELECT row_id, h, count(*) FILTER (kind <> 'addition') AS o, count(*) FILTER (kind <> 'removal') AS w
        FROM body GROUP BY 1, 2)
        SELECT k.row_id, count(*) AS n_hunks, count(*) FILTER (coalesce(o, 0) = old_lines AND coalesce(w, 0) = new_lines) AS n_sound,
               coalesce(sum(w), 0)::BIGINT AS n_new_lines FROM hunks k LEFT JOIN real r ON k.row_id = r.row_id AND k.h = r.h GROUP BY 1""",
    "patch_changes": f"""WITH {_LINES} SELECT row_id, count(DISTINCT new_path) AS n_files, count(DISTINCT (file_no, hunk_no)) AS n_hunks,
        count(*) FILTER (kind = 'addition') AS n_added, count(*) FILTER (kind = 'removal') AS n_removed,
        list_sort(list(DISTINCT new_path || ':' || hunk_no)) AS places FROM lines GROUP BY 1""",
    "changed_functions": f"""WITH {_LINES} SELECT row_id, list_sort(list(DISTINCT section)) AS functions FROM lines
        WHERE kind <> 'context' AND section <> '' GROUP BY 1""",
    "bug_kinds": f"""WITH {_LINES}, t AS (SELECT row_id, coalesce(string_agg(content, ' ' ORDER BY file_no, hunk_no, line_no) FILTER (kind = 'removal'), '') AS o,
               coalesce(string_agg(content, ' ' ORDER BY file_no, hunk_no, line_no) FILTER (kind = 'addition'), '') AS w FROM lines GROUP BY 1)
        SELECT row_id, CASE WHEN {_swap(("==", "!="), (">", "<"), (">=", "<="))} THEN 'comparison_flip' WHEN {_swap(("&&", "||"))} THEN 'logic_swap'
          WHEN {_swap(("<", "<="))} THEN 'off_by_one' WHEN {_swap(("+", "-"), ("*", "/"), ("&", "|"))} THEN 'operator_change'
          WHEN {_contains_any("o", ["?", ".map_err(", ".ok_or(", "return Err"])} AND NOT {_contains_any("w", ["?", ".map_err(", ".ok_or(", "return Err"])} THEN 'missing_error_handling'
          WHEN {_contains_any("o", ["if ", ".is_none()", ".is_some()", ".is_empty()", "assert"])} AND NOT {_contains_any("w", ["if ", ".is_none()", ".is_some()", ".is_empty()", "assert"])} THEN 'missing_validation'
          WHEN {_contains_any("o", ["if ", "guard", "check", "validate", "verify"])} AND NOT {_contains_any("w", ["if ", "guard", "check", "validate"])} THEN 'removed_guard'
          ELSE 'unknown' END AS bug_kind FROM t""",
    "challenging_patches": f"""SELECT row_id FROM task_instances WHERE {_CHANGED} BETWEEN 3 AND 20
        AND {_contains_any("patch", ["if ", "for ", "while ", "try:", "return ", "yield ", "raise ", "except"])}""",
    "pr_complexity": f"""WITH s AS (SELECT row_id, (least(coalesce({_FILES}, 0), 5) * 2 + least(coalesce({_CHANGED}, 0) // 50, 10) + least({" + ".join(
        f"CASE WHEN {_contains_any("lower(coalesce(problem_statement, ''))", sorted({w, w.replace("_", " ")}))} THEN {p} ELSE 0 END"
        for w, p in scores.COMPLEXITY_WORDS.items())}, 15) + CASE WHEN coalesce(len(FAIL_TO_PASS), 0) >= 5 THEN 2 ELSE 0 END)::INT AS score FROM task_instances)
        SELECT row_id, score, CASE WHEN score >= 20 THEN 'expert' WHEN score >= 10 THEN 'hard' WHEN score >= 5 THEN 'medium' ELSE 'simple' END AS level FROM s""",
    "trimmed_reports": f"""WITH {_TRANSITIONS}, once AS (SELECT instance_id, min(row_id) AS row_id FROM task_instances GROUP BY 1),
        lists AS (SELECT t.instance_id, unnest(t.FAIL_TO_PASS) AS test, 'f' AS g FROM task_instances t JOIN once USING (row_id)
                  UNION ALL SELECT t.instance_id, unnest(t.PASS_TO_PASS), 'p' FROM task_instances t JOIN once USING (row_id)),
        bad AS (SELECT l.instance_id, l.g, l.test FROM lists l LEFT JOIN last s ON s.instance_id = l.instance_id AND s.test = l.test AND s.run = 'buggy'
                WHERE s.status IS NULL OR s.status IN ('FAILED', 'ERROR')),
        drops AS (SELECT o.instance_id, coalesce(list(b.test) FILTER (b.g = 'f'), {_NONE}) AS f, coalesce(list(b.test) FILTER (b.g = 'p'), {_NONE}) AS p
                  FROM once o LEFT JOIN bad b USING (instance_id) GROUP BY 1)
        SELECT r.instance_id, list_filter(FAIL_TO_PASS, lambda x: NOT list_contains(d.f, x)) AS FAIL_TO_PASS,
               list_filter(PASS_TO_PASS, lambda x: NOT list_contains(d.p, x)) AS PASS_TO_PASS
        FROM reports r JOIN drops d ON r.instance_id = d.instance_id""",
    "capped_predictions": f"""SELECT instance_id, model_name_or_path FROM (SELECT *, row_number() OVER (PARTITION BY instance_id
        ORDER BY {_HASH.format(24, "instance_id, model_name_or_path")}) AS r FROM (SELECT DISTINCT instance_id, model_name_or_path FROM predictions)) WHERE r = 1""",
    "diverse_selection": f"""WITH r AS (SELECT row_id, repo, {_HASH.format(42, "row_id")} AS h, row_number() OVER (PARTITION BY repo ORDER BY {_HASH.format(42, "row_id")}, row_id) AS n
        FROM task_instances WHERE repo IS NOT NULL) SELECT row_id, repo FROM r ORDER BY n > 1, h, row_id LIMIT 250""",
    "hash_sample": f"SELECT row_id FROM task_instances ORDER BY {_HASH.format(24, 'row_id')}, row_id LIMIT 100",
    "split_train_test": f"SELECT row_id, CASE WHEN {_UNIT.format(42, 'row_id')} < 0.8 THEN 'train' ELSE 'test' END AS split FROM task_instances",
    "near_equal_parts": "SELECT row_id, (ntile(7) OVER (ORDER BY row_id))::INT AS part FROM task_instances",
    "chunk_groups": """SELECT instance_id, test, ((row_number() OVER (PARTITION BY instance_id ORDER BY test) - 1) // 4)::INT AS chunk
        FROM (SELECT DISTINCT instance_id, test FROM test_status)""",
    "template_choice": f"""SELECT row_id, CASE WHEN u < 5 THEN 'basic' WHEN u < 15 THEN 'files' WHEN u < 30 THEN 'files_funcs' WHEN u < 40 THEN 'tests'
        WHEN u < 50 THEN 'tests_f2p' WHEN u < 55 THEN 'type' WHEN u < 70 THEN 'type_files' WHEN u < 85 THEN 'type_files_tests' ELSE 'type_files_funcs_tests' END AS template
        FROM (SELECT row_id, {_UNIT.format(24, "row_id")} * 100 AS u FROM task_instances)""",
    "failing_streak": """WITH d AS (SELECT DISTINCT instance_id, run, pos, test, status FROM test_status),
        m AS (SELECT *, max(CASE WHEN status = 'PASSED' THEN 0 ELSE 1 END) OVER (PARTITION BY instance_id, run ORDER BY pos, test, status NULLS FIRST
              ROWS UNBOUNDED PRECEDING) AS broken FROM d) SELECT instance_id, run, count(*) AS n FROM m WHERE broken = 0 GROUP BY 1, 2""",
    "last_failure": """WITH d AS (SELECT instance_id, run, pos, test, max(status) AS status FROM test_status GROUP BY ALL)
        SELECT instance_id, run, pos, test, last_value(CASE WHEN status = 'FAILED' THEN test END IGNORE NULLS) OVER (
            PARTITION BY instance_id, run ORDER BY pos, test ROWS UNBOUNDED PRECEDING) AS last_failed FROM d""",
    "status_changes": f"""WITH {_LAST.replace("FROM test_status)", "FROM test_status WHERE status IS NOT NULL)")}, p AS (SELECT *, lag(status) OVER (PARTITION BY instance_id, run ORDER BY test) AS before FROM last)
        SELECT instance_id, run, count(*) AS n FROM p WHERE before <> status GROUP BY 1, 2""",
    "hunk_windows": f"""{_WINDOWS}, m AS (SELECT *, max(e) OVER (PARTITION BY file ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
        i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m)
        SELECT file, min(s) AS first, max(e) AS last, count(*) AS n FROM i GROUP BY file, island""",
    "hunk_overlaps": f"""{_WINDOWS} SELECT a.file, a.hunk AS key_a, b.hunk AS key_b FROM spans a JOIN spans b
        ON a.file = b.file AND a.hunk < b.hunk AND a.s <= b.e AND b.s <= a.e""",
    "module_groups": f"""WITH {_LINES}, fs AS (SELECT DISTINCT t.row_id, {_REPO.replace("instance_id", "t.instance_id")} AS repo_key, l.new_path
            FROM lines l JOIN task_instances t USING (row_id)),
        g AS (SELECT repo_key, split_part(regexp_replace(new_path, '/[^/]*$', ''), '/', 1) AS module, count(DISTINCT row_id) AS n_patches,
              list_sort(list(DISTINCT new_path)) AS paths FROM fs WHERE contains(new_path, '/') GROUP BY 1, 2)
        SELECT * FROM g WHERE len(paths) > 1""",
    "patch_pairs": f"""WITH r AS (SELECT DISTINCT {_REPO} AS repo_key, row_id FROM task_instances WHERE patch <> ''),
        p AS (SELECT a.repo_key, [a.row_id, b.row_id] AS combo, row_number() OVER (PARTITION BY a.repo_key ORDER BY a.row_id, b.row_id) AS n
              FROM r a JOIN r b ON a.repo_key = b.repo_key AND a.row_id < b.row_id)
        SELECT repo_key, combo FROM p WHERE n <= 20""",
    "disjoint_hunks": f"""{_WINDOWS}, l AS (SELECT file, list_transform(list({{'hunk': hunk, 's': s, 'e': e}} ORDER BY hunk, s, e), lambda x: [x]) AS l FROM spans GROUP BY 1),
        k AS (SELECT file, unnest(list_reduce(l, lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: k.s <= x[1].e AND x[1].s <= k.e)) > 0 THEN acc ELSE list_concat(acc, x) END)) AS k FROM l)
        SELECT file, k.hunk AS hunk, k.s AS s, k.e AS e FROM k""",
    "training_rows": f"""WITH {_GRADED}, once AS (SELECT instance_id, min(row_id) AS row_id FROM task_instances GROUP BY 1)
        SELECT o.instance_id, g.resolved, md5(coalesce(p.model_patch, '')) AS patch FROM once o JOIN graded g USING (row_id)
        LEFT JOIN (SELECT instance_id, max(model_patch) AS model_patch FROM predictions GROUP BY 1) p ON p.instance_id = o.instance_id""",
    "incremental_status": "SELECT run, status, count(*) AS n FROM test_status GROUP BY 1, 2",
    "tests_per_instance_run": f"""WITH {_LAST} SELECT instance_id, count(*) FILTER (run = 'clean' AND status = 'PASSED') AS clean,
        count(*) FILTER (run = 'buggy' AND status = 'PASSED') AS buggy FROM last GROUP BY 1""",
    "latest_instance": r"""SELECT row_id, instance_id, collected_at, regexp_replace(image_name, '\.(x86_64|arm64)', '') AS image_name
        FROM (SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY collected_at DESC NULLS LAST, row_id DESC) AS r FROM task_instances) WHERE r = 1""",
}

SQL["complexity_levels"] = f"SELECT level, count(*) AS n FROM ({SQL['pr_complexity']}) GROUP BY 1"

QUERIES = (
    status_last_wins, transition_report, validation_outcomes, gather_tasks, eval_grading, eval_summary, trimmed_reports,
    baseline_gate, predictions_todo, prediction_instances, gold_predictions, validated_predictions, difficulty_left_join,
    instance_glob_filter, profile_lookup, patch_fallback, status_diff, bug_type_counts, repo_counts, difficulty_score,
    label_distribution, rater_accuracy, modifier_rollup, repo_size_spread, patch_diagnostics, patch_lines, patch_hunks,
    patch_changes, changed_functions, patch_inverted, patch_repaired, patch_test_parts, bug_kinds, quality_scores,
    challenging_patches, pr_complexity, complexity_levels, capped_predictions, diverse_selection, hash_sample,
    split_train_test, near_equal_parts, chunk_groups, template_choice, failing_streak, last_failure, status_changes,
    hunk_windows, hunk_overlaps, disjoint_hunks, module_groups, patch_pairs, incremental_status, tests_per_instance_run,
    latest_instance,
)
