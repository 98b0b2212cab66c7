"""Queries over patches as text, trajectories, scans and small selections, each with its SQL where SQL can express it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import aggregates, diffs, graph, joins, scores, semantics, trajectories
from ..session import checkpoint_dir, table
from ..sources import readers, sinks
from . import texts

T = table

# --- patches as text ----------------------------------------------------------------------------------


def patch_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Twice inverted, a patch is itself, with its counts written out."""
    rows = T(spark, folder, "task_instances").where("patch <> ''")
    twice = diffs.text_map(F.col("patch"), lambda p: diffs.inverted(diffs.inverted(p)))
    return rows.select("row_id", F.md5(twice).alias("patch"))


def hunk_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The change of every meaningful hunk, by its number among them, and the item that its own lines declare."""
    rows = semantics.semantic_changes(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])
    number = F.row_number().over(Window.partitionBy("row_id").orderBy("file_no", "hunk_no")) - 1
    return rows.select("row_id", number.alias("hunk"), "change", F.when(F.col("declared"), F.col("item")).alias("declared"))


def task_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Task rows for groups of at most three changes of a patch, with their number and what they change."""
    hunks = diffs.patch_hunks(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])
    change = F.when(F.col("old_lines") == 0, "added").when(F.col("new_lines") == 0, "removed").otherwise("modified")
    place = F.concat_ws(":", "new_path", "new_start")
    return aggregates.unified_tasks(hunks.select("row_id", "file_no", "hunk_no", "new_path", place.alias("place"), change.alias("change")), "row_id", ["file_no", "hunk_no"], 3)


def similarity_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.similarity_statistics(_similarities(spark, folder), "similarity", "size_difference")


def worst_similarities(spark: SparkSession, folder: str) -> DataFrame:
    """The ten predictions least like their patch (a top-k report)."""
    rows = _similarities(spark, folder)
    return rows.select("instance_id", "model", F.round("similarity", 6).alias("similarity")).orderBy("similarity", "instance_id", "model").limit(10)


def accepted_similarities(spark: SparkSession, folder: str) -> DataFrame:
    """How many predictions of each model are at least half like the patch."""
    rows = _similarities(spark, folder)
    return rows.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("similarity") >= 0.5).alias("n_accepted"))


def _similarities(spark: SparkSession, folder: str) -> DataFrame:
    gold = T(spark, folder, "task_instances").groupBy("instance_id").agg(F.max("patch").alias("patch"))
    rows = T(spark, folder, "predictions").where("model_patch <> ''").join(gold.where("patch <> ''"), "instance_id")
    rows = rows.select("instance_id", F.col("model_name_or_path").alias("model"), "model_patch", "patch").distinct()
    ratio, size = diffs.similarity(F.col("model_patch"), F.col("patch")), F.abs(F.length("model_patch") - F.length("patch"))
    return rows.select("instance_id", "model", ratio.alias("similarity"), size.alias("size_difference"))


# --- selections ----------------------------------------------------------------------------------------


def pull_subset(spark: SparkSession, folder: str) -> DataFrame:
    """Instances made from pull requests that break two to five tests."""
    n = F.size("FAIL_TO_PASS")
    return T(spark, folder, "task_instances").where(F.contains("instance_id", F.lit(".pr_")) & n.between(2, 5)).select("row_id", "instance_id")


def accepted_qualities(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances").where("patch is not null")
    parts = scores.quality(F.col("patch"), F.coalesce("problem_statement", F.lit("")), scalar.occurrences(F.col("patch"), "diff --git"))
    return rows.where(F.round(parts["overall"], 4) >= 0.6).select("row_id")


def function_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Functions worth changing: long enough, no accessor, constructor or test, and with something in them."""
    blocks = T(spark, folder, "documents").where("kind = 'source'").select("doc_id", F.posexplode(F.split("text", "\n\n")).alias("n", "body"))
    name = F.regexp_extract("body", texts.HEAD, 1)
    calls = F.regexp_count("body", F.lit(r"[.]\w+\("))
    return graph.targets(blocks.select("doc_id", "n", name.alias("name"), "body", calls.alias("n_calls"))).select("doc_id", "n", "name")


def original_statements(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions with the statement of their instance; those whose statement is blank drop out."""
    rows = T(spark, folder, "task_instances").groupBy("instance_id").agg(F.min_by("problem_statement", "row_id").alias("statement"))
    own = T(spark, folder, "predictions").select("instance_id", "model_name_or_path").distinct()
    met = own.join(rows.where(F.trim("statement") != ""), "instance_id")
    return met.select("instance_id", "model_name_or_path", F.md5("statement").alias("statement"))


def first_responses(spark: SparkSession, folder: str) -> DataFrame:
    """The first response of each model to an instance, of an array by model."""
    of = T(spark, folder, "predictions").where("model_patch <> ''").groupBy("instance_id", "model_name_or_path").agg(F.array_sort(F.collect_list("model_patch")).alias("responses"))
    ids = T(spark, folder, "task_instances").select("instance_id").distinct()
    return ids.join(of, "instance_id").select("instance_id", "model_name_or_path", F.md5(F.get("responses", F.lit(0))).alias("response"))


def stage_failures(spark: SparkSession, folder: str) -> DataFrame:
    """How often each stage failed, and how."""
    rows = T(spark, folder, "test_status").where("status in ('FAILED', 'ERROR')")
    return rows.groupBy("run", "status").agg(F.count(F.lit(1)).alias("n"))


def suffix_tests(spark: SparkSession, folder: str) -> DataFrame:
    """Test files that share the base name of a file elsewhere."""
    tests = T(spark, folder, "test_status").select(F.substring_index("test", "::", 1).alias("test_path")).where("test_path like '%/%'").distinct()
    paths = tests.select(F.concat(F.lit("other/"), F.regexp_extract("test_path", "([^/]*)$", 1)).alias("path")).distinct()
    return joins.tests_by_suffix(paths, tests)


def nested_grades(spark: SparkSession, folder: str) -> DataFrame:
    """A flag stored under an id in some records and at the top in others."""
    runs = T(spark, folder, "run_outputs").select("output_id", "run", (F.length("output") > 100).alias("long"))
    split = runs.select("output_id", F.when(F.col("run") == "gold", F.col("long")).alias("nested"), F.when(F.col("run") == "clean", F.col("long")).alias("flat"))
    return split.select("output_id", joins.nested_or_flat(F.col("nested"), F.col("flat")).alias("flag"))


def union_once(spark: SparkSession, folder: str) -> DataFrame:
    """Instances of both tables, whose ids must not repeat."""
    own = T(spark, folder, "task_instances").groupBy("instance_id").agg(F.max("repo").alias("repo"))
    return joins.unique_union([own, T(spark, folder, "eval_instances").select("instance_id", "repo")], ["instance_id"])


# --- trajectories ---------------------------------------------------------------------------------------


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    """(row_id, text): a recorded run for every statement: what it was asked, what it thought and did, and what came back."""
    rows = T(spark, folder, "task_instances").where("problem_statement is not null")
    message = lambda role, **parts: F.struct(F.lit(role).alias("role"), *(
        (parts[k] if k in parts else F.lit(None).cast("string")).alias(k) for k in ("content", "thought", "action")
    ))
    asked, patch = F.col("problem_statement"), F.coalesce("patch", F.lit(""))
    messages = F.array(
        message("system", content=F.lit("You fix bugs.")), message("user", content=asked),
        message("assistant", content=patch, thought=F.concat(F.lit("Look at "), "instance_id"), action=patch),
        message("tool", content=F.concat(F.lit("done "), F.col("row_id"))),
    )
    last = F.struct(F.lit("Exit due to cost limit").alias("response"), F.array(message("user", content=F.lit("late"))).alias("query"))
    first = F.struct(F.lit("ok").alias("response"), messages.alias("query"))
    return rows.select("row_id", F.to_json(F.struct(F.array(first, last).alias("trajectory"))).alias("text"))


def _styled(style: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        got = trajectories.messages_of(_runs(spark, folder), ["row_id"], "text", style, system="You are careful." if style == "xml" else None)
        return got.select("row_id", F.md5(trajectories.chat_text(F.col("messages"))).alias("chat"), "error")

    query.__name__ = f"sft_{style}"
    query.__doc__ = f"Recorded runs as messages in the style {style}."
    return query


def sft_training_set(spark: SparkSession, folder: str) -> DataFrame:
    """At most two runs an instance of two collections, in hash order."""
    rows = T(spark, folder, "task_instances").select("instance_id", F.col("row_id").cast("string").alias("traj_id"))
    other = rows.select("instance_id", F.concat("traj_id", F.lit("b")).alias("traj_id"))
    return trajectories.training_set([rows, other], most=2)


# --- scans ----------------------------------------------------------------------------------------------


def _place(spark: SparkSession, ending: str) -> str:
    return f"{checkpoint_dir(spark)}/scans/{uuid.uuid4().hex}{ending}"


def _instances(spark: SparkSession, folder: str) -> DataFrame:
    return T(spark, folder, "task_instances").select("instance_id", "repo", "patch", "image_name", "problem_statement", "FAIL_TO_PASS", "PASS_TO_PASS")


def _summary(rows: DataFrame) -> DataFrame:
    n = lambda c: F.coalesce(F.array_size(c), F.lit(-1))
    return rows.select("instance_id", "repo", F.md5("patch").alias("patch"), F.md5("problem_statement").alias("statement"), n("FAIL_TO_PASS").alias("f2p"), n("PASS_TO_PASS").alias("p2p"))


def scan_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Instances written as JSON lines and read again."""
    path = _place(spark, ".jsonl")
    sinks.write_lines(_instances(spark, folder), path)
    return _summary(readers.good(readers.dataset(spark, path)))


def scan_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Instances written as JSON arrays of a hundred and read again."""
    path = _place(spark, ".json")
    sinks.write_arrays(_instances(spark, folder), path, per_file=100)
    return _summary(readers.good(readers.dataset(spark, path, per_line=True)))


def scan_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions written as JSON lines and read again."""
    path = _place(spark, ".jsonl")
    sinks.write_lines(T(spark, folder, "predictions"), path)
    return readers.predictions(spark, path).select("instance_id", F.md5("model_patch").alias("patch"), "model_name_or_path")


def scan_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Instances written to a folder per repository and read again, one repository pruned away."""
    path = _place(spark, "")
    rows = T(spark, folder, "task_instances").select("row_id", scalar.repo_part(F.col("instance_id")).alias("repo_key"))
    sinks.write_reports(rows, path)
    return spark.read.parquet(path).groupBy(F.col("repo_key").cast("string").alias("repo_key")).agg(F.count(F.lit(1)).alias("n"))


# --- SQL --------------------------------------------------------------------------------------------------

#: Lines of every patch with their file, hunk, and whether they belong to a hunk's body.
_PARTS = r"""
    raw AS (SELECT row_id, unnest(string_split(regexp_replace(patch, '\n$', ''), chr(10))) AS line,
                   generate_subscripts(string_split(regexp_replace(patch, '\n$', ''), chr(10)), 1) AS n FROM {0} WHERE patch <> ''),
    filed AS (SELECT *, sum(CASE WHEN starts_with(line, 'diff --git a/') THEN 1 ELSE 0 END) OVER w AS f,
                     sum(CASE WHEN regexp_matches(line, '^@@ -\d+(,\d+)? \+\d+(,\d+)? @@') THEN 1 ELSE 0 END) OVER w AS h FROM raw WINDOW w AS (PARTITION BY row_id ORDER BY n)),
    marked AS (SELECT *, h > min(h) OVER (PARTITION BY row_id, f) AS inside, regexp_matches(line, '^@@ -\d+(,\d+)? \+\d+(,\d+)? @@') AS is_head FROM filed WHERE f > 0),
    counted AS (SELECT *, regexp_replace(regexp_replace(line, '^@@ -(\d+) ', '@@ -\1,1 '), '^(@@ -\d+,\d+) \+(\d+) @@', '\1 +\2,1 @@') AS whole FROM marked),
    named AS (SELECT *, max(CASE WHEN NOT inside AND starts_with(line, '--- ') THEN substr(line, 5) END) OVER w AS was,
                     max(CASE WHEN NOT inside AND starts_with(line, '+++ ') THEN substr(line, 5) END) OVER w AS now,
                     max(CASE WHEN starts_with(line, 'diff --git a/') THEN regexp_extract(line, '^diff --git a/.*? b/(.*)$', 1) END) OVER w AS path
              FROM counted WINDOW w AS (PARTITION BY row_id, f)),
    body AS (SELECT row_id, h, count(*) FILTER (left(line, 1) <> '+') AS n_old, count(*) FILTER (left(line, 1) <> '-') AS n_new
             FROM named WHERE inside AND NOT is_head AND left(line, 1) <> chr(92) GROUP BY 1, 2)
"""
PARTS = _PARTS.replace("{0}", "task_instances")
#: The same of the predictions' distinct patches, by their digest.
GUESSED = _PARTS.replace("{0}", "(SELECT md5(model_patch) AS row_id, model_patch AS patch FROM (SELECT DISTINCT model_patch FROM predictions))")
_WORD = r"([\pL_][\pL\pN_]*)"
_DECLARED = f"""CASE language WHEN 'python' THEN regexp_extract(content, '^(\\s*)(?:async\\s+)?(def|class)\\s+{_WORD}', ['pad', 'word', 'name'])
    WHEN 'rust' THEN regexp_extract(content, '^(\\s*)(?:(?:pub(?:\\([^)]*\\))?|async|unsafe|const|extern)\\s+)*(fn|struct|enum|trait|impl)\\s*(?:<[^>]*>\\s*)?\\b{_WORD}', ['pad', 'word', 'name'])
    ELSE regexp_extract(content, '^(\\s*)(def|fn|func|function|class|struct|enum|trait|impl|interface)\\s+(?:\\([^)]*\\)\\s*)?{_WORD}', ['pad', 'word', 'name']) END"""
_QUALITY = """
    q AS (SELECT row_id, patch AS p, coalesce(problem_statement, '') AS s,
                 (length(patch) - length(replace(patch, chr(10) || '-', ''))) // 2 + (length(patch) - length(replace(patch, chr(10) || '+', ''))) // 2 AS changed,
                 (length(patch) - length(replace(patch, 'diff --git', ''))) // 10 AS files, length(patch) - length(replace(patch, chr(10), '')) + 1 AS lines
          FROM task_instances WHERE patch IS NOT NULL),
    parts AS (SELECT row_id,
        least(0.5::DOUBLE + {marks} + CASE WHEN length(s) > 20 THEN 0.1::DOUBLE ELSE 0 END, 1.0::DOUBLE) AS realism,
        least(0.3::DOUBLE + CASE WHEN changed > 2 THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN changed > 5 THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN files > 1 THEN 0.15::DOUBLE ELSE 0 END
              + CASE WHEN contains(p, 'if ') OR contains(p, 'match ') THEN 0.15::DOUBLE ELSE 0 END, 1.0::DOUBLE) AS complexity,
        least(0.5::DOUBLE + CASE WHEN files = 1 THEN 0.3::DOUBLE WHEN files <= 3 THEN 0.15::DOUBLE ELSE 0 END
              + CASE WHEN lines < 30 THEN 0.2::DOUBLE WHEN lines < 50 THEN 0.1::DOUBLE ELSE 0 END, 1.0::DOUBLE) AS minimality,
        least(0.4::DOUBLE + CASE WHEN {behaviour} THEN 0.1::DOUBLE ELSE 0 END + CASE WHEN contains(p, 'mut ') OR contains(p, '= ') THEN 0.15::DOUBLE ELSE 0 END, 1.0::DOUBLE) AS testability
        FROM q),
    scored AS (SELECT *, realism * 0.3::DOUBLE + complexity * 0.25::DOUBLE + minimality * 0.25::DOUBLE + testability * 0.2::DOUBLE AS overall FROM parts)
""".format(
    marks=" + ".join(f"CASE WHEN contains(p, '{m}') THEN 0.05::DOUBLE ELSE 0 END" for m in scores.REAL_MARKS),
    behaviour=" OR ".join(f"contains(lower(s), '{w}')" for w in scores.BEHAVIOUR),
)
_CHAT = "'<|im_start|>{0}' || chr(10) || {1} || '<|im_end|>' || chr(10)"


def _chat(assistant: str, system: str = "'You fix bugs.'", tool: str = "user", asked: str = "problem_statement", done: str = "'done ' || row_id") -> str:
    parts = (("system", system), ("user", asked), ("assistant", assistant), (tool, done))
    return f"SELECT row_id, md5({' || '.join(_CHAT.format(r, c) for r, c in parts)}) AS chat, NULL::VARCHAR AS error FROM task_instances WHERE problem_statement IS NOT NULL"


_SUMMARY = """SELECT instance_id, repo, md5(patch) AS patch, md5(problem_statement) AS statement, coalesce(len(FAIL_TO_PASS), -1)::INT AS f2p,
    coalesce(len(PASS_TO_PASS), -1)::INT AS p2p FROM task_instances"""
_BOILERPLATE = ", ".join(f"'{n}'" for n in graph.BOILERPLATE)

SQL = {
    "patch_repaired": rf"""WITH {GUESSED} SELECT row_id AS patch_key, string_agg(CASE
        WHEN is_head THEN regexp_replace(regexp_replace(whole, '^@@ -(\d+),\d+', '@@ -\1,' || coalesce(n_old, 0)), '^(@@ -\d+,\d+ \+\d+),\d+', '\1,' || coalesce(n_new, 0))
        ELSE line END, chr(10) ORDER BY n) || chr(10) AS patch FROM named LEFT JOIN body USING (row_id, h) GROUP BY 1""",
    "patch_problems": rf"""WITH {GUESSED}, bad AS (SELECT row_id, bool_or(regexp_extract(whole, '^@@ -\d+,(\d+)', 1)::INT <> coalesce(n_old, 0)
            OR regexp_extract(whole, '\+\d+,(\d+)', 1)::INT <> coalesce(n_new, 0)) AS bad FROM named LEFT JOIN body USING (row_id, h) WHERE is_head GROUP BY 1)
        SELECT CASE WHEN NOT starts_with(coalesce(model_patch, ''), 'diff --git') THEN 'no header' WHEN NOT contains(model_patch, '@@ -') THEN 'no hunks'
               WHEN bad THEN 'hunk counts' END AS problem, count(*) AS n FROM predictions LEFT JOIN bad ON row_id = md5(model_patch) GROUP BY 1""",
    "hunk_changes": rf"""WITH {PARTS}, l AS (SELECT row_id, f, h, n, left(line, 1) AS mark, CASE WHEN left(line, 1) IN ('+', '-', ' ') THEN substr(line, 2) ELSE line END AS content,
                CASE lower(regexp_extract(path, '[.]([^./]+)$', 1)) WHEN 'py' THEN 'python' WHEN 'rs' THEN 'rust' ELSE 'general' END AS language,
                was = '/dev/null' AS fresh, now = '/dev/null' AS gone FROM named WHERE inside AND NOT is_head AND line <> '' AND left(line, 1) <> chr(92)),
        d AS (SELECT *, {_DECLARED} AS x FROM l),
        i AS (SELECT row_id, h, side, n, x.name AS name, length(x.pad) AS pad, x.word NOT IN ('def', 'fn', 'func', 'function') AS is_type
              FROM d, (VALUES (0), (1)) s(side) WHERE x.name <> '' AND mark <> CASE side WHEN 0 THEN '+' ELSE '-' END),
        about AS (SELECT row_id, h, arg_min(name, (pad, side, is_type, n)) AS name FROM i GROUP BY 1, 2),
        has AS (SELECT a.row_id, a.h, a.name, bool_or(i.side = 0) AS was, bool_or(i.side = 1) AS is_now FROM about a JOIN i ON a.row_id = i.row_id AND a.h = i.h AND a.name = i.name GROUP BY ALL),
        t AS (SELECT row_id, f, h, bool_or(fresh) AS fresh, bool_or(gone) AS gone,
                     coalesce(regexp_replace(string_agg(content, chr(10) ORDER BY n) FILTER (mark <> '+'), '^\s+|\s+$', '', 'g'), '') AS b,
                     coalesce(regexp_replace(string_agg(content, chr(10) ORDER BY n) FILTER (mark <> '-'), '^\s+|\s+$', '', 'g'), '') AS a FROM l GROUP BY 1, 2, 3)
        SELECT t.row_id, (dense_rank() OVER (PARTITION BY t.row_id ORDER BY t.h) - 1)::INT AS hunk, CASE WHEN was AND NOT is_now THEN 'removed' WHEN is_now AND NOT was THEN 'added'
               WHEN coalesce(fresh, false) OR b = '' THEN 'added' WHEN coalesce(gone, false) OR a = '' THEN 'removed' ELSE 'modified' END AS change, has.name AS declared
        FROM t LEFT JOIN has ON t.row_id = has.row_id AND t.h = has.h WHERE a <> b""",
    "patch_round_trip": f"""WITH {PARTS} SELECT row_id, md5(string_agg(CASE WHEN is_head THEN whole ELSE line END, chr(10) ORDER BY n) || chr(10)) AS patch FROM named GROUP BY 1""",
    "patch_inverted": rf"""WITH {PARTS} SELECT row_id, md5(string_agg(CASE
        WHEN is_head THEN regexp_replace(whole, '^@@ -(\d+,\d+) \+(\d+,\d+) @@', '@@ -\2 +\1 @@')
        WHEN inside THEN CASE left(line, 1) WHEN '+' THEN '-' || substr(line, 2) WHEN '-' THEN '+' || substr(line, 2) ELSE line END
        WHEN starts_with(line, 'diff --git a/') THEN regexp_replace(line, '^diff --git a/(.*?) b/(.*)$', 'diff --git a/\2 b/\1')
        WHEN starts_with(line, '--- ') AND now IS NOT NULL THEN '--- ' || CASE now WHEN '/dev/null' THEN now ELSE 'a/' || substr(now, 3) END
        WHEN starts_with(line, '+++ ') AND was IS NOT NULL THEN '+++ ' || CASE was WHEN '/dev/null' THEN was ELSE 'b/' || substr(was, 3) END
        WHEN starts_with(line, 'new file mode') THEN replace(line, 'new file mode', 'deleted file mode')
        WHEN starts_with(line, 'deleted file mode') THEN replace(line, 'deleted file mode', 'new file mode')
        ELSE regexp_replace(line, '^index (\S+?)\.\.(\S+)', 'index \2..\1') END, chr(10) ORDER BY n) || chr(10)) AS inverse FROM named GROUP BY 1""",
    "patch_test_parts": f"""WITH {PARTS}, halves AS (SELECT row_id,
            string_agg(CASE WHEN is_head THEN whole ELSE line END, chr(10) ORDER BY n) FILTER (NOT regexp_matches(path, 'test|e2e')) || chr(10) AS fix,
            string_agg(CASE WHEN is_head THEN whole ELSE line END, chr(10) ORDER BY n) FILTER (regexp_matches(path, 'test|e2e')) || chr(10) AS tests FROM named GROUP BY 1)
        SELECT t.row_id, md5(coalesce(fix, '')) AS fix, md5(coalesce(tests, '')) AS tests FROM task_instances t LEFT JOIN halves b ON t.row_id = b.row_id""",
    "static_statements": f"""WITH {PARTS}, l AS (SELECT row_id, path, trim(regexp_extract(head, '^@@[^@]*@@(.*)$', 1)) AS section
            FROM (SELECT *, max(CASE WHEN is_head THEN line END) OVER (PARTITION BY row_id, h) AS head FROM named) WHERE inside AND NOT is_head AND line <> '' AND NOT contains(line, '\\ No newline at end of file')),
        g AS (SELECT row_id, list_sort(list(DISTINCT path)) AS files, coalesce(list_sort(list(DISTINCT section) FILTER (section <> '')), []::VARCHAR[]) AS functions FROM l GROUP BY 1)
        SELECT row_id, md5('Files:' || chr(10) || '- ' || array_to_string(files, chr(10) || '- ') || chr(10) || 'Functions:' || chr(10) || '- ' || array_to_string(functions, chr(10) || '- ')
            || chr(10) || 'Test: ' || coalesce(list_min(FAIL_TO_PASS), '')) AS statement FROM g JOIN task_instances USING (row_id)""",
    "task_chunks": rf"""WITH {PARTS}, k AS (SELECT row_id, path, f, h, row_number() OVER (PARTITION BY row_id ORDER BY n) - 1 AS place_no, regexp_extract(whole, '\+(\d+)', 1) AS start,
            regexp_extract(whole, '^@@ -\d+,(\d+)', 1) AS o, regexp_extract(whole, '\+\d+,(\d+)', 1) AS w FROM named WHERE is_head),
        c AS (SELECT *, place_no // 3 AS chunk FROM k), t AS (SELECT row_id, max(chunk) + 1 AS total FROM c GROUP BY 1)
        SELECT c.row_id, chunk::INT AS chunk_id, any_value(total)::INT AS total_chunks, count(*) AS total_changes, count(DISTINCT path) AS files_changed,
               count(*) FILTER (o = '0') AS added, count(*) FILTER (o <> '0' AND w <> '0') AS modified, count(*) FILTER (o <> '0' AND w = '0') AS removed,
               list(path || ':' || start ORDER BY place_no) AS locations FROM c JOIN t USING (row_id) GROUP BY 1, 2""",
    "quality_scores": f"""WITH {_QUALITY} SELECT row_id, round(realism, 4) AS realism, round(complexity, 4) AS complexity, round(minimality, 4) AS minimality,
        round(testability, 4) AS testability, round(overall, 4) AS overall FROM scored""",
    "accepted_qualities": f"WITH {_QUALITY} SELECT row_id FROM scored WHERE round(overall, 4) >= 0.6",
    "pull_subset": "SELECT row_id, instance_id FROM task_instances WHERE contains(instance_id, '.pr_') AND len(FAIL_TO_PASS) BETWEEN 2 AND 5",
    "function_targets": rf"""WITH b AS (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS body,
                generate_subscripts(string_split(text, chr(10) || chr(10)), 1) - 1 AS n FROM documents WHERE kind = 'source' AND text IS NOT NULL),
            m AS (SELECT *, regexp_extract(body, '{texts.HEAD}', 1) AS name FROM b)
        SELECT doc_id, n::INT AS n, name FROM m WHERE name <> '' AND length(body) >= 50 AND NOT regexp_matches(name, '^(?:get_|set_|is_|test_)') AND name NOT IN ({_BOILERPLATE})
            AND (contains(body, 'async') OR regexp_matches(body, '[.]\w+\(') OR length(body) >= 80)""",
    "original_statements": """SELECT DISTINCT p.instance_id, model_name_or_path, md5(statement) AS statement FROM predictions p
        JOIN (SELECT instance_id, arg_min(problem_statement, row_id) AS statement FROM (SELECT * FROM task_instances WHERE problem_statement IS NOT NULL) GROUP BY 1) USING (instance_id)
        WHERE trim(statement, ' ') <> ''""",
    "first_responses": """SELECT instance_id, model_name_or_path, md5(min(model_patch)) AS response FROM predictions
        WHERE model_patch <> '' AND instance_id IN (SELECT instance_id FROM task_instances) GROUP BY 1, 2""",
    "stage_failures": "SELECT run, status, count(*) AS n FROM test_status WHERE status IN ('FAILED', 'ERROR') GROUP BY 1, 2",
    "suffix_tests": """WITH t AS (SELECT DISTINCT split_part(test, '::', 1) AS test_path, regexp_extract(split_part(test, '::', 1), '([^/]*)$', 1) AS base
            FROM test_status WHERE split_part(test, '::', 1) LIKE '%/%')
        SELECT DISTINCT 'other/' || a.base AS path, b.test_path FROM t a JOIN t b USING (base)""",
    "nested_grades": "SELECT output_id, coalesce(run IN ('gold', 'clean') AND length(output) > 100, false) AS flag FROM run_outputs",
    "union_once": "SELECT instance_id, max(repo) AS repo FROM task_instances GROUP BY 1 UNION ALL SELECT instance_id, repo FROM eval_instances",
    "sft_ticks": _chat("'Look at ' || instance_id || chr(10) || chr(10) || '```' || chr(10) || coalesce(patch, '') || chr(10) || '```'"),
    "sft_xml": _chat("'Look at ' || instance_id", system="'You are careful.'"),
    "sft_tool": _chat("coalesce(patch, '')", tool="tool"),
    "sft_training_set": """WITH r AS (SELECT instance_id, row_id::VARCHAR AS traj_id FROM task_instances UNION ALL SELECT instance_id, row_id || 'b' FROM task_instances)
        SELECT instance_id, traj_id FROM (SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY md5('24|' || traj_id), traj_id) AS n FROM r) WHERE n <= 2""",
    "scan_lines": _SUMMARY, "scan_arrays": _SUMMARY,
    "scan_predictions": "SELECT instance_id, md5(model_patch) AS patch, model_name_or_path FROM predictions",
    "scan_reports": r"SELECT regexp_replace(instance_id, '\.[^.]*$', '') AS repo_key, count(*) AS n FROM task_instances GROUP BY 1",
}

QUERIES = (
    patch_round_trip, hunk_changes, task_chunks, similarity_statistics, worst_similarities, accepted_similarities, pull_subset, accepted_qualities, function_targets,
    original_statements, first_responses, stage_failures, suffix_tests, nested_grades, union_once, *map(_styled, trajectories.STYLES), sft_training_set,
    scan_lines, scan_arrays, scan_predictions, scan_reports,
)
