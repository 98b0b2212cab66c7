"""Queries over documents, outputs and code, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import aggregates, combine, diffs, graph, joins, scores, semantics, status, testlogs, trajectories, windows
from ..session import table

T = table


def log_parse_pytest(spark: SparkSession, folder: str) -> DataFrame:
    logs = T(spark, folder, "documents").where("kind = 'log'")
    return testlogs.parse_logs(logs, ["doc_id"], "text", "pytest")


def log_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return log_parse_pytest(spark, folder).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def output_test_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every output by the parser of its project's language."""
    names = F.when(F.col("ext") == "rs", "cargo").when(F.col("ext") == "go", "go").when(F.col("ext") == "js", "jest").otherwise("pytest")
    of = T(spark, folder, "profiles").select("repo_name", names.alias("parser")).dropDuplicates(["repo_name"])
    logs = T(spark, folder, "run_outputs").withColumn("repo_name", scalar.repo_part(F.col("instance_id")))
    return testlogs.parse_logs(logs.join(of, "repo_name", "left"), ["output_id"], "output", F.coalesce("parser", F.lit("pytest")))


def marked_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Outputs between markers, by run: with both, with one, after a failed patch, or without any."""
    start, end = f"+ : '{testlogs.START}'", f"+ : '{testlogs.END}'"
    log = (
        F.when(F.col("run") == "clean", F.concat(F.lit(f"before\n{start}"), "output", F.lit(f"{end}\nafter")))
        .when(F.col("run") == "buggy", F.concat(F.lit(start), "output"))
        .when(F.col("run") == "gold", F.concat("output", F.lit(f"\n{testlogs.NO_OUTPUT[0]}\n{start}{end}"))).otherwise(F.col("output"))
    )
    rows = T(spark, folder, "run_outputs").withColumn("log", log)
    return rows.select("output_id", testlogs.has_output(F.col("log")).alias("found"), F.md5(testlogs.marked_output(F.col("log"))).alias("text"))


def issue_references(spark: SparkSession, folder: str) -> DataFrame:
    """Issues that statements close, in words put around them; numbers in comments and after other words don't count."""
    text = F.concat(
        F.lit("Fixes #"), F.col("row_id"), F.lit("\n<!-- closes #1 -->"), F.coalesce("problem_statement", F.lit("")),
        F.lit("\nresolved #7, see #8 and fixing #9. CLOSED #"), F.col("row_id"),
    )
    rows = T(spark, folder, "task_instances").select("row_id", scores.resolved_issues(text).alias("issues"))
    return rows.where(F.size("issues") > 0)


def code_blocks(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "documents").select("doc_id", scalar.code_block(F.col("text")).alias("block"))
    return rows.where("block <> ''").select("doc_id", F.md5("block").alias("block"))


def shortened_texts(spark: SparkSession, folder: str) -> DataFrame:
    words = F.size(F.split("text", " "))
    out = scalar.truncated(F.col("text"), words, 100, 200, 100)
    return T(spark, folder, "documents").where("text is not null").select("doc_id", F.md5(out).alias("text"))


def line_contexts(spark: SparkSession, folder: str) -> DataFrame:
    lines = F.split("text", "\n")
    at = F.array_position(F.transform(lines, lambda x: F.contains(x, F.lit("return"))), F.lit(True))
    rows = T(spark, folder, "documents").select("doc_id", lines.alias("lines"), at.cast("int").alias("at")).where("at > 0")
    return rows.select("doc_id", "at", F.array_join(windows.neighbours(F.col("lines"), F.col("at"), 2), "\n").alias("context"))


def section_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by the heading they stand under, carried forward within each document."""
    lines = T(spark, folder, "documents").where("kind = 'readme'").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    head = F.when(F.col("line").startswith("#"), F.col("line"))
    marked = windows.carry_forward(lines, "doc_id", "n", head, "heading")
    return marked.groupBy("doc_id", "heading").agg(F.count(F.lit(1)).alias("n_lines"))


def transcript_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "documents").where("kind = 'trajectory'")
    return rows.select("doc_id", F.explode(trajectories.transcript_messages(F.col("text"))).alias("m")).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("m.role") == "assistant").alias("n_assistant"),
        F.count_if(F.col("m.role") == "user").alias("n_user"),
    )


def transcript_texts(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "documents").where("kind = 'trajectory' and text <> ''")
    return rows.select("doc_id", F.md5(trajectories.chat_text(trajectories.transcript_messages(F.col("text")))).alias("chat"))


def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    gold = T(spark, folder, "task_instances").groupBy("instance_id").agg(F.min("row_id").alias("row_id"))
    rows = T(spark, folder, "task_instances").join(gold, ["row_id", "instance_id"])
    graded = status.grade(rows, T(spark, folder, "test_status"), "row_id", "clean").select("instance_id", "resolved")
    patches = T(spark, folder, "predictions").groupBy("instance_id").agg(F.max("model_patch").alias("model_patch"))
    out = trajectories.training_rows(rows.select("instance_id", "problem_statement"), graded, patches)
    return out.select("instance_id", "resolved", F.md5("patch").alias("patch"))


def rating_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances").groupBy("instance_id").agg(
        F.max("problem_statement").alias("s"), F.max("patch").alias("p")
    ).join(T(spark, folder, "difficulties").where("difficulty is not null"), "instance_id")
    m = trajectories.rating_messages(F.coalesce("s", F.lit("")), F.coalesce("p", F.lit("")), scores.merged_label(F.col("difficulty")), "Rate.")
    return rows.select("instance_id", F.md5(trajectories.chat_text(m)).alias("chat"))


HEAD = r"(?m)^(?:def|func|function|export function|fn|pub fn) (\w+)"


def _functions(spark: SparkSession, folder: str) -> DataFrame:
    """Functions of source documents: blocks between blank lines that start with a definition."""
    blocks = T(spark, folder, "documents").where("kind = 'source'").select("doc_id", F.posexplode(F.split("text", "\n\n")).alias("n", "block"))
    name = F.regexp_extract("block", HEAD, 1)
    calls = F.array_sort(F.array_distinct(F.regexp_extract_all("block", F.lit(r"[.](\w+)\("), F.lit(1))))
    return blocks.where(name != "").select(
        F.concat_ws(":", "doc_id", "n").alias("func_key"), F.regexp_replace(name, "^.*_", "").alias("name"),
        F.concat(F.lit("doc/"), F.col("doc_id")).alias("file_path"), calls.alias("calls"),
        F.when(F.contains("block", F.lit("pub fn")), "pub").otherwise("").alias("visibility"),
        name.rlike("^(?:get|set)_").alias("is_accessor"),
    )


_FUNCTIONS = r"""
    blocks AS (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS block,
                      generate_subscripts(string_split(text, chr(10) || chr(10)), 1) - 1 AS n
               FROM documents WHERE kind = 'source' AND text IS NOT NULL),
    named AS (SELECT *, regexp_extract(block, '(?m)^(?:def|func|function|export function|fn|pub fn) (\w+)', 1) AS full_name FROM blocks),
    functions AS (SELECT doc_id || ':' || n AS func_key, regexp_replace(full_name, '^.*_', '') AS name, 'doc/' || doc_id AS file_path,
                         list_distinct(regexp_extract_all(block, '[.](\w+)\(', 1)) AS calls, contains(block, 'pub fn') AS pub,
                         regexp_matches(full_name, '^(?:get|set)_') AS accessor
                  FROM named WHERE full_name <> ''),
    called AS (SELECT func_key AS caller, unnest(calls) AS name FROM functions),
    edges AS (SELECT DISTINCT caller, func_key AS callee FROM called JOIN functions USING (name) WHERE caller <> func_key)
"""


def call_edges(spark: SparkSession, folder: str) -> DataFrame:
    return graph.call_edges(_functions(spark, folder))


def call_reach(spark: SparkSession, folder: str) -> DataFrame:
    functions = _functions(spark, folder)
    start = functions.where("name = 'encoder'").select(F.col("func_key").alias("node"))
    return graph.reach(graph.call_edges(functions), start, 2)


def call_hotspots(spark: SparkSession, folder: str) -> DataFrame:
    functions = _functions(spark, folder)
    return graph.hotspots(functions, graph.call_edges(functions), 25)


def call_components(spark: SparkSession, folder: str) -> DataFrame:
    found = graph.block_components(*graph.call_blocks(_functions(spark, folder)))
    return found.groupBy("component").agg(F.count(F.lit(1)).alias("n"))


def call_betweenness(spark: SparkSession, folder: str) -> DataFrame:
    """Estimated from 16 sources in hash order (the sample is the feature)."""
    calls, held = graph.call_blocks(_functions(spark, folder))
    sources = windows.sample(calls.select("node").distinct(), 16, 24, ["node"])
    return graph.block_betweenness(calls, held, sources).select("node", F.round("score", 9).alias("score"))


def call_communities(spark: SparkSession, folder: str) -> DataFrame:
    found = graph.block_communities(*graph.call_blocks(_functions(spark, folder)))
    return found.groupBy("community", "greedy").agg(F.count(F.lit(1)).alias("n"))


def file_dependencies(spark: SparkSession, folder: str) -> DataFrame:
    functions = _functions(spark, folder)
    out = graph.file_dependencies(graph.call_edges(functions), functions)
    return out.select("file_path", "calls", "called_by")


def name_index(spark: SparkSession, folder: str) -> DataFrame:
    out = joins.inverted_index(_functions(spark, folder).select("file_path", "calls"), "calls")
    return out


def name_sets(spark: SparkSession, folder: str) -> DataFrame:
    """What two functions of a name call: names only in the first, only in the last, and in both."""
    by = _functions(spark, folder).groupBy("name").agg(
        F.min_by("calls", "func_key").alias("a"), F.max_by("calls", "func_key").alias("b"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    n = lambda c: F.size(c)
    return by.select(
        "name", n(F.array_except("b", "a")).alias("n_added"), n(F.array_except("a", "b")).alias("n_removed"),
        n(F.array_intersect("a", "b")).alias("n_kept"),
    )


def patch_similarity(spark: SparkSession, folder: str) -> DataFrame:
    gold = T(spark, folder, "task_instances").groupBy("instance_id").agg(F.max("patch").alias("patch"))
    rows = T(spark, folder, "predictions").join(gold, "instance_id").select("model_patch", "patch").distinct()
    ratio = diffs.similarity(F.col("model_patch"), F.col("patch"))
    return rows.withColumn("bucket", aggregates.similarity_bucket(ratio, F.col("model_patch"))).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n")
    )


def test_files(spark: SparkSession, folder: str) -> DataFrame:
    tests = T(spark, folder, "test_status").select(F.substring_index("test", "::", 1).alias("test_path")).where("test_path like '%/%.py'").distinct()
    names = F.regexp_extract("test_path", r"test_(\w+)\.py$", 1)
    changed = tests.select(F.concat(F.lit("src/"), names, F.lit(".py")).alias("path")).distinct()
    return joins.test_files_of(changed, tests)


def semantic_changes(spark: SparkSession, folder: str) -> DataFrame:
    rows = semantics.semantic_changes(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])
    return rows.groupBy("language", "kind", "change", "meaning").agg(F.count(F.lit(1)).alias("n"))


def change_reports(spark: SparkSession, folder: str) -> DataFrame:
    rows = semantics.semantic_changes(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])
    return semantics.change_report(rows, ["row_id"])


def patch_languages(spark: SparkSession, folder: str) -> DataFrame:
    hunks = diffs.patch_hunks(T(spark, folder, "task_instances").select("row_id", "patch"), ["row_id"])
    return hunks.select("row_id", semantics.language(F.col("new_path")).alias("language")).groupBy("language").agg(
        F.count(F.lit(1)).alias("n_hunks"), F.countDistinct("row_id").alias("n_patches")
    )


def patch_problems(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "predictions").select(semantics.patch_problem(F.col("model_patch")).alias("problem"))
    return rows.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def test_nodes(spark: SparkSession, folder: str) -> DataFrame:
    tests = T(spark, folder, "test_status").select("test").where("test like '%::%'").distinct()
    return tests.select("test", semantics.test_node(F.col("test")).alias("t")).select("test", "t.file", "t.class_name", "t.name")


def static_statements(spark: SparkSession, folder: str) -> DataFrame:
    """Statements from a template: the files, the functions and a failing test of each instance."""
    rows = T(spark, folder, "task_instances").select("row_id", "patch", F.array_min("FAIL_TO_PASS").alias("test")).where("patch <> ''")
    parts = diffs.patch_summaries(rows, ["row_id", "test"])
    text = semantics.render("Files:\n{files}\nFunctions:\n{functions}\nTest: {test}", {
        "files": semantics.bullet_list(F.col("files")), "functions": semantics.bullet_list(F.col("sections")), "test": F.col("test"),
    })
    return parts.select("row_id", F.md5(text).alias("statement"))


def composite_patches(spark: SparkSession, folder: str) -> DataFrame:
    """Two patches of different modules of a repository, at most five a repository."""
    rows = T(spark, folder, "task_instances").where("patch <> ''")
    path = F.regexp_extract("patch", r"(?m)^diff --git a/(\S+)", 1)
    named = rows.select(scalar.repo_part(F.col("instance_id")).alias("repo_key"), path.alias("file"), F.format_string("%09d", F.col("row_id")).alias("name"), "patch")
    out = combine.composites(named, "repo_key", "hard", 5)
    return out.select("repo_key", "members", F.md5("patch").alias("patch"))


def combined_patches(spark: SparkSession, folder: str) -> DataFrame:
    rows = T(spark, folder, "task_instances").where("patch <> ''")
    named = rows.select(scalar.repo_part(F.col("instance_id")).alias("repo_key"), F.format_string("%09d", F.col("row_id")).alias("name"), "patch")
    out = combine.combined(named, "repo_key", 2, most=5, tries=200, files=2)
    return out.select("repo_key", "members", F.md5("patch").alias("patch"))


SQL = {
    "patch_languages": r"""
        WITH raw AS (SELECT row_id, unnest(string_split(patch, chr(10))) AS line, generate_subscripts(string_split(patch, chr(10)), 1) AS n
                     FROM task_instances WHERE patch <> ''),
        f AS (SELECT *, last_value(CASE WHEN starts_with(line, 'diff --git a/') THEN regexp_extract(line, '[.]([^./]+)$', 1) END IGNORE NULLS)
                     OVER (PARTITION BY row_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS ext FROM raw)
        SELECT CASE lower(ext) WHEN 'py' THEN 'python' WHEN 'rs' THEN 'rust' WHEN 'js' THEN 'javascript' WHEN 'ts' THEN 'typescript' WHEN 'rb' THEN 'ruby'
                    WHEN 'go' THEN 'go' WHEN 'java' THEN 'java' WHEN 'cpp' THEN 'cpp' WHEN 'c' THEN 'c' WHEN 'php' THEN 'php' ELSE 'general' END AS language,
               count(*) AS n_hunks, count(DISTINCT row_id) AS n_patches FROM f WHERE starts_with(line, '@@ -') GROUP BY 1""",
    "test_nodes": r"""
        WITH t AS (SELECT DISTINCT test, string_split(regexp_replace(test, '\[.*$', ''), '::') AS p FROM test_status WHERE contains(test, '::'))
        SELECT test, p[1] AS file, CASE WHEN len(p) > 2 THEN p[2] END AS class_name, p[-1] AS name FROM t""",
    "log_parse_pytest": r"""
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
                   FROM documents WHERE kind = 'log'),
        m AS (SELECT doc_id, n, regexp_extract(line, '^(\S+)\s+(?:PASSED|FAILED|SKIPPED|ERROR|XFAIL)', 1) AS test,
                     regexp_extract(line, '^\S+\s+(PASSED|FAILED|SKIPPED|ERROR|XFAIL)', 1) AS status FROM l)
        SELECT doc_id, test, arg_max(status, n) AS status FROM m WHERE test <> '' GROUP BY 1, 2""",
    "log_status_counts": r"""
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
                   FROM documents WHERE kind = 'log'),
        m AS (SELECT doc_id, regexp_extract(line, '^(\S+)\s+(?:PASSED|FAILED|SKIPPED|ERROR|XFAIL)', 1) AS test,
                     arg_max(regexp_extract(line, '^\S+\s+(PASSED|FAILED|SKIPPED|ERROR|XFAIL)', 1), n) AS status FROM l GROUP BY 1, 2)
        SELECT status, count(*) AS n FROM m WHERE test <> '' GROUP BY 1""",
    "call_components": f"""WITH RECURSIVE {_FUNCTIONS}, e AS (SELECT caller AS a, callee AS b FROM edges UNION SELECT callee, caller FROM edges),
        r(n, r) AS (SELECT a, a FROM e UNION SELECT r.n, e.b FROM r JOIN e ON r.r = e.a)
        SELECT component, count(*) AS n FROM (SELECT n, min(r) AS component FROM r GROUP BY n) GROUP BY 1""",
    "marked_outputs": """SELECT output_id, coalesce(run = 'clean' AND output IS NOT NULL, false) AS found,
        CASE WHEN run <> 'gold' THEN md5(CASE WHEN run = 'buggy' THEN '+ : ' || chr(39) || '>>>>> Start Test Output' || chr(39) || output ELSE output END) END AS text FROM run_outputs""",
    "issue_references": """SELECT row_id, list_sort(list_distinct([row_id::VARCHAR, '7'])) AS issues FROM task_instances""",
    "rating_rows": r"""WITH i AS (SELECT instance_id, coalesce(max(problem_statement), '') AS s, coalesce(max(patch), '') AS p FROM task_instances GROUP BY 1)
        SELECT instance_id, md5('<|im_start|>system' || chr(10) || 'Rate.<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || '<issue>' || chr(10) || s || chr(10) || '</issue>'
            || chr(10) || '<patch>' || chr(10) || p || chr(10) || '</patch><|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)
            || CASE difficulty WHEN '>4 hours' THEN '1-4 hours' ELSE difficulty END || '<|im_end|>' || chr(10)) AS chat
        FROM i JOIN difficulties USING (instance_id) WHERE difficulty IS NOT NULL""",
    "transcript_texts": r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
                   FROM documents WHERE kind = 'trajectory' AND text <> ''),
        k AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^(SYSTEM|THOUGHT|ACTION|OBSERVATION):') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS part FROM l),
        p AS (SELECT doc_id, part, regexp_extract(first(line ORDER BY n), '^([A-Z]+):', 1) AS speaker,
                     regexp_replace(regexp_replace(string_agg(line, chr(10) ORDER BY n), '^[A-Z]+:[ \t]*\n?', ''), '\s+$', '') AS body FROM k WHERE part > 0 GROUP BY 1, 2)
        SELECT d.doc_id, md5(coalesce(string_agg('<|im_start|>' || CASE speaker WHEN 'SYSTEM' THEN 'system' WHEN 'OBSERVATION' THEN 'user' ELSE 'assistant' END
            || chr(10) || body || '<|im_end|>' || chr(10), '' ORDER BY part), '')) AS chat
        FROM documents d LEFT JOIN p ON d.doc_id = p.doc_id WHERE d.kind = 'trajectory' AND text <> '' GROUP BY 1""",
    "test_files": r"""WITH t AS (SELECT DISTINCT split_part(test, '::', 1) AS test_path FROM test_status WHERE split_part(test, '::', 1) LIKE '%/%.py'),
        c AS (SELECT DISTINCT 'src/' || regexp_extract(test_path, 'test_(\w+)\.py$', 1) || '.py' AS path FROM t),
        s AS (SELECT path, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\.[^.]*$', '') AS stem, regexp_replace(path, '/?[^/]*$', '') AS folder FROM c),
        h AS (SELECT test_path, regexp_replace(regexp_replace(regexp_extract(test_path, '([^/]*)$', 1), '\.[^.]*$', ''), '^test_|^Test|[._-](?:test|spec)$|Tests?$|_spec$', '', 'g') AS stem,
                     regexp_replace(regexp_replace(test_path, '/?[^/]*$', ''), '(?:^|/)(?:tests?|specs?|__tests__)$', '') AS folder FROM t),
        m AS (SELECT path, test_path, 1 AS rule FROM s JOIN h USING (stem) UNION SELECT path, test_path, 2 FROM s JOIN h ON s.folder = h.folder)
        SELECT path, test_path, rule::INT AS rule FROM (SELECT *, min(rule) OVER (PARTITION BY path) AS best FROM m) WHERE rule = best""",
    "code_blocks": r"""SELECT doc_id, md5(b) AS block FROM (SELECT doc_id, trim(regexp_extract(text, '(?s)```(?:\w+)?\n(.*?)\n?```', 1), ' ') AS b FROM documents) WHERE b <> ''""",
    "shortened_texts": """SELECT doc_id, md5(CASE WHEN len(string_split(text, ' ')) > 100
        THEN substr(text, 1, 200) || chr(10) || chr(10) || '(...)' || chr(10) || chr(10) || right(text, 100) ELSE text END) AS text
        FROM documents WHERE text IS NOT NULL""",
    "line_contexts": """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
        p AS (SELECT *, list_position(list_transform(a, lambda x: contains(x, 'return')), true) AS k FROM l)
        SELECT doc_id, k::INT AS "at", array_to_string(a[greatest(k - 2, 1):least(k + 2, len(a))], chr(10)) AS context FROM p WHERE k > 0""",
    "section_lines": """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
                   FROM documents WHERE kind = 'readme'),
        h AS (SELECT doc_id, last_value(CASE WHEN starts_with(line, '#') THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS heading FROM l)
        SELECT doc_id, heading, count(*) AS n_lines FROM h GROUP BY 1, 2""",
    "transcript_rows": r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE kind = 'trajectory'),
        k AS (SELECT doc_id, regexp_extract(line, '^(SYSTEM|THOUGHT|ACTION|OBSERVATION):', 1) AS k FROM l)
        SELECT doc_id, count(*) AS n, count(*) FILTER (k IN ('THOUGHT', 'ACTION')) AS n_assistant, count(*) FILTER (k = 'OBSERVATION') AS n_user
        FROM k WHERE k <> '' GROUP BY 1""",
    "call_edges": f"WITH {_FUNCTIONS} SELECT * FROM edges",
    "call_reach": f"""WITH RECURSIVE {_FUNCTIONS}, r(node, depth) AS (
            SELECT func_key, 0 FROM functions WHERE name = 'encoder' UNION
            SELECT e.callee, r.depth + 1 FROM r JOIN edges e ON e.caller = r.node WHERE r.depth < 2)
        SELECT node, min(depth) AS depth FROM r GROUP BY 1""",
    "call_hotspots": f"""WITH {_FUNCTIONS}, c AS (SELECT callee AS func_key, count(*) AS n FROM edges GROUP BY 1)
        SELECT func_key, name, (len(calls) + coalesce(n, 0) + CASE WHEN pub THEN 5 ELSE 0 END - CASE WHEN accessor THEN 3 ELSE 0 END)::BIGINT AS score
        FROM functions LEFT JOIN c USING (func_key) ORDER BY score DESC, func_key LIMIT 25""",
    "file_dependencies": f"""WITH {_FUNCTIONS}, p AS (SELECT DISTINCT a.file_path AS f, b.file_path AS t FROM edges e
            JOIN functions a ON e.caller = a.func_key JOIN functions b ON e.callee = b.func_key WHERE a.file_path <> b.file_path)
        SELECT file_path, coalesce(list_sort(list(DISTINCT t) FILTER (t IS NOT NULL)), []::VARCHAR[]) AS calls,
               coalesce(list_sort(list(DISTINCT f) FILTER (f IS NOT NULL)), []::VARCHAR[]) AS called_by
        FROM (SELECT f AS file_path, t, NULL AS f FROM p UNION ALL SELECT t, NULL, f FROM p) GROUP BY 1""",
    "name_index": f"""WITH {_FUNCTIONS} SELECT name, list_sort(list(DISTINCT file_path)) AS files FROM
        (SELECT file_path, unnest(calls) AS name FROM functions) GROUP BY 1""",
    "name_sets": f"""WITH {_FUNCTIONS}, b AS (SELECT name, arg_min(calls, func_key) AS a, arg_max(calls, func_key) AS b FROM functions GROUP BY 1 HAVING count(*) > 1)
        SELECT name, len(list_filter(b, lambda x: NOT list_contains(a, x)))::INT AS n_added, len(list_filter(a, lambda x: NOT list_contains(b, x)))::INT AS n_removed,
               len(list_filter(a, lambda x: list_contains(b, x)))::INT AS n_kept FROM b""",
}

QUERIES = (
    log_parse_pytest, log_status_counts, output_test_rows, marked_outputs, issue_references, code_blocks, shortened_texts,
    line_contexts, section_lines, transcript_rows, transcript_texts, training_rows, rating_rows, call_edges, call_reach,
    call_hotspots, call_components, call_betweenness, call_communities, file_dependencies, name_index, name_sets, patch_similarity, test_files,
    semantic_changes, change_reports, patch_languages, patch_problems,
    test_nodes, static_statements, combined_patches, composite_patches,
)
