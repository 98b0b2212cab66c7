"""Queries that write the statuses of test_status in the form of a test runner and parse that: one per parser.

Every run of every instance becomes logs (cut by a hash of the test, so that no row holds a whole large run), and what the
parser reads must be what the table holds. The SQL therefore never sees a log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import testlogs
from ..session import table

_ALL = {"PASSED": "PASSED", "FAILED": "FAILED", "SKIPPED": "SKIPPED", "ERROR": "ERROR", "XFAIL": "XFAIL"}

#: Parser -> (what stands before the lines, a line by status, what stands after, between lines, what a status is read as,
#: how a test is named), with ``@`` for the test. A status without a line isn't written.
LINES: dict[str, tuple[str, dict[str, str], str, str, dict[str, str], str]] = {}


def _parser(name: str, lines: dict[str, str], head: str = "", foot: str = "", gap: str = "\n", named: str = "@", **read: str) -> None:
    LINES[name] = (head, lines, foot, gap, {k: read.get(k, k) for k in lines}, named)


def _same(*statuses: str, form: str) -> dict[str, str]:
    return {s: form.replace("%", s) for s in statuses}


def _pf(passed: str, failed: str, skipped: str | None = None) -> dict[str, str]:
    return {"PASSED": passed, "FAILED": failed} | ({"SKIPPED": skipped} if skipped else {})


_parser("pytest", _same(*_ALL, form="@ % [ 50 ]"))
_parser("pytest_xdist", _same(*_ALL, form="[gw1] % @"))
_parser("pytest_summary", _same(*_ALL, form="% @"))
_parser("pytest_fixed", _same("PASSED", "FAILED", "SKIPPED", "ERROR", form="@ %"))
_parser("unittest_dots", {"PASSED": "@ ... ok", "FAILED": "@ ... FAIL", "ERROR": "@ ... ERROR"})
_parser("unittest_lines", {"PASSED": "@ ... ok", "FAILED": "FAIL: @", "ERROR": "ERROR: @", "SKIPPED": "@ ... skipped 'x'"}, ERROR="FAILED")
_parser("status_anywhere", _pf("PASSED in 3 ms @", "FAILED in 3 ms @"))
_parser("go", _pf("--- PASS: @ (0.00s)", "--- FAIL: @ (0.00s)", "--- SKIP: @ (0.00s)"), head="=== RUN   all", foot="ok  all 0.1s")
_parser("cargo", _pf("test @ ... ok", "test @ ... FAILED"), head="running some tests")
_parser("surefire", _pf("[INFO] @ -- Time elapsed: 0.1 s", "[ERROR] @ -- Time elapsed: 0.1 s <<< FAILURE!"))
_parser("minitest", {"PASSED": "T#test_@ = 0.01 s = .", "FAILED": "T#test_@ = 0.01 s = F", "ERROR": "T#test_@ = 0.01 s = E"}, named="T#test_@")
_parser("phpunit", _pf(" ✔ @", " ✘ @", " ↩ @"), head="Suite (a.B)", named="a.B::@")
_parser("dotnet", _pf("  Passed @ [3 ms]", "  Failed @ [3 ms]", "  Skipped @ [3 ms]"))
_parser("colon", _pf("PASS: @", "FAIL: @"))
_parser("bracket", _pf("[ok]: @ (3 ms)", "[err]: @ in a.tcl", "[skip]: @"))
_parser("jest", _pf("  ✓ @ (3 ms)", "  ✕ @ (3 ms)", "  ○ @"))
_parser("mocha", _pf("  ✔ @ (3ms)", "  1) @", "  - @"))
_parser("vitest", _pf(" ✓ @ (2)", " ✗ @ (2)", " ○ @"))
_parser("tick_ms", _pf("  ✓ @ 3ms", "  ✗ @ 3ms"))
_parser("node_test", _pf("✔ @ (0.5ms)", "✖ @ (0.5ms)"))
_parser("autotools", {"PASSED": "PASS: @", "FAILED": "FAIL: @", "SKIPPED": "SKIP: @", "XFAIL": "XFAIL: @", "ERROR": "ERROR: @"}, XFAIL="PASSED", ERROR="FAILED")
_parser("bun", _pf("(pass) @ [1.00ms]", "(fail) @ [1.00ms]"))
_parser("pycdc", {"PASSED": "*** @: PASS ok", "FAILED": "*** @: FAIL no", "XFAIL": "*** @: XFAIL no"}, XFAIL="PASSED")
_parser("jakttest", {"FAILED": "[ FAIL ] @", "SKIPPED": "[ SKIP ] @"})
_parser("kakoune", _pf("\x1b[32m@\x1b[0m", "\x1b[31m@\x1b[0m", "\x1b[33m@\x1b[0m"))
_parser("coost", {"PASSED": " case @:"}, head="> begin test: s", named="s::@")
_parser("redis_tcl", _pf("[ok]: @", "[err]: @"))
_parser("async_profiler", _pf("PASS [1/9] @", "FAIL [1/9] @"))
_parser("i2pd", {"PASSED": "Running test-@"}, named="test-@")
_parser("fastllm", {"PASSED": "test @ finished!"})
_parser("platformio", _pf("@ SUCCESS 1", "@ FAILED 1"))
_parser("qtest", _pf("PASS   : @", "FAIL!  : @", "SKIP   : @"))
_parser("ctest", _pf(" 1/10 Test  #1: @ ........   Passed    0.01 sec", " 1/10 Test  #1: @ ........   Failed    0.01 sec"))
_parser("gtest", _pf("[       OK ] @ (0 ms)", "[  FAILED  ] @ (0 ms)", "[  SKIPPED ] @ (0 ms)"), head="[==========] 2 tests from 1 suite.", foot="[  PASSED  ] 2 tests.")
_parser("catch2", _pf('<TestCase name="@"><OverallResult success="true"/></TestCase>', '<TestCase name="@"><OverallResult success="false"/></TestCase>'))
_parser("catch2_text", _pf("@... PASSED", "@... FAILED"))
_parser("boost", _pf('Entering test case "@"', 'a.cpp(1): error in "@": check failed'))
_parser("junit_xml", _pf('<testcase classname="c" name="@"/>', '<testcase classname="c" name="@"><failure/></testcase>', '<testcase classname="c" name="@"><skipped/></testcase>'),
        head='<?xml version="1.0"?><testsuite name="s">', foot="</testsuite>", named="c.@")
_parser("rspec_json", _pf('{"full_description":"@","status":"passed"}', '{"full_description":"@","status":"failed"}'), head='{"version":"1","examples":[', foot="]}", gap=",")

#: Parser -> (a log by the numbers of passed @p, failed @f, skipped @s and all @t tests, what the log needs, sums and the
#: names they stand for, each with a status and the first number).
COUNTS: dict[str, tuple[str, str | None, tuple[tuple[str, str, str, int], ...]]] = {
    "karma": ("Executed @p of @t SUCCESS\nExecuted @t of @t (@f FAILED)\nExecuted @t of @t (@s skipped)", None,
              (("p", "karma_unit_test_", "PASSED", 1), ("f", "karma_unit_test_failed_", "FAILED", 1), ("s", "karma_unit_test_skipped_", "SKIPPED", 1))),
    "jasmine": ("@t specs, @f failures, @s pending specs", None,
                (("p", "jasmine_spec_", "PASSED", 1), ("f", "jasmine_spec_failed_", "FAILED", 1), ("s", "jasmine_spec_pending_", "SKIPPED", 1))),
    "mocha_summary": ("@p passing (2s)\n@f failing", None, (("p", "test_", "PASSED", 0), ("f", "test_failed_", "FAILED", 0))),
    "fswatch": ("@t tests, @p passing", "s = 0", (("p", "test_pass_", "PASSED", 1), ("f", "test_fail_", "FAILED", 1))),
    "cppunit": ("FAILURES!!!\n\nTests run: @t,  Failures: @f", "s = 0", (("p", "test_", "PASSED", 0), ("f", "test_fail_", "FAILED", 0))),
    "unittest_totals": ("Ran @t tests in 0.1s\n\nFAILED (failures=@f)", "s = 0", (("p", "test_pass_", "PASSED", 1), ("f", "test_fail_", "FAILED", 1))),
    "ctest": ("50% tests passed, @f tests failed out of @t", "s = 0", (("p", "synthetic_pass_", "PASSED", 0), ("f", "synthetic_fail_", "FAILED", 0))),
    "gtest": ("[==========] @t tests from 3 suites ran.\n[  PASSED  ] @p tests.\n[  FAILED  ] @f tests, listed below:", None,
              (("p", "test_passed_", "PASSED", 1), ("f", "test_failed_", "FAILED", 1))),
    "catch2": ("test cases: @t | @p passed | @f failed", "s = 0", (("p", "test_passed_", "PASSED", 1), ("f", "test_failed_", "FAILED", 1))),
    "libsass": ("all: Passed: @p, failed: @f", None, (("p", "all_pass_", "PASSED", 1), ("f", "all_fail_", "FAILED", 1))),
    "lit": ("Expected Passes    : @p\nUnexpected Failures: @f", None, (("p", "lit_pass_", "PASSED", 1), ("f", "lit_fail_", "FAILED", 1))),
    "turbo": ("Tasks:    @p successful, @t total", "s = 0", (("p", "turbo_task_", "PASSED", 0), ("f", "turbo_task_failed_", "FAILED", 0))),
}


def _last(spark: SparkSession, folder: str) -> DataFrame:
    """(instance_id, run, n, status): the last status of each test, under a name that every runner can write."""
    rows = table(spark, folder, "test_status").where("status is not null")
    named = rows.withColumn("n", F.regexp_replace("test", "[^A-Za-z0-9_]", "_"))
    return named.groupBy("instance_id", "run", "n").agg(F.max(F.struct("pos", "status"))["status"].alias("status"))


_LAST_SQL = """
    WITH named AS (SELECT *, regexp_replace(test, '[^A-Za-z0-9_]', '_', 'g') AS n FROM test_status WHERE status IS NOT NULL),
    last AS (SELECT instance_id, run, n, status FROM (
        SELECT *, row_number() OVER (PARTITION BY instance_id, run, n ORDER BY pos DESC, status DESC) AS r FROM named) WHERE r = 1)
"""


def _filled(form: str, values: dict[str, Column]) -> Column:
    out = F.lit(form)
    for mark, value in values.items():
        out = F.replace(out, F.lit(mark), value)
    return out


def written(spark: SparkSession, folder: str, parser: str) -> DataFrame:
    """(instance_id, run, part, log): the statuses as lines of a runner's log."""
    head, lines, foot, gap, _, _ = LINES[parser]
    line = F.lit(None).cast("string")
    for status, form in lines.items():
        line = F.when(F.col("status") == status, _filled(form, {"@": F.col("n")})).otherwise(line)
    rows = _last(spark, folder).select("instance_id", "run", F.substring(F.md5("n"), 1, 2).alias("part"), line.alias("line")).where("line is not null")
    text = F.array_join(F.array_sort(F.collect_list("line")), gap)
    return rows.groupBy("instance_id", "run", "part").agg(F.concat_ws("\n", *([F.lit(head)] if head else []), text, F.lit(foot)).alias("log"))


def _read(parser: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        logs = written(spark, folder, parser)
        return testlogs.parse_logs(logs, ["instance_id", "run", "part"], "log", parser).drop("part")

    query.__name__ = f"log_{parser}"
    query.__doc__ = f"Logs in the form that the parser {parser} reads, line by line."
    return query


def _read_sql(parser: str) -> str:
    _, lines, _, _, read, named = LINES[parser]
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in read.items())
    return f"""{_LAST_SQL} SELECT instance_id, run, replace('{named}', '@', n) AS test, CASE status {cases} END AS status
        FROM last WHERE status IN ({", ".join(f"'{k}'" for k in lines)})"""


def _totals(parser: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        form, needs, _ = COUNTS[parser]
        n = lambda s: F.count_if(F.col("status") == s)
        by = _last(spark, folder).groupBy("instance_id", "run").agg(n("PASSED").alias("p"), n("FAILED").alias("f"), n("SKIPPED").alias("s"))
        by = by.withColumn("s", F.lit(0)) if needs else by
        by = by.withColumn("t", F.col("p") + F.col("f") + F.col("s"))
        log = _filled(form, {f"@{c}": F.col(c).cast("string") for c in "pfst"})
        return testlogs.parse_logs(by.select("instance_id", "run", log.alias("log")), ["instance_id", "run"], "log", parser)

    query.__name__ = f"log_totals_{parser}"
    query.__doc__ = f"Logs that give totals alone, in the form that the parser {parser} reads."
    return query


def _totals_sql(parser: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT instance_id, run, '{prefix}' || unnest(range({first}, {column} + {first})) AS test, '{status}' AS status FROM by_run"
        for column, prefix, status, first in COUNTS[parser][2]
    )
    return f"""{_LAST_SQL}, by_run AS (SELECT instance_id, run, count(*) FILTER (status = 'PASSED') AS p, count(*) FILTER (status = 'FAILED') AS f,
        count(*) FILTER (status = 'SKIPPED') AS s FROM last GROUP BY 1, 2) {parts}"""


QUERIES = (*map(_read, LINES), *map(_totals, COUNTS))
SQL = {f"log_{p}": _read_sql(p) for p in LINES} | {f"log_totals_{p}": _totals_sql(p) for p in COUNTS}
