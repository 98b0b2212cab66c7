"""Test logs into rows of (test, status), by parsers that are rows of a registry.

A parser is data: line rules (a pattern with the groups ``n`` for the test's name and ``s`` for a word
that gives the status), an optional header whose name is carried into the lines below it, and summaries
that stand for tests without names. A log is one row and is parsed in its task; the last write of a
test wins there, so logs aren't exploded into shuffled lines.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ElementTree
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import prepare

P, FAIL, S, E, X = "PASSED", "FAILED", "SKIPPED", "ERROR", "XFAIL"
_ANSI = re.compile(r"\x1b\[[0-9;]*[A-Za-z]|\[\d+m")

# Markers around a run's output, and texts of runs that have none.
START, END = ">>>>> Start Test Output", ">>>>> End Test Output"
NO_OUTPUT = (">>>>> Patch Apply Failed", ">>>>> Tests Timed Out")


@dataclass(frozen=True)
class Rule:
    """A line that gives a test's status: one status, or one by the lower-case word in group ``s``."""

    pattern: str
    status: str | dict[str, str]
    name: str = "{n}"
    clean: str = ""  #: what is removed from the name


@dataclass(frozen=True)
class Count:
    """Synthetic tests ``prefix + number`` for a number in the log: of its first match, or the greatest."""

    pattern: str
    names: tuple[tuple[str, str, str], ...]  #: (arithmetic over groups, prefix, status)
    first: int = 1
    greatest: bool = False
    always: bool = False  #: else only if no line named a test
    needs: str = ""  #: what must occur somewhere in the log


@dataclass(frozen=True)
class Parser:
    rules: tuple[Rule, ...] = ()
    header: str = ""
    counts: tuple[Count, ...] = ()
    strip: bool = True
    ansi: bool = False
    all_lines: bool = False  #: every line break counts, not the line feed alone
    keep_first: bool = False
    special: Callable[[str], dict[str, str]] | None = None
    otherwise: tuple[str, ...] = ()  #: parsers to try if this one finds nothing


def _rspec(log: str) -> dict[str, str]:
    start = re.search(r'\{"(?:version|examples)', log)
    end = log.rfind("}")
    if not start or end < start.start():
        return {}
    try:
        found = json.loads(log[start.start() : end + 1])
    except ValueError:
        return {}
    kinds, out = {"passed": P, "failed": FAIL}, {}
    for example in found.get("examples", []):
        name, status = (example.get("full_description") or "").strip(), kinds.get(example.get("status"))
        if name and status:
            out[name] = status
    return out


def _junit(log: str) -> dict[str, str]:
    out = {}
    for document in re.findall(r"<\?xml version.*?</testsuite>", log, re.S):
        try:
            suite = ElementTree.fromstring(document)
        except ElementTree.ParseError:
            continue
        for case in suite.iter("testcase"):
            kinds = {child.tag for child in case}
            name = f"{case.get('classname', suite.get('name', ''))}.{case.get('name', '')}"
            out[name] = FAIL if kinds & {"failure", "error"} else S if "skipped" in kinds else P
    return out


def _sections(log: str) -> dict[str, str]:
    """Sections named between stars pass as long as there are pass banners for them."""
    passed = log.count("ALL TESTS PASSED")
    found = {n: P if i < passed else FAIL for i, n in enumerate(re.findall(r"\*\*\*\s+(.*?)\s+\*\*\*", log))}
    return found or ({"all_tests": P} if passed else {})


def _comparisons(log: str) -> dict[str, str]:
    """Each compared file passes; where the run broke off, the last one failed."""
    names = list(dict.fromkeys(re.findall(r"(?m)^\s*cmp\s+\S+/(\S+?)\.check\.out\s", log)))
    out = dict.fromkeys(names, P)
    if names and ("make: ***" in log or "Error" in log.split("\n")[-1]):
        out[names[-1]] = FAIL
    return out


def _boost(log: str) -> dict[str, str]:
    failed = set(re.findall(r'(?i)error(?:\s+in)?\s+"([^"]+)"', log))
    every = set(re.findall(r'Entering test (?:case|suite) "([^"]+)"', log))
    out = {n: FAIL if n in failed else P for n in every | failed}
    if not out and "*** No errors detected" in log and not re.search(r"(?i)\d+\s+test cases?\s+(?:out of \d+ )?passed", log):
        return {"boost_test_suite": P}
    return out


def _named_failures(named: str, total: str, prefix: str) -> Callable[[str], dict[str, str]]:
    """Failures by name, and as many passes without a name as the total leaves."""

    def run(log: str) -> dict[str, str]:
        failed = dict.fromkeys(re.findall(named, log, re.M), FAIL)
        sums = [int(x) for m in re.finditer(total, log, re.M) for x in [m["t"]] if x]
        return failed | {f"{prefix}{i + 1}": P for i in range((sums[-1] if sums else 0) - len(failed))}

    return run


def _lit(log: str) -> dict[str, str]:
    out = dict.fromkeys(re.findall(r"(?m)^\s*FAIL:\s+\S+\s+::\s+(.+?)\s+\(\d+\s+of\s+\d+\)", log), FAIL)
    count = lambda *ps: next((int(m[1]) for p in ps if (m := re.search(p + r"\s*:\s*(\d+)", log))), 0)
    unnamed = count("Unexpected Failures", "Failed") - len(out)
    out |= {f"lit_pass_{i + 1}": P for i in range(count("Expected Passes", "Passed"))}
    return out | {f"lit_fail_{i + 1}": FAIL for i in range(unnamed)}


def _unittest_totals(log: str) -> dict[str, str]:
    ran = re.search(r"(?m)^\s*Ran (\d+) tests?", log)
    total = int(ran[1]) if ran else 0
    line = next((x for x in log.split("\n") if "FAILED" in x and "failures=" in x), None)
    if line is None:
        return {f"test_{i + 1}": P for i in range(total)}
    bad = sum(int(m[1]) for m in re.finditer(r"(?:failures|errors)=(\d+)", line))
    return {f"test_pass_{i + 1}": P for i in range(max(0, total - bad))} | {f"test_fail_{i + 1}": FAIL for i in range(bad)}


def _ctest(log: str) -> dict[str, str]:
    pattern = r"(?i)\s*\d+/\d+\s+Test\s+#\d+:\s+([\w\-/.]+)\s+\.+\s+(Passed|Failed)"
    out = {m[1]: P if m[2].lower() == "passed" else FAIL for m in re.finditer(pattern, log)}
    if listed := re.search(r"The following tests FAILED:\n((?:\s+\d+\s+-\s+[\w\-/.]+.*\n?)+)", log):
        out |= dict.fromkeys(re.findall(r"\d+\s+-\s+([\w\-/.]+)", listed[1]), FAIL)
    return out


def _catch_xml(log: str) -> dict[str, str]:
    pattern = r'(?s)<TestCase\s+name="([^"]+)"[^>]*>.*?<OverallResult\s+success="(true|false)"'
    return {m[1]: P if m[2] == "true" else FAIL for m in re.finditer(pattern, log)}


def _libsass(log: str) -> dict[str, str]:
    out = {}
    for n, good, bad in re.findall(r"(?m)^\s*(\S+):\s+Passed:\s*(\d+),\s*failed:\s*(\d+)", log):
        out |= {f"{n}_pass_{i + 1}": P for i in range(int(good))} | {f"{n}_fail_{i + 1}": FAIL for i in range(int(bad))}
    return out


def _turbo(log: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in log.split("\n"):
        if m := re.match(r"\s*(\S+?:test\S*)\s*:", line):
            out.setdefault(m[1], P)
        task, colon, _ = line.partition(":")
        if colon and "ERROR" in line and "test" in task.lower():
            out[task.strip()] = FAIL
    return out


_WORDS = {"passed": P, "failed": FAIL, "skipped": S, "error": E, "xfail": X}
_STATUS = "PASSED|FAILED|SKIPPED|ERROR|XFAIL"
_TIME = r"(?:\s\(\d+\s*m?s\))?"
_TICKS = {"✓": P, "✔": P, "✕": FAIL, "✖": FAIL, "✗": FAIL, "❯": FAIL, "✘": FAIL, "○": S, "↩": S, "-": S}
_COLON = {"pass": P, "fail": FAIL}
_NO_TOTAL = r"(?!\d+(?![\w:/.]))(?!.*\d+\s+tests?[.,])"

# The line shapes of test runners and what they mean.
PARSERS: dict[str, Parser] = {
    "pytest": Parser((Rule(rf"(?P<n>\S+)\s+(?P<s>{_STATUS})", _WORDS),), strip=False),
    "pytest_xdist": Parser((Rule(rf"\[gw\d\]\s(?P<s>{_STATUS})\s(?P<n>\S+)", _WORDS),), strip=False),
    "pytest_summary": Parser((Rule(rf"(?P<s>{_STATUS})\s(?P<n>\S+)", _WORDS),), strip=False),
    "unittest_dots": Parser((
        Rule(r"(?P<n>[a-zA-Z0-9_\-,.\s()']+)\s\.{3}\s(?P<s>ok|FAIL|ERROR)$", {"ok": P, "fail": FAIL, "error": E}),), strip=False),
    "unittest_lines": Parser((
        Rule(r"(?P<n>.*?) \.\.\. (?:.*\.\.\. )?ok$", P), Rule(r"(?P<n>.*?) \.\.\. skipped ", S),
        Rule(r"(?:ERROR|FAIL):\s*(?P<n>\S+(?:\s+\S+)?)", FAIL)), strip=False),
    "status_anywhere": Parser((Rule(r"(?=.*PASSED).*?(?P<n>\S+)\s*$", P), Rule(r"(?=.*FAILED).*?(?P<n>\S+)\s*$", FAIL)), strip=False),
    "go": Parser((
        Rule(r"--- (?P<s>PASS|FAIL): (?P<n>\S+)", _COLON), Rule(r"FAIL:?\s?(?P<n>.+?)\s", FAIL), Rule(r"--- SKIP: (?P<n>\S+)", S))),
    "cargo": Parser((
        Rule(r"(?:test )?(?P<n>.*?) \.\.\. ok", P), Rule(r"(?:test )?(?P<n>.*?) \.\.\. FAILED", FAIL)), strip=False, all_lines=True),
    "rspec_json": Parser(special=_rspec),
    "minitest": Parser((
        Rule(r"(?P<n>.*#test_.*?) = (?:.* = )?(?P<s>[.FE])$", {".": P, "f": FAIL, "e": E}),
        Rule(r"(?P<n>\S+):\s+(?P<s>[.FE]):\s+\(", {".": P, "f": FAIL, "e": E}, name="{c}#{n}")),
        header=r"(?P<c>[A-Z]\S*):$", all_lines=True),
    "ruby": Parser(special=_rspec, otherwise=("minitest",)),
    "surefire": Parser((
        Rule(r"\[ERROR\]\s+(?P<n>.*?)\s+--\s+Time elapsed:\s+[\d.]+\s.*<<< FAILURE!$", FAIL),
        Rule(r"\[(?:INFO|ERROR)\]\s+(?P<n>.*?)\s+--\s+Time elapsed:\s+[\d.]+\s", P),
        Rule(r"(?P<n>[a-zA-Z0-9_]+)\((?P<k>[a-zA-Z0-9_.]+)\)\s+Time elapsed:\s+[\d.]+\s+sec", P, name="{k}.{n}"))),
    "junit_xml": Parser(special=_junit),
    "phpunit": Parser((Rule(r"\s*(?P<s>[✔✘↩])\s*(?P<n>.+)$", _TICKS, name="{c}::{n}"),), header=r".+\((?P<c>.+)\)\s*$", strip=False),
    "dotnet": Parser((Rule(r"(?P<s>Passed|Failed|Skipped)\S*\s+(?P<n>\S+)", _WORDS),)),
    "colon": Parser((Rule(r"(?P<s>PASS|FAIL):\s(?P<n>.+)$", _COLON),)),
    "bracket": Parser((
        Rule(rf"\[(?P<s>ok|skip|ignore)\]:\s(?P<n>.+?){_TIME}$", {"ok": P, "skip": S, "ignore": S}),
        Rule(rf"\[err\]:\s(?P<n>.+?){_TIME}$", FAIL, clean=r"\s+in\s+\S+$"))),
    "jest": Parser((Rule(rf"(?P<s>[✓✕○])\s(?P<n>.+?){_TIME}$", _TICKS),)),
    "mocha": Parser((Rule(rf"(?P<s>[✓✔✖-])\s(?P<n>.+?){_TIME}$", _TICKS), Rule(rf"\d+\)\s+(?P<n>.+?){_TIME}$", FAIL))),
    "vitest": Parser((Rule(r"(?P<s>[✓❯✗○])\s+(?P<n>.+?)$", _TICKS, clean=r"\s*\(.*$"),)),
    "karma": Parser(counts=(
        Count(r"Executed\s+(\d+)\s+of\s+\d+\s+SUCCESS", (("1", "karma_unit_test_", P),), greatest=True, always=True),
        Count(r"Executed\s+\d+\s+of\s+\d+\s+\((\d+)\s+FAILED\)", (("1", "karma_unit_test_failed_", FAIL),), greatest=True, always=True),
        Count(r"Executed\s+\d+\s+of\s+\d+\s+\((\d+)\s+skipped\)", (("1", "karma_unit_test_skipped_", S),), greatest=True, always=True))),
    "jasmine": Parser(counts=(Count(
        r"(\d+)\s+specs?,\s+(\d+)\s+failures?(?:,\s+(\d+)\s+pending\s+specs?)?",
        (("1-2-3", "jasmine_spec_", P), ("2", "jasmine_spec_failed_", FAIL), ("3", "jasmine_spec_pending_", S))),)),
    "tick_ms": Parser((
        Rule(r"\s*(?P<s>[✓✗])\s(?P<n>.*)\s\d+ms", _TICKS), Rule(r"\s*(?P<s>[✖✓])\s(?P<n>.*)", _TICKS)), strip=False),
    "node_test": Parser((Rule(r"\s*(?P<s>[✖✔])\s(?P<n>.*?)\s\([.\d]+ms\)", _TICKS),), strip=False),
    "turbo": Parser(special=_turbo, counts=(Count(
        r"Tasks:\s+(\d+)\s+successful,\s+(\d+)\s+total", (("1", "turbo_task_", P), ("2-1", "turbo_task_failed_", FAIL)), first=0),)),
    "mocha_summary": Parser((Rule(rf"(?P<s>[✓✔✖-])\s(?P<n>.+?){_TIME}$", _TICKS), Rule(rf"\d+\)\s+(?P<n>.+?){_TIME}$", FAIL)), counts=(
        Count(r"(\d+)\s+passing", (("1", "test_", P),), first=0), Count(r"(\d+)\s+failing", (("1", "test_failed_", FAIL),), first=0))),
    "lit": Parser(special=_lit),
    "autotools": Parser((Rule(r"(?P<s>PASS|FAIL|XFAIL|SKIP|ERROR):\s+(?P<n>.+)",
                              {"pass": P, "xfail": P, "skip": S, "fail": FAIL, "error": FAIL}),)),
    "bun": Parser((Rule(r"\((?P<s>pass|fail)\)\s+(?P<n>.+?)\s*(?:\[.*\])?\s*$", _COLON),)),
    "pycdc": Parser((Rule(r"\*\*\*\s+(?P<n>\S+?):*:\s+(?P<s>PASS|XFAIL|FAIL)\s", {"pass": P, "xfail": P, "fail": FAIL}),), ansi=True),
    "jakttest": Parser((Rule(r"\[\s*(?P<s>FAIL|SKIP)\s*\]\s+(?P<n>.+)", {"fail": FAIL, "skip": S}),), ansi=True,
                       counts=(Count(r"(?m)^(\d+)\s+passed", (("1", "jakt_pass_", P),), always=True),)),
    "kakoune": Parser((
        Rule(r"(?=.*\[32m)(?P<n>.*)", P, clean=_ANSI.pattern), Rule(r"(?=.*\[31m)(?!.*Summary:)(?P<n>.*)", FAIL, clean=_ANSI.pattern),
        Rule(r"(?=.*\[33m)(?!.*\[31m)(?P<n>.*)", S, clean=_ANSI.pattern)), strip=False),
    "pugixml": Parser(special=_named_failures(
        r"^Test (\S+) failed:", r"^(?:(?:FAILURE|Success):\s*\d+\s+out of\s+|Success:\s*)(?P<t>\d+)(?:\s+tests?\s+(?:failed|passed))", "test_passed_")),
    "coost": Parser((Rule(r"\s*case\s+(?P<n>\S+):", P, name="{c}::{n}"), Rule(r"(?i)(?=.*failed)(?=.*EXPECT)(?P<n>)", FAIL, name="{c}")),
                    header=r">\s*begin test:\s+(?P<c>\S+)", ansi=True, counts=(Count(r"All tests passed", (("0", "all", P),)),)),
    "unittest_totals": Parser(special=_unittest_totals),
    "redis_tcl": Parser((Rule(r"\[(?P<s>ok|err)\]:\s+(?P<n>.+)", {"ok": P, "err": FAIL}),)),
    "async_profiler": Parser((Rule(r"(?P<s>PASS|FAIL)\s+\[\d+/\d+\]\s+(?P<n>\S+)", _COLON),)),
    "i2pd": Parser((Rule(r"Running (?P<n>test-\S+)", P),)),
    "fastllm": Parser((Rule(r"test (?P<n>\S+) finished!", P),)),
    "libsass": Parser(special=_libsass),
    "ugrep": Parser(special=_sections),
    "fswatch": Parser(counts=(Count(r"(\d+)\s+tests?,\s+(\d+)\s+passing", (("2", "test_pass_", P), ("1-2", "test_fail_", FAIL))),)),
    "tippecanoe": Parser(special=_comparisons),
    "platformio": Parser((Rule(r"(?P<n>\S+)\s+(?P<s>SUCCESS|FAILED)\s+\d", {"success": P, "failed": FAIL}),)),
    "ctest": Parser(special=_ctest, counts=(Count(
        r"(?i)\d+%\s+tests\s+passed,\s+(\d+)\s+tests\s+failed\s+out\s+of\s+(\d+)",
        (("2-1", "synthetic_pass_", P), ("1", "synthetic_fail_", FAIL)), first=0),)),
    "gtest": Parser((
        Rule(rf"\[\s*(?P<s>OK|PASSED|SKIPPED|DISABLED)\s*\]\s+{_NO_TOTAL}(?P<n>[\w:/.]+)", {"ok": P, "passed": P, "skipped": S, "disabled": S}),
        Rule(rf"\[\s*FAILED\s*\]\s+{_NO_TOTAL}(?P<n>[\w:/.]+)(?:\s+\(|$)", FAIL)), counts=(
        Count(r"\[\s*PASSED\s*\]\s*(\d+)\s+tests?", (("1", "test_passed_", P),), needs=r"\[\s*=+\s*\]\s*\d+\s+tests?\s+from"),
        Count(r"\[\s*FAILED\s*\]\s*(\d+)\s+tests?", (("1", "test_failed_", FAIL),), needs=r"\[\s*=+\s*\]\s*\d+\s+tests?\s+from"))),
    "catch2": Parser(special=_catch_xml, otherwise=("catch2_text",)),
    "catch2_text": Parser((Rule(r"(?i)(?P<n>[^.:\[\]]+?)\s*\.\.\.\s*(?P<s>PASSED|FAILED)", _WORDS),), counts=(
        Count(r"(?i)test cases:\s*\d+\s*\|\s*(\d+)\s*passed\s*\|\s*(\d+)\s*failed", (("1", "test_passed_", P), ("2", "test_failed_", FAIL))),
        Count(r"(?i)All tests passed\s*\(.*?(\d+)\s+test cases?\)", (("1", "test_passed_", P),)))),
    "boost": Parser(special=_boost, counts=(
        Count(r"(?is)(?=.*\*\*\* No errors detected).*?(\d+)\s+test cases?\s+(?:out of \d+ )?passed", (("1", "test_passed_", P),)),
        Count(r"\*\*\* (\d+) failures? detected", (("1", "test_failed_", FAIL),)))),
    "pytest_fixed": Parser((Rule(r"(?P<n>\S+)\s+(?P<s>PASSED|FAILED|SKIPPED|ERROR)", _WORDS),), strip=False),
    "qtest": Parser((
        Rule(r"PASS\s+:\s+(?P<n>.+?)(?:\s*\(.*?\))?\s*$", P), Rule(r"FAIL!\s+:\s+(?P<n>.+?)(?:\s+.*)?\s*$", FAIL),
        Rule(r"SKIP\s+:\s+(?P<n>.+?)(?:\s+.*)?\s*$", S)), strip=False),
    "cppunit": Parser(counts=(
        Count(r"OK \((\d+)\)", (("1", "test_", P),), first=0),
        Count(r"(?s)FAILURES!!!.*?Tests run: (\d+),\s+Failures: (\d+)", (("1-2", "test_", P), ("2", "test_fail_", FAIL)), first=0))),
}

_COMPILED = {k: ([re.compile(r.pattern) for r in p.rules], re.compile(p.header) if p.header else None) for k, p in PARSERS.items()}


def _counted(count: Count, log: str) -> dict[str, str]:
    found = [[m[0], *m.groups()] for m in re.finditer(count.pattern, log)]
    if not found:
        return {}
    number = lambda groups, i: int(groups[i] or 0)
    groups = max(found, key=lambda g: number(g, 1)) if count.greatest else found[0]
    out = {}
    for sums, prefix, status in count.names:
        if sums == "0":
            out[prefix] = status
            continue
        plus, *minus = (number(groups, int(i)) for i in sums.split("-"))
        out |= {f"{prefix}{i + count.first}": status for i in range(plus - sum(minus))}
    return out


def parse_log(log: str | None, name: str) -> dict[str, str]:
    """Test -> status of one log; the last write wins. Nothing for null, empty and foreign logs."""
    if not log:
        return {}
    parser, (patterns, header) = PARSERS[name], _COMPILED[name]
    text = _ANSI.sub("", log) if parser.ansi else log
    out = dict(parser.special(text)) if parser.special else {}
    carried = None
    if parser.rules:
        for raw in text.splitlines() if parser.all_lines else text.split("\n"):
            line = raw.strip() if parser.strip or parser.all_lines else raw
            if header and (m := header.match(line)):
                carried = m["c"].strip()
                continue
            for rule, pattern in zip(parser.rules, patterns, strict=True):
                if not (m := pattern.match(line)):
                    continue
                if "{c}" in rule.name and carried is None and name == "minitest":
                    continue
                test = re.sub(rule.clean, "", m["n"]).strip() if rule.clean else m["n"].strip()
                form = rule.name if carried is not None or "{c}" not in rule.name else "{n}"
                test = form.format(n=test, c=carried, k=m.groupdict().get("k"))
                status = rule.status if isinstance(rule.status, str) else rule.status[m["s"].lower()]
                if test:
                    out[test] = status
                break
    counted = not out  # totals stand for tests only if no line named one
    for count in parser.counts:
        if (count.always or counted) and (not count.needs or re.search(count.needs, text)):
            out |= _counted(count, text)
    for other in parser.otherwise:
        out = out or parse_log(log, other)
    return out


def marked_output(log: Column) -> Column:
    """What stands between the markers of a run's log, in one traced form of them; the whole log if a marker is
    missing (see ``has_output``); null if the patch failed or the run timed out. Reversed markers fail the job."""
    start, end = f"+ : '{START}'", f"+ : '{END}'"
    i, j = F.instr(log, start), F.instr(log, end)
    none = F.contains(log, F.lit(NO_OUTPUT[0])) | F.contains(log, F.lit(NO_OUTPUT[1]))
    missing = ~F.contains(log, F.lit(START)) | ~F.contains(log, F.lit(END))
    between = F.substring(log, i + len(start), F.greatest(j - i - len(start), F.lit(0)))
    wrong = F.raise_error(F.lit("the start and end markers are in the wrong order")).cast("string")
    return F.when(none, None).when(missing, log).when(i > j, wrong).otherwise(between)


def has_output(log: Column) -> Column:
    """Whether a log has both markers and neither failed to apply its patch nor timed out."""
    none = F.contains(log, F.lit(NO_OUTPUT[0])) | F.contains(log, F.lit(NO_OUTPUT[1]))
    return F.coalesce(~none & F.contains(log, F.lit(START)) & F.contains(log, F.lit(END)), F.lit(False))


def parse_logs(logs: DataFrame, keys: list[str], log: str, parser: Column | str) -> DataFrame:
    """(keys, test, status) of every log by its parser: a name, or a column of names (a profile's).

    Null and empty logs and unknown parsers give no row. Other columns are ignored.
    """
    prepare(logs.sparkSession)
    kinds = dict(logs.dtypes)
    name = F.lit(parser) if isinstance(parser, str) else parser

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.itertuples(index=False):
                if row[-1] in PARSERS:
                    out += [(*row[:-2], t, s) for t, s in parse_log(row[-2], row[-1]).items()]
                if len(out) >= 20_000:
                    yield pd.DataFrame(out, columns=[*keys, "test", "status"])
                    out = []
            yield pd.DataFrame(out, columns=[*keys, "test", "status"], dtype=object)

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "test string", "status string"])
    return logs.select(*keys, F.col(log).alias("__log"), name.alias("__parser")).mapInPandas(run, schema)
