"""Unified diffs: parsing into files, hunks and lines, inversion, repair, application and writing.

A diff is one row and stays in its task: parsing is a map over batches, nothing is shuffled. Lines end with a line feed;
a carriage return, form feed or other break inside a line is part of its text and kept. Only the rows of ``patch_lines``
treat every break as a line end.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import prepare

_FILE = re.compile(r"^diff --git a/(.*?) b/(.*?)$")
_HUNK = re.compile(r"^@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@(.*)$", re.S)
_NO_NEWLINE = "\\ No newline at end of file"

LINE_SCHEMA = (
    "old_path string, new_path string, is_new_file boolean, is_deleted boolean, file_no int, hunk_no int, "
    "section string, line_no int, kind string, old_lineno int, new_lineno int, content string"
)


@dataclass
class Hunk:
    old_start: int
    old_lines: int
    new_start: int
    new_lines: int
    tail: str  #: what follows the ranges in the header
    body: list[str] = field(default_factory=list)

    @property
    def section(self) -> str:
        return self.tail.strip()

    def counts(self) -> tuple[int, int]:
        """Old and new lines that the body really has."""
        body = [b for b in self.body if b[:1] != "\\"]
        return sum(b[:1] != "+" for b in body), sum(b[:1] != "-" for b in body)


@dataclass
class FileDiff:
    old_path: str
    new_path: str
    head: list[str] = field(default_factory=list)
    hunks: list[Hunk] = field(default_factory=list)
    end: str = ""  #: a carriage return, if the first line ends with one

    def _named(self, line: str) -> bool:
        return any(x.rstrip("\r") == line for x in self.head)

    @property
    def is_new(self) -> bool:
        return self.old_path == "/dev/null" or self._named("--- /dev/null")

    @property
    def is_deleted(self) -> bool:
        return self.new_path == "/dev/null" or self._named("+++ /dev/null")


def parse(patch: str | None, every_break: bool = False) -> list[FileDiff]:
    """The files of a diff. Text before the first ``diff --git`` line belongs to none. Lines end with a line feed, or, with
    ``every_break``, with any of the line ends that ``str.splitlines`` knows."""
    files: list[FileDiff] = []
    text = patch or ""
    for line in text.splitlines() if every_break else text.removesuffix("\n").split("\n"):
        if m := _FILE.match(line.removesuffix("\r")):
            files.append(FileDiff(m[1], m[2], end="\r" * line.endswith("\r")))
        elif not files:
            continue
        elif m := _HUNK.match(line):
            old, new = (int(m[i]) if m[i] else 1 for i in (2, 4))
            files[-1].hunks.append(Hunk(int(m[1]), old, int(m[3]), new, m[5]))
        elif files[-1].hunks:
            files[-1].hunks[-1].body.append(line)
        else:
            files[-1].head.append(line)
    return files


def line_rows(patch: str | None) -> Iterator[tuple]:
    """A row per hunk line; blank lines and the no-newline mark are no lines."""
    for f, d in enumerate(parse(patch, every_break=True)):
        for h, hunk in enumerate(d.hunks):
            old, new, n = hunk.old_start, hunk.new_start, 0
            for line in hunk.body:
                if not line or _NO_NEWLINE in line:
                    continue
                kind = {"+": "addition", "-": "removal"}.get(line[0], "context")
                content = line[1:] if line[0] in "+- " else line
                at = (None, new) if kind == "addition" else (old, None) if kind == "removal" else (old, new)
                yield (d.old_path, d.new_path, d.is_new, d.is_deleted, f, h, hunk.section, n, kind, *at, content)
                n, old, new = n + 1, old + (kind != "addition"), new + (kind != "removal")


def _exploded(table: DataFrame, keys: list[str], text: str, rows: Callable, schema: str) -> DataFrame:
    prepare(table.sparkSession)
    kinds = dict(table.dtypes)
    names = [*keys, *(c.split()[0] for c in schema.split(", "))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                out += [(*row[:-1], *r) for r in rows(row[-1])]
                if len(out) >= 20_000:
                    yield _frame(out, names)
                    out = []
            yield _frame(out, names)

    return table.select(*keys, text).mapInPandas(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), schema]))


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series([r[i] for r in rows], dtype=object) for i, n in enumerate(names)})


def patch_lines(table: DataFrame, keys: list[str], patch: str = "patch") -> DataFrame:
    """A row per line of every hunk, with numbers in the old and the new file. Null and empty patches
    give none."""
    return _exploded(table, keys, patch, line_rows, LINE_SCHEMA)


HUNK_SCHEMA = (
    "new_path string, file_no int, hunk_no int, old_start int, old_lines int, new_start int, new_lines int, "
    "section string, real_old int, real_new int"
)


def patch_hunks(table: DataFrame, keys: list[str], patch: str = "patch") -> DataFrame:
    """A row per hunk, with the counts of its header and the counts its body really has."""

    def rows(text: str | None) -> Iterator[tuple]:
        for f, d in enumerate(parse(text)):
            for n, h in enumerate(d.hunks):
                yield (d.new_path, f, n, h.old_start, h.old_lines, h.new_start, h.new_lines, h.section, *h.counts())

    return _exploded(table, keys, patch, rows, HUNK_SCHEMA)


def text_map(column: Column, change: Callable[[str], str | None]) -> Column:
    """A batch-wise function of text; null stays null."""

    @F.pandas_udf("string")
    def apply(values: pd.Series) -> pd.Series:
        return values.map(change, na_action="ignore")

    return apply(column)


def render(files: list[FileDiff]) -> str:
    out = []
    for d in files:
        out += [f"diff --git a/{d.old_path} b/{d.new_path}{d.end}", *d.head]
        for h in d.hunks:
            out += [f"@@ -{h.old_start},{h.old_lines} +{h.new_start},{h.new_lines} @@{h.tail}", *h.body]
    return "\n".join(out) + "\n" if out else ""


#: Lines of a file's head that come in pairs, whose values change places.
_PAIRED = (("old mode ", "new mode "), ("rename from ", "rename to "), ("copy from ", "copy to "))


def _inverted_head(head: list[str]) -> list[str]:
    known = {p: x[len(p) :] for x in head for pair in _PAIRED for p in pair if x.startswith(p)}
    other = {p: q for a, b in _PAIRED for p, q in ((a, b), (b, a))}
    old, new = (next((x[4:] for x in head if x.startswith(mark)), None) for mark in ("--- ", "+++ "))
    side = lambda name, letter: name if name.rstrip("\r") == "/dev/null" else f"{letter}/{name[2:]}"
    out = []
    for line in head:
        pair = next((p for p in other if line.startswith(p) and other[p] in known), None)
        if pair:
            out.append(pair + known[other[pair]])
        elif line.startswith("--- ") and new is not None:
            out.append("--- " + side(new, "a"))
        elif line.startswith("+++ ") and old is not None:
            out.append("+++ " + side(old, "b"))
        elif line.startswith(("new file mode", "deleted file mode")):
            was, now = ("new", "deleted") if line.startswith("new") else ("deleted", "new")
            out.append(line.replace(was, now, 1))
        elif m := re.match(r"index (\S+?)\.\.(\S+)(.*)$", line, re.S):
            out.append(f"index {m[2]}..{m[1]}{m[3]}")
        else:
            out.append(line)
    return out


def inverted(patch: str) -> str:
    """The diff that undoes a diff: added and removed lines, ranges, names and file modes swap. Twice
    inverted it is the diff again (with explicit counts in the hunk headers)."""
    files = parse(patch)
    for d in files:
        d.old_path, d.new_path = d.new_path, d.old_path
        d.head = _inverted_head(d.head)
        for h in d.hunks:
            h.old_start, h.new_start = h.new_start, h.old_start
            h.old_lines, h.new_lines = h.new_lines, h.old_lines
            h.body = [{"+": "-", "-": "+"}.get(b[:1], b[:1]) + b[1:] for b in h.body]
    return render(files)


def repaired(patch: str) -> str:
    """The diff with hunk headers that count what the bodies hold; starts stay."""
    files = parse(patch)
    for d in files:
        for h in d.hunks:
            h.old_lines, h.new_lines = h.counts()
    return render(files)


def _ended(text: str) -> list[str]:
    """The lines of a text with their line feeds; the last one may have none."""
    lines = [x + "\n" for x in text.split("\n")]
    lines[-1] = lines[-1][:-1]
    return lines if lines[-1] else lines[:-1]


def apply_to(text: str, hunks: list[Hunk]) -> str | None:
    """A file's text after the hunks; None if a context or removed line isn't where the hunk says. A line feed that
    the file's last line lacks is no difference; added lines end as the hunk says."""
    lines, out, at = _ended(text), [], 0
    for h in sorted(hunks, key=lambda h: h.old_start):
        start = h.old_start - 1 if h.old_lines else h.old_start
        if start < at or start > len(lines):
            return None
        out += lines[at:start]
        at = start
        for n, b in enumerate(h.body):
            if b[:1] == "\\":
                continue
            mark, content = (b[0], b[1:]) if b and b[0] in "+- " else (" ", b)
            if mark == "+":
                if out and not out[-1].endswith("\n"):
                    out[-1] += "\n"
                out.append(content + "\n" * (h.body[n + 1 : n + 2] == [] or h.body[n + 1][:1] != "\\"))
                continue
            if at >= len(lines) or lines[at].removesuffix("\n") != content:
                return None
            if mark == " ":
                out.append(lines[at])
            at += 1
    return "".join(out + lines[at:])


def unified(path: str, before: str, after: str) -> str | None:
    """The diff of a file's two texts; None if they're the same."""
    if before == after:
        return None
    body = difflib.unified_diff(_ended(before), _ended(after), f"a/{path}", f"b/{path}")
    whole = (x if x.endswith("\n") else f"{x}\n{_NO_NEWLINE}\n" for x in body)
    return f"diff --git a/{path} b/{path}\n" + "".join(whole)


def spliced(source: str, start: int, end: int, rewrite: str, indent: int = 0) -> str | None:
    """A file with lines ``start`` to ``end`` (from 1, inclusive) replaced by an indented rewrite; None
    if the range is invalid or nothing changes."""
    lines = source.split("\n")
    if not rewrite or start < 1 or end < start or end > len(lines):
        return None
    fresh = [(" " * indent + x) if x.strip() else x for x in rewrite.rstrip("\n").split("\n")]
    out = "\n".join(lines[: start - 1] + fresh + lines[end:])
    return None if out == source else out


def similarity(a: Column, b: Column) -> Column:
    """Ratio of matching characters of two texts, 0 to 1; null if either is null."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([
            None if p is None or q is None else difflib.SequenceMatcher(None, p, q).ratio()
            for p, q in zip(x, y, strict=True)
        ], dtype=float)

    return ratio(a, b)


def is_test_part(path: Column) -> Column:
    """Whether a diff's file belongs to the test patch: a test word anywhere in its path."""
    return path.rlike("test|e2e")


def split_tests(table: DataFrame, keys: list[str], patch: str = "patch") -> DataFrame:
    """(keys, fix, tests): the files of each diff divided by path, each part a diff."""

    def rows(text: str | None) -> Iterator[tuple]:
        files = parse(text)
        tests = [d for d in files if re.search("test|e2e", d.new_path)]
        yield render([d for d in files if d not in tests]), render(tests)

    return _exploded(table, keys, patch, rows, "fix string, tests string")


SUMMARY_SCHEMA = (
    "n_files bigint, n_hunks bigint, n_added bigint, n_removed bigint, places array<string>, files array<string>, "
    "sections array<string>, functions array<string>, removed string, added string"
)


def summary_rows(patch: str | None) -> Iterator[tuple]:
    """One row for a diff that has lines: counts of files, hunks, added and removed lines; sorted distinct ``path:hunk``,
    paths, hunk headings and headings of hunks with a changed line; the removed and the added text, lines joined by a space."""
    rows = list(line_rows(patch))
    if rows:
        text = {k: [r[11] for r in rows if r[8] == k] for k in ("removal", "addition")}
        paths = {r[1] for r in rows}
        yield (
            len(paths), len({(r[4], r[5]) for r in rows}), len(text["addition"]), len(text["removal"]),
            sorted({f"{r[1]}:{r[5]}" for r in rows}), sorted(paths), sorted({r[6] for r in rows} - {""}),
            sorted({r[6] for r in rows if r[8] != "context"} - {""}), " ".join(text["removal"]), " ".join(text["addition"]),
        )


def patch_summaries(table: DataFrame, keys: list[str], patch: str = "patch") -> DataFrame:
    """A row per diff with lines, made where the diff is: nothing is exploded, shuffled or gathered."""
    return _exploded(table, keys, patch, summary_rows, SUMMARY_SCHEMA)


def changed_functions(table: DataFrame, keys: list[str], patch: str = "patch") -> DataFrame:
    """(keys, functions): sorted section headers of hunks with a changed line; diffs without one give no row."""
    return patch_summaries(table, keys, patch).where(F.size("functions") > 0).select(*keys, "functions")


def without_hunks(patch: Column, headers: list[str]) -> Column:
    """The diff cut before the first of the cosmetic hunks that ``headers`` names, its end as one line feed."""
    out = patch
    for header in headers:
        at = F.instr(out, header)
        out = F.when(at > 0, F.concat(F.rtrim(F.substring(out, F.lit(1), at - 1), F.lit(" \t\r\n\f\x0b")), F.lit("\n"))).otherwise(out)
    return out


def diagnostics(table: DataFrame, patch: str = "patch") -> DataFrame:
    """Columns has_patch, f2p_count, p2p_count, patch_files, patch_marks (``@@``, two a hunk header)."""
    size = lambda c: F.coalesce(F.array_size(c), F.lit(0))
    text = F.coalesce(patch, F.lit(""))
    return table.withColumns({
        "has_patch": F.trim(text) != "",
        "f2p_count": size("FAIL_TO_PASS"),
        "p2p_count": size("PASS_TO_PASS"),
        "patch_files": F.regexp_count(text, F.lit(r"(?m)^diff --git")),
        "patch_marks": F.regexp_count(text, F.lit("@@")),
    })
