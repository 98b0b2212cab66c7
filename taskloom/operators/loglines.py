"""Semi-structured log text into entries: timestamp, level, component, message and line range.

Every line that may start an entry is collapsed to a *shape signature* of its header: times become ``T`` (``S`` without a
year, ``G`` if a level's letter is before them), level words ``L``, numbers ``9``, names ``a``, and brackets around anything
else ``[a]``; the signature ends where words of a message begin. Each distinct signature is resolved once to the layouts
whose shape it has; the resolved signatures are broadcast, and a line tries only the layouts of its signature.
Lines of no layout are continuations of the entry before them. An output is one row and stays in its
task, so no text is shuffled; only distinct signatures are.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import prepare

ENTRY_SCHEMA = (
    "line_start bigint, line_end bigint, ts string, level string, component string, message string"
)

# Level words and the levels they mean; month names; keys of structured records.
LEVELS = {
    "TRACE": "TRACE", "DEBUG": "DEBUG", "INFO": "INFO", "WARN": "WARN", "WARNING": "WARN",
    "ERROR": "ERROR", "FATAL": "FATAL", "CRITICAL": "FATAL", "NOTICE": "INFO",
    "T": "TRACE", "D": "DEBUG", "I": "INFO", "W": "WARN", "E": "ERROR", "F": "FATAL", "C": "FATAL",
}
MONTHS = {m: i for i, m in enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(), 1)}
TIME_KEYS = ("timestamp", "time", "ts", "@timestamp", "datetime", "asctime", "date", "t")
LEVEL_KEYS = ("level", "severity", "levelname", "lvl", "log.level", "loglevel")
COMPONENT_KEYS = ("component", "logger", "target", "module", "name", "logger_name", "program", "source", "file")
MESSAGE_KEYS = ("message", "msg", "event", "text")

_WORD = "TRACE|DEBUG|INFO|NOTICE|WARNING|WARN|ERROR|FATAL|CRITICAL"
_ANSI = re.compile(r"\x1b(?:\[[0-?]*[ -/]*[@-~]|\][^\x07\x1b]*(?:\x07|\x1b\\)|[@-Z\\^_])")
_DATE = r"\d{4}[-/]\d\d[-/]\d\d[T ]\d\d:\d\d:\d\d(?:[.,]\d{1,9})?(?:Z|[+-]\d\d:?\d\d)?"
_MONTH_DATE = rf"(?:{'|'.join(MONTHS)}) [ \d]\d \d\d:\d\d:\d\d"
_LETTER_DATE = r"\d{4} \d\d:\d\d:\d\d\.\d+"
_LEVEL = rf"(?i:{_WORD})"
_NAME = r"[^\s:\[\]]+(?:::[^\s:\[\]]+)*"
#: A name that may stand before a message without a mark between them: one of several parts.
_PARTED = r"[^\s:\[\]]+(?:(?:\.|::)[^\s:\[\]]+)+"

#: Layouts: (name, shape a signature must start with, extraction with the groups ts, level, component).
LAYOUTS: list[tuple[str, str, str]] = [
    ("bracket_time_in", r"\[T\] L a", rf"\[(?P<ts>{_DATE})\] +(?P<level>{_LEVEL}) +in +(?P<component>[^\s:]+): ?"),
    ("bracket_time_level", r"\[T L ", rf"\[(?P<ts>{_DATE}) +(?P<level>{_LEVEL}) +(?P<component>{_NAME})\] ?"),
    ("letter_date", r"G 9 ", rf"(?P<level>[TDIWEFC])(?P<ts>{_LETTER_DATE}) +\d+ +(?P<component>[^\s:\]]+):\d+\] ?"),
    ("time_level_pid_thread", r"T L 9 - ", rf"(?P<ts>{_DATE}) +(?P<level>{_LEVEL}) +\d+ +--- +\[[^\]]*\] +(?P<component>\S+) *: ?"),
    ("dashed", r"T - ", rf"(?P<ts>{_DATE}) +- +(?P<component>\S+) +- +(?P<level>{_LEVEL}) +- ?"),
    ("time_thread_level", r"T \[a\] L ", rf"(?P<ts>{_DATE}) +\[[^\]]*\] +(?P<level>{_LEVEL}) +(?P<component>\S+) +- ?"),
    ("time_bracket_level", r"T \[L\] ", rf"(?P<ts>{_DATE}) +\[ *(?P<level>{_LEVEL}) *\] +(?P<component>{_NAME}): ?"),
    ("time_level_thread", r"T L \[a\] ", rf"(?P<ts>{_DATE}) +(?P<level>{_LEVEL}) +\[[^\]]*\] +(?P<component>{_NAME})(?: +-|:) ?"),
    ("time_level_target", r"T L ", rf"(?P<ts>{_DATE}) +(?P<level>{_LEVEL}) +(?:(?P<component>{_NAME})(?: +-|:) ?|(?P<parted>{_PARTED}) +)"),
    ("time_target", r"T [a9]", rf"(?P<ts>{_DATE}) +(?P<component>{_NAME}): ?"),
    ("brackets", r"\[T\] ?\[L\] ?\[a\]", rf"\[(?P<ts>{_DATE})\] ?\[ *(?P<level>{_LEVEL}) *\] ?\[ *(?P<component>[^\s\]]+) *\] ?"),
    ("syslog", r"S ", rf"(?P<ts>{_MONTH_DATE}) +\S+ +(?P<component>[^\s\[\]:]+)(?:\[\d+\])?: ?"),
    ("level_time_target", r"(?:L|\[L\]) (?:T|\[T\]) ",
     rf"\[? *(?P<level>{_LEVEL}) *\]? +\[?(?P<ts>{_DATE})\]? +(?:(?P<component>{_NAME})(?: +-|:) ?|(?P<parted>{_PARTED}) +)"),
    ("level_logger_file", r"L [a9]:[a9]:9", rf"(?P<level>{_LEVEL}) +(?P<component>[^\s:]+):[^\s:]+:\d+(?: |$)"),
    ("level_logger", r"L:[a9]:", rf"(?P<level>{_LEVEL}):(?P<component>[^\s:]+):"),
    ("pairs", r"a=", r""),
    ("json", r"\{", r""),
]
_EXTRACT = [re.compile(x) for _, _, x in LAYOUTS]
_SHAPES = [re.compile(s) for _, s, _ in LAYOUTS]
#: How a line that starts an entry may begin; any other has an empty signature.
_MAY_START = re.compile(rf"[\[{{]|\d{{4}}[-/]|[TDIWEFC]\d{{4}} |(?:{'|'.join(MONTHS)}) |{_LEVEL}(?!\w)|[\w.@-]+=")
_ATOMS = re.compile(
    rf"(?P<T>{_DATE}(?!\w))|(?P<S>{_MONTH_DATE})|(?P<G>[TDIWEFC]{_LETTER_DATE})|(?P<L>{_LEVEL}(?!\w|[.-]\w))"
    rf"|(?P<group>\[(?!{_DATE}| *{_LEVEL} *\])[^\[\]]*\])|(?P<number>\d\w*)"
    r"|(?P<name>[^\W\d][^\s\[\](){}:=,;\"|]*(?:::[^\s\[\](){}:=,;\"|]+)*)|(?P<gap>\s+)|(?P<mark>-+|\W)"
)
_MARKS = {"T": "T", "S": "S", "G": "G", "L": "L", "group": "[a]", "number": "9", "name": "a", "gap": " "}
_PAIR = re.compile(r'([\w.@-]+)=("(?:[^"\\]|\\.)*"|[^\s"]*)(?:\s+|$)')
_TIME = re.compile(
    r"(\d{4})[-/](\d\d)[-/](\d\d)[T ](\d\d):(\d\d):(\d\d)(?:[.,](\d{1,9}))?(Z|[+-]\d\d:?\d\d)?$"
)


def plain(line: str) -> str:
    """The line without colour codes and without the carriage return of its line end."""
    line = line.removesuffix("\r")
    return _ANSI.sub("", line).removesuffix("\r") if "\x1b" in line else line


def signature(line: str) -> str:
    """The shape of the header that a line may start with, up to the first word of a message; empty if it starts with none."""
    if not _MAY_START.match(line):
        return ""
    if line[0] == "{":
        return "{"
    out = ""
    for m in _ATOMS.finditer(line):
        mark = _MARKS.get(m.lastgroup) or m[0][0]
        if mark == " " and out[-1:] == "[" or mark == "]" and out[-2:-1] == "L" and out[-1] == " ":
            out = out.rstrip()  # padding inside brackets
            mark = mark.strip()
        out += mark
        if mark == "=":
            return "a="
        if mark == " " and (out[-2:-1] == "a" or out[-4:-1] == "9 9"):
            break
    return out


def resolve(shape: str) -> tuple[int, ...]:
    """The layouts, in order, whose shape the signature starts with."""
    return tuple(i for i, s in enumerate(_SHAPES) if s.match(shape))


def _fraction(digits: str | None) -> str:
    return ((digits or "") + "000000")[:6]


def _instant(text: str, year: int | None) -> str | None:
    """A written time as UTC; None if it isn't a valid time or needs a year that is not known."""
    try:
        if m := _TIME.match(text):
            y, mo, d, h, mi, s, frac, zone = m.groups()
            at = datetime(int(y), int(mo), int(d), int(h), int(mi), min(int(s), 59))
            if zone and zone != "Z":
                shift = timedelta(hours=int(zone[1:3]), minutes=int(zone[-2:]))
                at += -shift if zone[0] == "+" else shift
            return f"{at:%Y-%m-%d %H:%M:%S}.{_fraction(frac)}"
        if year is None:
            return None
        if text[0].isdigit():  # MMdd HH:mm:ss.ffffff
            month, day, clock = int(text[:2]), int(text[2:4]), text[5:]
        else:
            month, day, clock = MONTHS.get(text[:3], 0), int(text[4:6]), text[7:]
        at = datetime(year, month, day, int(clock[:2]), int(clock[3:5]), min(int(clock[6:8]), 59))
        return f"{at:%Y-%m-%d %H:%M:%S}.{_fraction(clock[9:])}"
    except (ValueError, OverflowError):
        return None


def _epoch(value: float) -> str | None:
    """Seconds, or milliseconds, microseconds or nanoseconds by magnitude, since 1970."""
    try:
        micros = int(value * 1_000_000) if value < 1e11 else int(value) * 1000
        if value >= 1e14:
            micros = int(value) if value < 1e17 else int(value) // 1000
        return f"{datetime.fromtimestamp(0, UTC) + timedelta(microseconds=micros):%Y-%m-%d %H:%M:%S.%f}"
    except (ValueError, OverflowError):
        return None


def _structured(fields: dict[str, object]) -> tuple[str | None, str | None, str, str] | None:
    """ts, level, component, message of a record of named fields; None if it isn't a log record."""

    def first(keys: tuple[str, ...]) -> object:
        return next((fields[k] for k in keys if fields.get(k) not in (None, "")), None)

    component, level, at = first(COMPONENT_KEYS), first(LEVEL_KEYS), first(TIME_KEYS)
    level = LEVELS.get(str(level).upper()) if level is not None else None
    if isinstance(at, str):
        at = _epoch(float(at)) if re.fullmatch(r"\d{10,19}(?:\.\d+)?", at) else _instant(at, None)
    elif isinstance(at, int | float) and not isinstance(at, bool):
        at = _epoch(at)
    else:
        at = None
    if not isinstance(component, str) or (level is None and at is None):
        return None
    message = first(MESSAGE_KEYS)
    if message is None and isinstance(fields.get("fields"), dict):
        message = next((fields["fields"][k] for k in MESSAGE_KEYS if k in fields["fields"]), None)
    return at, level, component, "" if message is None else str(message)


def header(line: str, layouts: tuple[int, ...], year: int | None) -> tuple[str | None, str | None, str, str] | None:
    """ts, level, component and message of a line that starts an entry by one of the layouts."""
    for i in layouts:
        name = LAYOUTS[i][0]
        if name == "json":
            try:
                fields = json.loads(line)
            except ValueError:
                continue
            if isinstance(fields, dict) and (got := _structured(fields)):
                return got
        elif name == "pairs":
            fields, at = {}, 0
            while m := _PAIR.match(line, at):
                value = m[2]
                if value[:1] == '"':
                    value = re.sub(r"\\(.)", lambda e: {"n": "\n", "t": "\t"}.get(e[1], e[1]), value[1:-1])
                fields.setdefault(m[1], value)
                at = m.end()
            if at == len(line) and (got := _structured(fields)):
                return got
        elif m := _EXTRACT[i].match(line):
            parts = m.groupdict()
            level = parts.get("level")
            ts = parts.get("ts")
            component = parts["component"] or parts.get("parted")
            return ts and _instant(ts, year), level and LEVELS[level.upper()], component, line[m.end() :]
    return None


def entries(text: str | None, year: int | None, rules: dict[str, tuple[int, ...]] | None) -> Iterator[tuple]:
    """(line_start, line_end, ts, level, component, message) of each entry of one output.

    rules: resolved signatures; None to resolve in place (each worker remembers what it resolved).
    """
    if not text:
        return
    start = end = 0
    head: tuple = ()
    rest: list[str] = []
    for n, raw in enumerate(text.split("\n"), 1):
        line = plain(raw)
        found = None
        if line[:1] not in ("", " ", "\t"):
            layouts = _resolved(signature(line)) if rules is None else rules.get(signature(line))
            found = header(line, layouts, year) if layouts else None
        if found:
            if start:
                yield start, end, *head, "\n".join([head_message, *rest[: end - start]])
            start = end = n
            *head, head_message = found
            rest = []
        elif start:
            rest.append(line)
            if line.strip():
                end = n
    if start:
        yield start, end, *head, "\n".join([head_message, *rest[: end - start]])


@lru_cache(maxsize=65536)
def _resolved(shape: str) -> tuple[int, ...]:
    return resolve(shape)


def signatures(outputs: DataFrame, text: str) -> DataFrame:
    """(signature, layouts): every distinct signature that has a layout, resolved once."""

    def shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = set()
            for value in batch.iloc[:, 0]:
                for raw in (value or "").split("\n"):
                    line = plain(raw)
                    if line[:1] not in ("", " ", "\t"):
                        seen.add(signature(line))
            yield pd.DataFrame({"signature": sorted(seen)}, dtype=object)

    def resolving(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            layouts = [list(resolve(s)) for s in batch["signature"]]
            out = pd.DataFrame({"signature": batch["signature"], "layouts": layouts})
            yield out[out["layouts"].map(bool)]

    return (
        outputs.select(F.col(text).alias("__text"))
        .mapInPandas(shapes, "signature string")
        .distinct()
        .mapInPandas(resolving, "signature string, layouts array<int>")
    )


def log_entries(
    outputs: DataFrame,
    id_col: str = "output_id",
    text_col: str = "output",
    captured_col: str = "captured_at",
    max_broadcast_rules: int = 50_000,
) -> DataFrame:
    """One row per log entry: id, line_start, line_end, ts, level, component, message.

    Lines end with a line feed and count from 1; a carriage return before it and colour codes belong
    to no field. A null or empty output, and one without any header line, gives no row; lines before
    the first entry belong to none; blank lines at an entry's end are left out; equal rows give equal
    entries; a null ``captured_col`` leaves times without a year null. Extra columns are ignored.

    The resolved signatures are broadcast if there are at most ``max_broadcast_rules``; beyond that
    every worker resolves the signatures that it meets itself, with the same result.
    """
    spark = prepare(outputs.sparkSession)
    rows = signatures(outputs, text_col).limit(max_broadcast_rules + 1).collect()
    shared = None
    if len(rows) <= max_broadcast_rules:
        shared = spark.sparkContext.broadcast({r["signature"]: tuple(r["layouts"]) for r in rows})
    kind = dict(outputs.dtypes)[id_col]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules = None if shared is None else shared.value
        columns = ["id", "line_start", "line_end", "ts", "level", "component", "message"]
        for batch in batches:
            found: list[tuple] = []
            for key, text, year in zip(batch["__id"], batch["__text"], batch["__year"], strict=True):
                found += ((key, *e) for e in entries(text, None if pd.isna(year) else int(year), rules))
                if len(found) >= 20_000:
                    yield pd.DataFrame(found, columns=columns)
                    found = []
            yield pd.DataFrame(found, columns=columns)

    picked = outputs.select(
        F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.year(captured_col).alias("__year")
    )
    return picked.mapInPandas(parse, f"id {kind}, {ENTRY_SCHEMA}").withColumnRenamed("id", id_col)
