"""Column functions shared by operators: hash order, globs, identity grammar, text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_order(seed: int, *keys: Column) -> Column:
    """A reproducible pseudo-random order: the same on every cluster and in SQL as ``md5(seed || '|' || keys)``."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *keys))


def hash_unit(seed: int, *keys: Column) -> Column:
    """A reproducible number in [0, 1): the first 7 hexadecimal digits of the hash order."""
    return F.conv(F.substring(hash_order(seed, *keys), 1, 7), 16, 10).cast("double") / F.lit(float(16**7))


def glob_pattern(glob: str) -> str:
    """A shell pattern (``*``, ``?``, ``[...]``) as a regular expression for a whole value."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        end = glob.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif end > 0:
            inside = glob[i + 1 : end].replace("\\", "\\\\")
            out.append(f"[^{inside[1:]}]" if inside[:1] == "!" else f"[{inside}]")
            i = end
        else:
            out.append(re.sub(r"([\\.^$|()\[\]{}+*?])", r"\\\1", c))
        i += 1
    return "(?s)^" + "".join(out) + "$"


def matches_any(value: Column, patterns: list[str] | None) -> Column:
    """True for every value if there's no list; else equal to an item or matched by it; none for an empty list."""
    if patterns is None:
        return F.lit(True)
    if not patterns:
        return F.lit(False)
    globs = [p for p in patterns if re.search(r"[*?\[]", p)]
    found = value.isin(patterns)
    if globs:
        found = found | value.rlike("|".join(f"(?:{glob_pattern(g)})" for g in globs))
    return F.coalesce(found, F.lit(False))


def repo_part(instance_id: Column) -> Column:
    """The id up to its last dot: owner, repository and commit."""
    return F.regexp_replace(instance_id, r"\.[^.]*$", "")


def bug_type(instance_id: Column) -> Column:
    """What follows the last dot, up to its last underscore; every procedural type is ``func_pm``."""
    kind = F.regexp_replace(F.regexp_extract(instance_id, r"([^.]*)$", 1), r"_[^_]*$", "")
    return F.when(kind.startswith("func_pm"), F.lit("func_pm")).otherwise(kind)


def modifier(instance_id: Column) -> Column:
    """What stands between the last dot and the last ``__``; for an id without a type after the dot, its owner."""
    return F.regexp_extract(F.regexp_replace(instance_id, r"__(?!.*__).*$", ""), r"([^.]*)$", 1)


def truncated(text: Column, n_tokens: Column, most: int, head: int, tail: int) -> Column:
    """Head and tail of texts of more than ``most`` tokens (the caller counts tokens), others as they are."""
    cut = F.concat(F.substring(text, 1, head), F.lit("\n\n(...)\n\n"), F.right(text, F.lit(tail)))
    return F.when(n_tokens > most, cut).otherwise(text)


def code_block(text: Column) -> Column:
    """The body of the first fenced code block, stripped; empty if there's none."""
    return F.trim(F.regexp_extract(text, r"(?s)```(?:\w+)?\n(.*?)\n?```", 1))


def json_in(text: Column) -> Column:
    """JSON in free text: a fenced block, else what stands between the outer braces, else all of it."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    braces = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.coalesce(F.nullif(fenced, F.lit("")), F.nullif(braces, F.lit("")), text)


def strip_ansi(text: Column) -> Column:
    return F.regexp_replace(text, "\u001b\\[[0-9;]*[A-Za-z]", "")


def occurrences(text: Column, piece: str) -> Column:
    """How often ``piece`` occurs without overlap; 0 for null."""
    gone = F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))
    return F.coalesce(gone / len(piece), F.lit(0)).cast("int")


def has_any(text: Column, pieces: list[str]) -> Column:
    """Whether one of the pieces occurs literally."""
    found = F.lit(False)
    for p in pieces:
        found = found | F.contains(text, F.lit(p))
    return found
