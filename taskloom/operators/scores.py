"""Scores and ordered rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import has_any, occurrences

# Words of a pull request and the points that each adds.
COMPLEXITY_WORDS = {
    "race": 3, "deadlock": 4, "concurrent": 3, "thread": 2, "mutex": 3, "lock": 2, "async": 1, "await": 1,
    "parallel": 2, "synchronize": 3, "memory_leak": 4, "buffer_overflow": 4, "segfault": 3, "crash": 2,
    "corruption": 3, "invariant": 3, "atomic": 2, "ordering": 2, "timing": 3, "scheduler": 2, "distributed": 2,
    "consistency": 2, "refactor": 2, "architecture": 3, "redesign": 3, "breaking_change": 4,
    "backward_compatible": 3, "api_change": 2, "protocol": 2,
}
LEVELS = ((20, "expert"), (10, "hard"), (5, "medium"))
# Words that close an issue; marks of real bugs; words of visible behaviour.
CLOSING = ("close", "closes", "closed", "fix", "fixes", "fixed", "resolve", "resolves", "resolved")
REAL_MARKS = (">=", ">", "<=", "<", "==", "!=", "&&", "||", "?", "ok()", "unwrap", "expect")
BEHAVIOUR = ("filter", "permission", "check", "validate", "return", "error", "none", "some", "ok", "err")
CONTROL = ("if ", "for ", "while ", "try:", "return ", "yield ", "raise ", "except")
DIFFICULTY = {"<15 min fix": 1, "15 min - 1 hour": 5, "1-4 hours": 9}
SHORT = {"<15 min fix": "easy", "15 min - 1 hour": "medium", "1-4 hours": "hard"}


def complexity(files: Column, changed: Column, text: Column, comments: Column) -> Column:
    """Points of a pull request: files, changed lines, words of its title and body, discussion."""
    low = F.lower(text)
    words = F.lit(0)
    for word, points in COMPLEXITY_WORDS.items():
        words = words + F.when(has_any(low, sorted({word, word.replace("_", " ")})), points).otherwise(0)
    return (
        F.least(files, F.lit(5)) * 2 + F.least(F.floor(changed / 50), F.lit(10)).cast("int")
        + F.least(words, F.lit(15)) + F.when(comments >= 5, 2).otherwise(0)
    )


def level(score: Column) -> Column:
    out = F.lit("simple")
    for least, name in reversed(LEVELS):
        out = F.when(score >= least, name).otherwise(out)
    return out


def resolved_issues(text: Column) -> Column:
    """Sorted distinct issue numbers that the text says it closes, HTML comments aside."""
    plain = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    found = F.regexp_extract_all(plain, F.lit(rf"(?iU)\b(?:{'|'.join(CLOSING)})\s+#(\d+)"), F.lit(1))
    return F.array_sort(F.array_distinct(found))


def quality(patch: Column, explanation: Column, n_files: Column) -> dict[str, Column]:
    """The four parts of a bug's quality, each at most 1, and their weighted sum."""
    one = F.lit(1.0)
    add = lambda when, points: F.when(when, points).otherwise(0.0)
    realism = F.lit(0.5)
    for mark in REAL_MARKS:
        realism = realism + add(F.contains(patch, F.lit(mark)), 0.05)
    realism = F.least(realism + add(F.length(explanation) > 20, 0.1), one)
    changed = occurrences(patch, "\n-") + occurrences(patch, "\n+")
    complex_ = F.least(
        F.lit(0.3) + add(changed > 2, 0.2) + add(changed > 5, 0.2) + add(occurrences(patch, "diff --git") > 1, 0.15)
        + add(has_any(patch, ["if ", "match "]), 0.15), one,
    )
    lines = occurrences(patch, "\n") + 1
    small = F.least(
        F.lit(0.5) + F.when(n_files == 1, 0.3).when(n_files <= 3, 0.15).otherwise(0.0)
        + F.when(lines < 30, 0.2).when(lines < 50, 0.1).otherwise(0.0), one,
    )
    testable = F.least(
        F.lit(0.4) + add(has_any(F.lower(explanation), list(BEHAVIOUR)), 0.1) + add(has_any(patch, ["mut ", "= "]), 0.15), one
    )
    overall = realism * 0.3 + complex_ * 0.25 + small * 0.25 + testable * 0.2
    return {"realism": realism, "complexity": complex_, "minimality": small, "testability": testable, "overall": overall}


def bug_kind(old: Column, new: Column) -> Column:
    """What an edit did, by ordered rules over the removed and the added text; the first that holds."""

    def swapped(*pairs: tuple[str, str]) -> Column:
        found = F.lit(False)
        for a, b in pairs:
            one = F.contains(old, F.lit(a)) & F.contains(new, F.lit(b))
            found = found | one | (F.contains(old, F.lit(b)) & F.contains(new, F.lit(a)))
        return found

    handling = ["?", ".map_err(", ".ok_or(", "return Err"]
    checks = ["if ", ".is_none()", ".is_some()", ".is_empty()", "assert"]
    guards = ["if ", "guard", "check", "validate"]
    return (
        F.when(swapped(("==", "!="), (">", "<"), (">=", "<=")), "comparison_flip")
        .when(swapped(("&&", "||")), "logic_swap")
        .when(swapped(("<", "<=")), "off_by_one")
        .when(swapped(("+", "-"), ("*", "/"), ("&", "|")), "operator_change")
        .when(has_any(old, handling) & ~has_any(new, handling), "missing_error_handling")
        .when(has_any(old, checks) & ~has_any(new, checks), "missing_validation")
        .when(has_any(old, [*guards, "verify"]) & ~has_any(new, guards), "removed_guard")
        .otherwise("unknown")
    )


def challenging(patch: Column) -> Column:
    """3 to 20 changed lines and a word of control flow."""
    changed = occurrences(patch, "\n+") + occurrences(patch, "\n-")
    return changed.between(3, 20) & has_any(patch, list(CONTROL))


def merged_label(label: Column) -> Column:
    """The longest time class counts as the one below it."""
    return F.when(label == ">4 hours", "1-4 hours").otherwise(label)


def weighted_score(labels: DataFrame, label: str, weights: dict[str, int] = DIFFICULTY) -> DataFrame:
    """One row: count of each known label and their mean weight, to 3 places; others don't count."""
    value = F.lit(None).cast("int")
    for name, w in weights.items():
        value = F.when(F.col(label) == name, w).otherwise(value)
    return labels.agg(
        F.count(F.lit(1)).alias("n_instances"), F.count(value).alias("n_rated"),
        *(F.count_if(F.coalesce(F.col(label) == n, F.lit(False))).alias(f"n_{SHORT.get(n, n)}") for n in weights),
        F.round(F.sum(value) / F.count(value), 3).alias("score"),
    )
