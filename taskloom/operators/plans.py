"""Mutation plans: instructions as rows, applied to the text of a file by registered transforms."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import prepare
from . import scan
from .mutations import valid_scan

INSTRUCTION = "struct<type:string,target_file:string,target_function:string,location_hint:string,original_fragment:string,mutation_details:map<string,string>,reasoning:string>"
PLAN = f"strategy string, target_symbols array<string>, mutations array<{INSTRUCTION}>, affected_behavior string, difficulty string, reasoning_chain array<string>"

Transform = Callable[[str, str, dict[str, str]], str | None]


def _replace(old: str, new: str) -> Transform:
    """The fragment with the first ``operator`` replaced by ``new_operator``; the arguments are their defaults."""

    def run(code: str, fragment: str, details: dict[str, str]) -> str | None:
        a, b = details.get("operator", old), details.get("new_operator", new)
        return code.replace(fragment, fragment.replace(a, b, 1), 1) if a in fragment else None

    return run


def _guard(code: str, fragment: str, details: dict[str, str]) -> str | None:
    """The block that starts in the fragment's first line replaced by its body, with an else branch kept whole."""
    at = code.find(fragment.split("\n")[0])
    brace = scan.mask(code, "rs").find("{", at)
    end = scan.closing(scan.mask(code, "rs"), brace) if brace >= 0 else -1
    if at < 0 or end < 0 or code[end + 1 :].lstrip().startswith("else"):
        return None
    start = code.rfind("\n", 0, at) + 1
    return code[:start] + code[brace + 1 : end].strip("\n") + code[end + 1 :]


def _reorder(code: str, fragment: str, details: dict[str, str]) -> str | None:
    a, b = details.get("statement1", "").split("\n")[0].strip(), details.get("statement2", "").split("\n")[0].strip()
    lines = code.split("\n")
    i = next((n for n, x in enumerate(lines) if a and a in x), -1)
    j = next((n for n, x in enumerate(lines) if b and b in x and n != i), -1)
    if i < 0 or j < 0:
        return None
    lines[i], lines[j] = lines[j], lines[i]
    return "\n".join(lines)


def _boolean(code: str, fragment: str, details: dict[str, str]) -> str | None:
    if "return" not in fragment:
        return code.replace(fragment, f"!({fragment})", 1)
    for a, b in (("true", "false"), ("false", "true"), ("return ", "return !")):
        if a in fragment:
            return code.replace(fragment, fragment.replace(a, b), 1)
    return None


def _no_handling(code: str, fragment: str, details: dict[str, str]) -> str | None:
    return code.replace(fragment, fragment.replace("?", ""), 1)


def _arguments(code: str, fragment: str, details: dict[str, str]) -> str | None:
    a, b = details.get("argument1"), details.get("argument2")
    if not a or not b:
        return None
    return code.replace(fragment, fragment.replace(a, "\0").replace(b, a).replace("\0", b), 1)


def _bound(code: str, fragment: str, details: dict[str, str]) -> str | None:
    if details.get("direction", "+1") == "+1":
        fresh = fragment.replace("<", "<=", 1) if "<" in fragment and "<=" not in fragment else fragment.replace("- 1", "", 1)
    else:
        fresh = fragment.replace("<=", "<", 1)
    return code.replace(fragment, fresh, 1)


def _no_return(code: str, fragment: str, details: dict[str, str]) -> str | None:
    fresh = "\n".join("//" + x if x.strip().startswith("return ") else x for x in fragment.split("\n"))
    return code.replace(fragment, fresh, 1)


def _logic(code: str, fragment: str, details: dict[str, str]) -> str | None:
    return code.replace(fragment, fragment.replace(details.get("operator", "&&"), details.get("new_operator", "||")), 1)


def _awaits(code: str, fragment: str, details: dict[str, str]) -> str | None:
    lines = fragment.split("\n")
    at = [i for i, x in enumerate(lines) if ".await" in x][:2]
    if len(at) < 2:
        return None
    lines[at[0]], lines[at[1]] = lines[at[1]], lines[at[0]]
    return code.replace(fragment, "\n".join(lines), 1)


def _types(code: str, fragment: str, details: dict[str, str]) -> str | None:
    a, b = details.get("old_type"), details.get("new_type")
    return code.replace(fragment, fragment.replace(a, b, 1), 1) if a and b else None


def _cache(code: str, fragment: str, details: dict[str, str]) -> str | None:
    if "invalidate" not in fragment.lower():
        return _guard(code, fragment, details)
    return code.replace(fragment, "// " + fragment.replace("\n", "\n// "), 1)


def _either(key: str, word: str, first: Transform, second: Transform) -> Transform:
    return lambda code, fragment, details: (first if word in details.get(key, "").lower() else second)(code, fragment, details)


_FLIP = _replace("==", "!=")
#: Transforms by the names that plans use.
TRANSFORMS: dict[str, Transform] = {
    "flip_comparison": _FLIP, "remove_guard": _guard, "reorder_statements": _reorder, "change_operator": _replace("+", "-"),
    "invert_boolean": _boolean, "remove_error_handling": _no_handling, "swap_arguments": _arguments, "off_by_one": _bound,
    "missing_return": _no_return, "logic_swap": _logic, "state_mismatch": _either("change", "transition", _FLIP, _guard),
    "async_reordering": _awaits, "trait_impl_bug": _either("return_type", "bool", _boolean, _FLIP), "error_propagation": _no_handling,
    "type_confusion": _types, "cache_invalidation": _cache, "permission_check": _either("change", "check", _guard, _FLIP),
    "transaction_boundary": _reorder, "lock_ordering": _reorder, "lifetime_manipulation": _types,
}


def apply_instruction(code: str, kind: str, fragment: str | None, details: dict[str, str] | None) -> tuple[str | None, str | None]:
    """(changed code, error): exactly one is null."""
    fragment = (fragment or "").strip()
    if kind not in TRANSFORMS:
        return None, "unknown transform"
    if fragment not in code and TRANSFORMS[kind] is not _reorder:
        return None, "fragment not found"
    out = TRANSFORMS[kind](code, fragment, dict(details or {}))
    if out is None or out == code:
        return None, "no change"
    return (out, None) if valid_scan(out, "rs") else (None, "delimiters no longer pair")


def apply_plans(plans: DataFrame, keys: list[str], plan: str, source: Column) -> DataFrame:
    """(keys, position, type, code, error): each instruction of a plan (JSON) on the file's text. A plan that can't be
    read gives no row."""
    prepare(plans.sparkSession)
    kinds = dict(plans.dtypes)
    each = plans.select(*keys, source.alias("__source"), F.posexplode(F.from_json(plan, PLAN)["mutations"]).alias("position", "m"))
    flat = each.select(*keys, "position", F.col("m.type").alias("type"), "__source", F.col("m.original_fragment").alias("__f"), F.to_json("m.mutation_details").alias("__d"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for batch in batches:
            done = [
                apply_instruction(s or "", t, f, json.loads(d) if d else {})
                for s, t, f, d in zip(batch["__source"], batch["type"], batch["__f"], batch["__d"], strict=True)
            ]
            out = batch[[*keys, "position", "type"]]
            yield out.assign(code=pd.Series([c for c, _ in done], dtype=object, index=out.index), error=pd.Series([e for _, e in done], dtype=object, index=out.index))

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "position int, type string, code string, error string"])
    return flat.mapInPandas(run, schema)
