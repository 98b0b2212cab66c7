"""Several patches into one: applied in memory to a common source, greedily and without sharing a patch."""

from __future__ import annotations

from itertools import combinations, islice

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import hash_order
from ..session import prepare
from .diffs import Hunk, apply_to, parse, render


def merged(patches: list[str]) -> str | None:
    """One diff that does what all do; None if two change or show the same lines of a file, or add or delete it.

    Hunks of different patches are all relative to the unpatched file, so disjoint ones are joined as they
    are, with new starts moved by what comes before.
    """
    files: dict[str, list] = {}
    for patch in patches:
        for d in parse(patch):
            if d.is_new or d.is_deleted or not d.hunks:
                return None
            files.setdefault(d.new_path, []).append(d)
    out = []
    for many in files.values():
        hunks = sorted((h for d in many for h in d.hunks), key=lambda h: h.old_start)
        moved, end, result = 0, 0, []
        for h in hunks:
            old, new = h.counts()
            if h.old_start < end:
                return None
            end = h.old_start + old
            result.append(Hunk(h.old_start, old, h.old_start + moved, new, h.tail, h.body))
            moved += new - old
        many[0].hunks = result
        out.append(many[0])
    return render(out) if out else None


def applied(source: str, path: str, patches: list[str]) -> str | None:
    """The file after all patches; None if they don't fit each other or the file."""
    whole = merged(patches)
    hunks = [h for d in parse(whole) if d.new_path == path for h in d.hunks] if whole else []
    return apply_to(source, hunks) if hunks else None


def greedy(patches: list[tuple[str, str]], size: int, most: int, tries: int, files: int = 1) -> list[tuple[list[str], str]]:
    """(names, merged patch) of up to ``most`` combinations of exactly ``size`` patches: the first that fits in order of
    names, then the first of the unused ones, and so on. A result must touch at least ``files`` files."""
    left, out = sorted(patches), []
    while len(out) < most:
        for combo in islice(combinations(left, size), tries):
            whole = merged([p for _, p in combo])
            if whole is not None and len(parse(whole)) >= files:
                out.append(([n for n, _ in combo], whole))
                left = [x for x in left if x not in combo]
                break
        else:
            break
    return out


def combined(patches: DataFrame, group: str, size: int, most: int = 10, tries: int = 1000, files: int = 1) -> DataFrame:
    """(group, members, patch): greedy combinations within each group (a file, or a module for ``files`` = 2).

    patches: group, name, patch. The selection depends on the order, so a group is one call. It gets every patch
    that the search can reach: a result tries ``tries`` combinations, which differ in their last patch while there are
    further ones, of what earlier results left.
    """
    prepare(patches.sparkSession)
    kind = dict(patches.dtypes)[group]
    first = Window.partitionBy(group).orderBy("name", "patch")
    reach = most * size + tries - 1
    few = patches.where("patch <> ''").select(group, "name", "patch").withColumn("r", F.row_number().over(first)).where(F.col("r") <= reach)

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        found = greedy(list(zip(batch["name"], batch["patch"], strict=True)), size, most, tries, files)
        key = pd.Series([batch[group].iloc[0]] * len(found), dtype=object)
        return pd.DataFrame({group: key, "members": pd.Series([m for m, _ in found], dtype=object), "patch": pd.Series([p for _, p in found], dtype=object)})

    return few.drop("r").groupBy(group).applyInPandas(run, f"`{group}` {kind}, members array<string>, patch string")


#: Levels of composites: how many patches, and whether of one file (the fullest) or of as many files.
LEVELS = {"medium": (2, True), "hard": (2, False), "expert": (3, False)}


def composites(patches: DataFrame, group: str, level: str, n: int, seed: int = 24, least: int = 6) -> DataFrame:
    """(group, members, patch): at most ``n`` composites of each group with ``least`` patches or more.

    patches: group, file, name, patch. ``medium`` joins two patches of the file that has most, ``hard`` one of each of two
    files, ``expert`` of three. Who meets whom goes by hash order in place of a random choice, so no patch is used twice.
    A patch that doesn't fit those before it is left out, and a composite needs two that fit.
    """
    prepare(patches.sparkSession)
    size, one_file = LEVELS[level]
    rows = patches.where("patch <> ''").select(group, "file", "name", "patch")
    enough = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= least).select(group)
    rows = rows.join(enough, group, "left_semi").withColumn("o", hash_order(seed, F.col("name")))
    if one_file:
        counts = rows.groupBy(group, "file").agg(F.count(F.lit(1)).alias("c"))
        fullest = counts.groupBy(group).agg(F.max_by("file", F.struct("c", "file")).alias("file"))
        ranked = rows.join(fullest, [group, "file"]).withColumn("r", F.row_number().over(Window.partitionBy(group).orderBy("o", "name")))
        placed = ranked.where(F.col("r") <= n * size).withColumn("no", F.floor((F.col("r") - 1) / size))
    else:
        turn = rows.withColumn("t", F.row_number().over(Window.partitionBy(group, "file").orderBy("o", "name"))).where(F.col("t") <= n)
        ranked = turn.withColumn("r", F.row_number().over(Window.partitionBy(group, "t").orderBy("o", "file"))).where(F.col("r") <= n * size)
        placed = ranked.withColumn("no", F.col("t") * n + F.floor((F.col("r") - 1) / size))
    held = placed.groupBy(group, "no").agg(F.array_sort(F.collect_list(F.struct("o", "name", "patch"))).alias("m")).where(F.size("m") == size)
    first = held.withColumn("r", F.row_number().over(Window.partitionBy(group).orderBy("no"))).where(F.col("r") <= n)

    @F.pandas_udf("struct<members:array<string>,patch:string>")
    def join(names: pd.Series, texts: pd.Series) -> pd.DataFrame:
        out = []
        for ns, ps in zip(names, texts, strict=True):
            fit: list[int] = []
            for i in range(len(ps)):
                if merged([ps[k] for k in [*fit, i]]) is not None:
                    fit.append(i)
            whole = merged([ps[k] for k in fit]) if len(fit) > 1 else None
            out.append(([ns[k] for k in fit] if whole else None, whole))
        return pd.DataFrame(out, columns=["members", "patch"])

    made = first.select(group, join(F.col("m.name"), F.col("m.patch")).alias("x"))
    return made.where("x.patch is not null").select(group, "x.members", "x.patch")
