"""Splits that keep related records together: whole projects go to train, validation or test."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import rank_within
from ..operators.graph import components
from ..operators.skew import look_up
from ..session import cut, prepare

PROPORTIONS = {"train": 0.8, "validation": 0.1, "test": 0.1}
#: Numbers of equal bins that are tried; the allocation nearest to the proportions is taken.
BINS = (50, 100, 200)

# --- identity ---------------------------------------------------------------------------------------


def _organisations(profiles: DataFrame) -> DataFrame:
    """(o): organisations that hold mirrors, from the registry; they settle how a mirror name without a commit is read."""
    return profiles.select(F.lower(F.split("mirror_name", "/")[0]).alias("o")).where("o is not null").distinct()


def mirror_organisations(profiles: DataFrame, most: int = 1000) -> list[str] | None:
    """Organisations that hold mirrors; None if there are more than ``most``, too many for one pattern."""
    found = [r["o"] for r in _organisations(profiles).limit(most + 1).collect()]
    return sorted(found) if len(found) <= most else None


def project_of_repo(repo: Column, mirrors: list[str] = (), mirrored: Column | None = None) -> Column:
    """``owner/repo`` in lower case, whatever the notation: a web or ssh address, ``owner/repo``,
    ``owner__repo``, or a mirror ``organisation/owner__repo.commit``; null for null and blank values.
    mirrors: organisations of mirrors. mirrored: instead of these, whether ``organisation`` is one."""
    orgs = "|".join(re.escape(m) for m in mirrors)
    anyone = (r"^(?:.*/)?[^/]*/([^/]+?)__([^/]+)$", "$1/$2")
    rest = [(r"^([^/]+?)__([^/]+)$", "$1/$2"), (r"^.*/([^/]+/[^/]+)$", "$1")]
    name = _replaced(_cleaned(repo), [(rf"^(?:.*/)?(?:{orgs})/([^/]+?)__([^/]+)$", "$1/$2")] if orgs else [])
    if mirrored is not None:
        name = F.when(mirrored, _replaced(name, [anyone])).otherwise(name)
    return F.nullif(_replaced(name, rest), F.lit(""))


def _replaced(name: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, into in steps:
        name = F.regexp_replace(name, pattern, into)
    return name


def _cleaned(repo: Column) -> Column:
    """The name in lower case without an address and without the commit of a mirror."""
    steps = [
        (r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?[^/]+/+", ""),
        (r"^[^/@:\s]+@[^/:\s]+[:/]", ""),
        (r"[?#].*$", ""),
        (r"(?:\.git)?/*$", ""),
        (r"^/+", ""),
        (r"^(?:.*/)?([^/]+?)__([^/]+)\.[0-9a-f]{7,40}$", "$1/$2"),
    ]
    return _replaced(F.lower(F.trim(F.regexp_replace(repo, r"\s+", " "))), steps)


def with_project(rows: DataFrame, profiles: DataFrame, name: str, most: int = 1000) -> DataFrame:
    """``rows`` with the project of ``repo``: by one pattern, or, with more than ``most`` organisations of mirrors,
    by a join of the distinct values with these, which gives the same."""
    mirrors = mirror_organisations(profiles, most)
    if mirrors is not None:
        return rows.withColumn(name, project_of_repo(F.col("repo"), mirrors))
    key = F.regexp_extract(_cleaned(F.col("repo")), r"^(?:.*/)?([^/]*)/[^/]+?__[^/]+$", 1)
    held = F.col("repo").alias("__repo"), key.alias("__key")
    open_ = rows.select(*held).where(_cleaned(F.col("repo")).rlike(r"/[^/]+?__[^/]+$")).distinct()
    known = open_.join(_organisations(profiles), F.col("__key") == F.col("o")).select("__repo", F.lit(True).alias("__mirrored"))
    joined = rows.join(known, F.col("repo") == F.col("__repo"), "left")
    named = project_of_repo(F.col("repo"), mirrored=F.coalesce("__mirrored", F.lit(False)))
    return joined.withColumn(name, named).drop("__repo", "__mirrored")


def project_of_instance(instance_id: Column) -> Column:
    """The project that an id ``owner__repo.commit.rest`` names; other ids stand for themselves."""
    name = F.lower(F.trim(instance_id))
    shape = r"^(.+?)__(.+)\.[0-9a-f]{7,40}\.[^.]+$"
    named = F.regexp_replace(name, shape, "$1/$2")
    return F.when(name.rlike(shape), named).when(name != "", F.concat(F.lit("id:"), name))


def former_names(profiles: DataFrame) -> DataFrame:
    """(a, b): links from a project's name to the name that it had before."""
    now = F.concat(F.lower(F.trim("owner")), F.lit("/"), F.lower(F.trim("repo")))
    return (
        profiles.select(now.alias("a"), project_of_repo(F.col("former_name")).alias("b"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )


def _with_component(names: DataFrame, name: str, linked: DataFrame) -> DataFrame:
    """``component`` of each name: the one its links give it, else the name itself."""
    return names.join(linked, F.col(name) == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", name)
    ).drop("node")


def repo_components(instances: DataFrame, profiles: DataFrame) -> DataFrame:
    """(repo, component) of every distinct non-null ``repo`` value, as stored."""
    prepare(instances.sparkSession)
    repos = instances.select("repo").where("repo is not null").distinct()
    named = with_project(repos, profiles, "__name")
    linked = components(former_names(profiles))
    return _with_component(named, "__name", linked).where("component is not null").select("repo", "component")


def same_project_pairs(instances: DataFrame, profiles: DataFrame) -> DataFrame:
    """(repo_a, repo_b), repo_a < repo_b: different values of ``repo`` that name one project.

    Blank values name none. The values are distinct before they meet, so rows don't multiply.
    """
    named = repo_components(instances, profiles)
    a, b = named.toDF("repo_a", "component"), named.toDF("repo_b", "component")
    return a.join(b, "component").where("repo_a < repo_b").select("repo_a", "repo_b")


# --- balance ----------------------------------------------------------------------------------------


def _differenced(parts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Partial solutions, each its bins' sums in descending order, combined into one: the two with the largest differences
    again and again, the fullest bins of one with the emptiest of the other. Returns its sums and, for each part, the
    bin of the result that each of the part's bins ended in."""
    bins, made = len(parts[0]), len(parts)
    heap = [(int(p[-1] - p[0]), i, p) for i, p in enumerate(parts)]
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, j, b = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        merges.append((i, j, order.astype(np.uint16)))
        heapq.heappush(heap, (int(sums[-1] - sums[0]), made + len(merges) - 1, sums))
    where: dict[int, np.ndarray] = {heap[0][1]: np.arange(bins, dtype=np.uint16)}
    for k in range(len(merges) - 1, -1, -1):  # back from the result to the parts
        i, j, order = merges[k]
        at = np.empty(bins, dtype=np.uint16)
        at[order] = where.pop(made + k)
        where[i], where[j] = at, at[::-1]
    return heap[0][2], [where[i] for i in range(made)]


def difference_bins(weights: dict[int, int], bins: int, block: int = 8192) -> tuple[dict[int, tuple[int, np.ndarray]], list[int]]:
    """Components of weights ``{weight: how many}`` in ``bins`` equal bins by largest differencing.

    Of ``c`` components of one weight, ``c // bins`` go to every bin: no difference. The rest of a weight, fewer than
    ``bins``, lie in bins of their own, as combining equal weights first puts them: one partial solution for each
    weight, whatever its count. These are combined by largest differencing, ``block`` weights at a time from the largest
    on, and then the blocks' results likewise, so sums are held for one block and for one result a block.
    Returns, by weight, how many every bin gets and the bins of the others, and the bins' sums.
    """
    even = {w: c // bins for w, c in weights.items()}
    base = sum(w * n for w, n in even.items())
    rest = [(w, weights[w] % bins) for w in sorted(weights, reverse=True) if weights[w] % bins]
    placed = {w: (n, np.zeros(0, dtype=np.uint16)) for w, n in even.items()}
    if not rest:
        return placed, [base] * bins
    results, held = [], []
    for at in range(0, len(rest), block):
        parts = []
        for w, c in rest[at : at + block]:
            parts.append(np.zeros(bins, dtype=np.int64))
            parts[-1][:c] = w
        sums, where = _differenced(parts)
        results.append(sums)
        held.append([bin_of[:c].copy() for (_, c), bin_of in zip(rest[at : at + block], where, strict=True)])
    sums, last = _differenced(results)
    for k, (many, final) in enumerate(zip(held, last, strict=True)):
        for (w, _), own in zip(rest[k * block :], many, strict=False):
            placed[w] = (even[w], final[own])
    return placed, [base + int(s) for s in sums]


def allocate_bins(sums: list[int], shares: list[float]) -> tuple[list[int], float]:
    """The split of each whole bin, and the largest deviation of a split from its share, in rows.

    The fullest bin goes to the split that lacks most; then bins are moved or exchanged between splits
    as long as that brings the worst of the two nearer to its target.
    """
    total = sum(sums)
    lacks = np.array([s * total for s in shares], dtype=float)
    of = np.zeros(len(sums), dtype=int)
    for i in sorted(range(len(sums)), key=lambda i: (-sums[i], i)):
        of[i] = int(np.argmax(lacks))
        lacks[of[i]] -= sums[i]
    values = np.array(sums, dtype=float)
    for _ in range(10 * len(sums)):
        best, move = 1e-9, None
        for a in range(len(shares)):
            for b in range(len(shares)):
                if lacks[a] >= lacks[b]:
                    continue
                ia, ib = np.flatnonzero(of == a), np.append(np.flatnonzero(of == b), -1)
                if not len(ia):  # a holds too much, b too little
                    continue
                given = values[ia][:, None] - np.where(ib < 0, 0.0, values[ib])[None, :]
                worst = np.maximum(np.abs(lacks[a] + given), np.abs(lacks[b] - given))
                gain = max(abs(lacks[a]), abs(lacks[b])) - worst
                k = int(np.argmax(gain))
                if gain.flat[k] > best:
                    best, move = gain.flat[k], (a, b, ia[k // len(ib)], ib[k % len(ib)], given.flat[k])
        if move is None:
            break
        a, b, i, j, given = move
        of[i] = b
        if j >= 0:
            of[j] = a
        lacks[a] += given
        lacks[b] -= given
    return of.tolist(), float(np.max(np.abs(lacks))) if len(shares) else 0.0


def plan_splits(weights: dict[int, int], shares: list[float]) -> dict[int, list[int]]:
    """By weight, the ends of each split's run of ranks among the components of that weight."""
    best, plan = None, {}
    for bins in BINS:
        placed, sums = difference_bins(weights, bins)
        of, off = allocate_bins(sums, shares)
        if best is None or off < best:
            best, each = off, np.bincount(of, minlength=len(shares))
            plan = {
                w: np.cumsum(each * n + np.bincount(np.array(of)[rest], minlength=len(shares))).tolist()
                for w, (n, rest) in placed.items()
            }
    return plan


def assign_splits(weights: DataFrame, key: str, weight: str, proportions: dict[str, float] = PROPORTIONS) -> DataFrame:
    """(key, weight, split): every key, with its weight as rows, in one split.

    Only the histogram of weights reaches the driver: the weights of N rows have at most sqrt(2 N) different
    values, and the plan takes a few kilobytes for each, whatever the number of components. Keys take the planned places by their rank within their weight.
    """
    spark = prepare(weights.sparkSession)
    table = weights.select(F.col(key).alias("__key"), F.col(weight).cast("bigint").alias("__weight"))
    counts = {r[0]: r[1] for r in table.groupBy("__weight").agg(F.count(F.lit(1))).collect()}
    names, shares = list(proportions), [p / sum(proportions.values()) for p in proportions.values()]
    plan = plan_splits(counts, shares)
    sizes = np.array(sorted(plan), dtype=np.int64)
    shared = spark.sparkContext.broadcast((sizes, np.array([plan[w] for w in sizes]).reshape(len(sizes), len(names))))
    ranked = rank_within(table, "__weight", ["__key"], rank="__rank")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, ends = shared.value
        labels = np.array(names, dtype=object)
        for batch in batches:
            at = np.searchsorted(known, batch["__weight"].to_numpy(np.int64))
            split = (ends[at] <= batch["__rank"].to_numpy(np.int64)[:, None]).sum(axis=1) if len(batch) else []
            yield batch[["__key", "__weight"]].assign(split=labels[split])

    kind = dict(table.dtypes)["__key"]
    return (
        ranked.mapInPandas(place, f"__key {kind}, __weight bigint, split string")
        .withColumnRenamed("__key", key)
        .withColumnRenamed("__weight", weight)
    )


def project_splits(
    instances: DataFrame, profiles: DataFrame, proportions: dict[str, float] = PROPORTIONS
) -> DataFrame:
    """(row_id, project, split): every row of task_instances, all rows of a project in one split.

    The project is that of ``repo``, or of ``instance_id`` where ``repo`` is null or blank; projects
    linked by a former name are one. A row with neither is a project of its own. Proportions are met as
    nearly as whole projects allow. Repeated rows count as rows. Extra columns are ignored.
    """
    prepare(instances.sparkSession)
    name = F.coalesce(
        F.col("__project"),
        project_of_instance(F.col("instance_id")),
        F.concat(F.lit("row:"), F.col("row_id")),
        F.lit("row:"),
    )
    read = with_project(instances.select("row_id", "repo", "instance_id"), profiles, "__project")
    rows = read.select("row_id", name.alias("__name"))
    sizes = rows.groupBy("__name").agg(F.count(F.lit(1)).alias("__n"))
    names = cut(_with_component(sizes, "__name", components(former_names(profiles))))
    weights = names.groupBy("component").agg(F.sum("__n").alias("__weight"))
    placed = assign_splits(weights, "component", "__weight", proportions)
    mapping = cut(names.select("__name", "component").join(placed.select("component", "split"), "component"))
    out = look_up(rows, mapping, "__name")
    return out.select("row_id", F.col("component").alias("project"), "split")
