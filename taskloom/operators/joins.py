"""Joins of task data: resume, lookups, full outer comparison, and theta joins rewritten to equality joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def todo(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs without a finished result; inputs with a null key stay."""
    return inputs.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def matched(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(left rows joined with right, left rows without a partner)."""
    return left.join(right, key), left.join(right.select(key).distinct(), key, "left_anti")


def validated(patches: DataFrame, instances: DataFrame, key: str = "instance_id") -> DataFrame:
    """Patches whose instance was validated; a semi-join never multiplies rows."""
    return patches.join(instances.select(key), key, "left_semi")


def with_metadata(patches: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Every patch, with its metadata sibling's columns where there is one."""
    return patches.join(metadata, key, "left")


def nested_or_flat(nested: Column, flat: Column) -> Column:
    """A report's value that is stored under its id in some files and at the top in others."""
    return F.coalesce(nested, flat, F.lit(False))


def profile_of(rows: DataFrame, profiles: DataFrame, key: Column, most_rows: int = 100_000) -> DataFrame:
    """Rows with the columns of the profile that ``key`` names: its mirror name or its repo name.

    The registry is broadcast if it has at most ``most_rows`` rows, else joined by a shuffle. A row
    without a profile keeps nulls; names are unique in the registry.
    """
    names = profiles.select("mirror_name", F.col("repo_name").alias("name"), "owner", "repo", "commit_sha")
    both = names.unionByName(names.withColumn("name", F.col("mirror_name"))).dropDuplicates(["name"])
    both = both.select("name", *(F.col(c).alias(f"profile_{c}") for c in ("mirror_name", "owner", "repo", "commit_sha")))
    if profiles.limit(most_rows + 1).count() <= most_rows:
        both = F.broadcast(both)
    return rows.join(both, key == F.col("name"), "left").drop("name")


def compared(before: DataFrame, after: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, status, before, after): full outer comparison: added, removed, modified; equal ones drop out."""
    b = before.select(*keys, F.col(value).alias("before"), F.lit(True).alias("__b"))
    a = after.select(*keys, F.col(value).alias("after"), F.lit(True).alias("__a"))
    status = (
        F.when(F.col("__b").isNull(), "added").when(F.col("__a").isNull(), "removed")
        .when(~F.col("before").eqNullSafe(F.col("after")), "modified")
    )
    both = b.join(a, keys, "full_outer").select(*keys, status.alias("status"), "before", "after")
    return both.where("status is not null")


def test_files_of(changed: DataFrame, tests: DataFrame) -> DataFrame:
    """(path, test_path, rule): the tests of each changed file: by name (``test_x``, ``x_test``, ``x.test``) first, else in
    its folder or that folder's tests folder.

    Names and folders become keys, so both rules are equality joins; the best rule is kept by a window.
    """
    stem = lambda c: F.regexp_replace(F.regexp_extract(c, r"([^/]*)$", 1), r"\.[^.]*$", "")
    folder = lambda c: F.regexp_replace(c, r"/?[^/]*$", "")
    of = F.regexp_replace(stem(F.col("test_path")), r"^test_|^Test|[._-](?:test|spec)$|Tests?$|_spec$", "")
    near = F.regexp_replace(folder(F.col("test_path")), r"(?:^|/)(?:tests?|specs?|__tests__)$", "")
    held = tests.select("test_path", of.alias("__stem"), near.alias("__folder"))
    wanted = changed.select("path", stem(F.col("path")).alias("__stem"), folder(F.col("path")).alias("__folder"))
    by_name = wanted.join(held.drop("__folder"), "__stem").select("path", "test_path", F.lit(1).alias("rule"))
    by_folder = wanted.join(held.drop("__stem"), "__folder").select("path", "test_path", F.lit(2).alias("rule"))
    both = by_name.unionByName(by_folder)
    best = F.min("rule").over(Window.partitionBy("path"))
    return both.withColumn("__best", best).where("rule = __best").drop("__best").distinct()


def tests_by_suffix(patch_files: DataFrame, tests: DataFrame) -> DataFrame:
    """(path, test_path): test files that end with a patch's path, or share its base name."""
    base = lambda c: F.regexp_extract(c, r"([^/]*)$", 1)
    met = patch_files.select("path", base(F.col("path")).alias("__b")).join(
        tests.select("test_path", base(F.col("test_path")).alias("__b")), "__b"
    )
    return met.drop("__b").distinct()


def inverted_index(files: DataFrame, names: str) -> DataFrame:
    """(name, files): for each name of an array column, the sorted files that hold it."""
    flat = files.select("file_path", F.explode(F.array_distinct(names)).alias("name"))
    return flat.groupBy("name").agg(F.array_sort(F.collect_set("file_path")).alias("files"))


def applicable(entities: DataFrame, modifiers: DataFrame) -> DataFrame:
    """Entities with every modifier of their language whose tags they all have and whose complexity
    range holds theirs. Modifiers are code, a fixed list of about a hundred, hence broadcast."""
    m = F.broadcast(modifiers)
    fits = (F.size(F.array_except("needs", "tags")) == 0) & F.col("complexity").between(
        F.col("min_complexity"), F.col("max_complexity")
    )
    return entities.join(m, "ext").where(fits)


def unique_union(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union of tables by name; a key that occurs twice makes the job fail, naming it."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    once = out.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    text = F.concat(F.lit("repeated key "), F.concat_ws(", ", *keys))
    ok = F.when(F.col("__n") > 1, F.raise_error(text).cast("int")).otherwise(1)
    return once.withColumn("__ok", ok).where("__ok = 1").drop("__n", "__ok")
