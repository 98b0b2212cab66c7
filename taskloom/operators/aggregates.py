"""Counts, distributions and statistics of instances, labels, patches and modifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import bug_type, modifier, repo_part


def type_counts(rows: DataFrame) -> DataFrame:
    """(bug_type, n) by id; every procedural type is one."""
    return rows.groupBy(bug_type(F.col("instance_id")).alias("bug_type")).agg(F.count(F.lit(1)).alias("n"))


def repo_counts(rows: DataFrame) -> DataFrame:
    """(repo_key, n), most first."""
    out = rows.groupBy(repo_part(F.col("instance_id")).alias("repo_key")).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.desc("n"), "repo_key")


def label_distribution(labels: DataFrame, label: str) -> DataFrame:
    """(label, n, pct): share of each label, null included, in percent to 2 places."""
    counts = labels.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = labels.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, 2))


def accuracy(pairs: DataFrame, truth: str, guess: str, extremes: tuple[str, str]) -> DataFrame:
    """One row: compared pairs, share of agreement, and how often one says one extreme, the other the other."""
    both = pairs.where(F.col(truth).isNotNull() & F.col(guess).isNotNull())
    a, b = extremes
    far = ((F.col(truth) == a) & (F.col(guess) == b)) | ((F.col(truth) == b) & (F.col(guess) == a))
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg((F.col(truth) == F.col(guess)).cast("int")), 6).alias("accuracy"),
        F.count_if(far).alias("n_extreme"),
    )


def modifier_stats(rows: DataFrame, valid: Column) -> DataFrame:
    """(repo_key, modifier, generated, valid, pct) with subtotals by repository and a total: nulls in the
    grouping columns mark them, and ``level`` says how many are rolled up."""
    base = rows.select(
        repo_part(F.col("instance_id")).alias("repo_key"), modifier(F.col("instance_id")).alias("modifier"),
        F.coalesce(valid, F.lit(False)).alias("ok"),
    )
    return (
        base.rollup("repo_key", "modifier")
        .agg(F.count(F.lit(1)).alias("n_generated"), F.count_if("ok").alias("n_valid"), F.grouping_id().alias("g"))
        .select(
            "repo_key", "modifier", "n_generated", "n_valid",
            F.round(F.col("n_valid") * 100.0 / F.col("n_generated"), 2).alias("pct"),
            F.when(F.col("g") == 0, 0).when(F.col("g") == 1, 1).otherwise(2).alias("level"),
        )
    )


def spread(groups: DataFrame, value: str) -> DataFrame:
    """One row: mean, sample deviation (0 for one value), least, median and greatest of per-group values."""
    v = F.col(value)
    return groups.agg(
        F.count(v).alias("n"), F.round(F.avg(v), 6).alias("mean"),
        F.round(F.coalesce(F.stddev_samp(v), F.lit(0.0)), 6).alias("std"),
        F.min(v).alias("least"), F.median(v).alias("median"), F.max(v).alias("greatest"),
    )


def similarity_bucket(ratio: Column, text: Column) -> Column:
    return (
        F.when(text.isNull() | (F.trim(text) == ""), "empty").when(ratio.isNull(), "invalid")
        .when(ratio >= 0.99, "exact").when(ratio >= 0.8, "high").when(ratio >= 0.5, "medium").otherwise("low")
    )


def module_groups(files: DataFrame, key: str, path: str, depth: int) -> DataFrame:
    """(repo_key, module, n_patches, paths): patches by the first ``depth`` parts of their files' folders; modules
    of a single file drop out."""
    parts = F.split(F.regexp_replace(path, r"/[^/]*$", ""), "/")
    module = F.array_join(F.slice(parts, 1, depth), "/")
    return (
        files.where(F.contains(path, F.lit("/")))
        .groupBy("repo_key", module.alias("module"))
        .agg(F.countDistinct(key).alias("n_patches"), F.array_sort(F.collect_set(path)).alias("paths"))
        .where(F.size("paths") > 1)
    )


def similarity_statistics(rows: DataFrame, ratio: str, size: str) -> DataFrame:
    """One row: count, least, greatest, mean and upper median of ratios, and least, greatest and upper median of sizes.

    The upper median is the value at place ``n // 2`` of the sorted ones, counted from 0; it is not interpolated.
    """
    middle = lambda c: F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{c}` DESC)")
    return rows.agg(
        F.count(ratio).alias("n"), F.min(ratio).alias("least"), F.max(ratio).alias("greatest"), F.round(F.avg(ratio), 6).alias("mean"),
        middle(ratio).alias("median"), F.min(size).alias("size_least"), F.max(size).alias("size_greatest"), middle(size).alias("size_median"),
    )


def unified_tasks(changes: DataFrame, key: str, order: list[str], size: int) -> DataFrame:
    """(key, chunk_id, total_chunks, counts, locations): the changes of each key in groups of at most ``size``, in order.

    changes: key, order columns, new_path, place, change (added, modified or removed). A key's changes are those of one diff.
    """
    by = Window.partitionBy(key)
    at = F.row_number().over(by.orderBy(*order)) - 1
    placed = changes.withColumns({"__at": at, "__n": F.count(F.lit(1)).over(by)}).withColumn("chunk_id", F.floor(F.col("__at") / size).cast("int"))
    kinds = [F.count_if(F.col("change") == c).alias(c) for c in ("added", "modified", "removed")]
    places = F.transform(F.array_sort(F.collect_list(F.struct("__at", "place"))), lambda x: x["place"])
    return placed.groupBy(key, "chunk_id").agg(
        F.ceil(F.max("__n") / size).cast("int").alias("total_chunks"), F.count(F.lit(1)).alias("total_changes"),
        F.countDistinct("new_path").alias("files_changed"), *kinds, places.alias("locations"),
    )
