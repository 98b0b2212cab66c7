"""Windows, caps, samples, splits, intervals and combinations, each reproducible from hashes."""

from __future__ import annotations

from itertools import combinations, islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.running import running
from ..functions.scalar import hash_order, hash_unit
from ..session import prepare


def carry_forward(lines: DataFrame, group: str, order: str, header: Column, name: str, at_once: int = 1_000_000) -> DataFrame:
    """``name``: the last non-null ``header`` at or before each line of its group."""
    return running(lines, group, [order], {name: ("last", header)}, at_once)


def prefix_until(rows: DataFrame, group: str, order: list[str], holds: Column, at_once: int = 1_000_000) -> DataFrame:
    """The rows of each group before the first for which ``holds`` is false or null."""
    broken = F.when(F.coalesce(holds, F.lit(False)), 0).otherwise(1)
    return running(rows, group, order, {"__broken": ("max", broken)}, at_once).where("__broken = 0").drop("__broken")


def neighbours(lines: Column, at: Column, k: int) -> Column:
    """The lines within ``k`` of place ``at`` (from 1), of an array of lines; nothing is shuffled."""
    start = F.greatest(at - k, F.lit(1))
    return F.slice(lines, start, F.least(at + k, F.size(lines)) - start + 1)


def previous(rows: DataFrame, group: str, order: str, column: str, name: str, at_once: int = 1_000_000) -> DataFrame:
    """``name``: the column's value in the row before, in its group; null in the first."""
    return running(rows, group, [order], {name: ("previous", F.col(column))}, at_once)


def cap_per_key(rows: DataFrame, key: str, most: int, seed: int, ids: list[str]) -> DataFrame:
    """At most ``most`` rows of each key, in hash order of ``ids``. Sampling is the feature."""
    order = hash_order(seed, *(F.col(c).cast("string") for c in ids))
    ranked = rows.withColumn("__order", order).withColumn(
        "__rank", F.row_number().over(Window.partitionBy(key).orderBy("__order", *ids))
    )
    return ranked.where(F.col("__rank") <= most).drop("__order", "__rank")


def diverse(rows: DataFrame, key: str, most: int, seed: int, ids: list[str]) -> DataFrame:
    """``most`` rows: first one of every key, then others, in hash order; no row twice.

    The first row of a key is a minimum, and the others that can be taken are among the first ``2 * most`` of all, so
    no key is sorted as a whole.
    """
    order = hash_order(seed, *(F.col(c).cast("string") for c in ids))
    marked = rows.withColumn("__order", order)
    whole, place = F.struct(*marked.columns), F.struct("__order", *ids)
    firsts = marked.groupBy(F.col(key).alias("__key")).agg(F.min_by(whole, place).alias("__row")).select("__row.*").orderBy("__order", *ids).limit(most)
    near = marked.orderBy("__order", *ids).limit(2 * most)
    ranked = near.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy("__order", *ids)))
    both = firsts.withColumn("__late", F.lit(0)).unionByName(ranked.where("__rank > 1").drop("__rank").withColumn("__late", F.lit(1)))
    return both.orderBy("__late", "__order", *ids).limit(most).drop("__late", "__order")


def sample(rows: DataFrame, n: int, seed: int, ids: list[str]) -> DataFrame:
    """``n`` rows without replacement, in hash order (a distributed top-k)."""
    order = hash_order(seed, *(F.col(c).cast("string") for c in ids))
    return rows.withColumn("__order", order).orderBy("__order", *ids).limit(n).drop("__order")


def shuffled(rows: DataFrame, seed: int, ids: list[str]) -> DataFrame:
    """All rows in hash order, as range-partitioned sorted output."""
    return rows.orderBy(hash_order(seed, *(F.col(c).cast("string") for c in ids)), *ids)


def chunks(rows: DataFrame, group: str, order: list[str], size: int, at_once: int = 1_000_000) -> DataFrame:
    """``chunk``: fixed-size pieces of each group in ``order``, numbered from 0. Groups may have any size."""
    ranked = running(rows, group, order, {"__rank": ("sum", F.lit(1))}, at_once)
    return ranked.withColumn("chunk", F.floor((F.col("__rank") - 1) / size).cast("int")).drop("__rank")


def near_equal_parts(rows: DataFrame, parts: int, order: list[str], at_once: int = 1_000_000) -> DataFrame:
    """``part``: 1 to ``parts`` in the order given; the first ones hold one row more.

    A row's rank is that within its range of the order and the sizes of the ranges before; one task ranks at most
    ``at_once`` rows.
    """
    ranked = running(rows.withColumn("__all", F.lit(0)), "__all", order, {"__rank": ("sum", F.lit(1))}, at_once)
    total, at = rows.agg(F.count(F.lit(1)).alias("n")).scalar(), F.col("__rank") - 1
    small, extra = F.floor(total / parts), total % parts
    big = (small + 1) * extra
    part = F.when(at < big, F.floor(at / (small + 1))).otherwise(extra + F.floor((at - big) / small))
    return ranked.withColumn("part", (part + 1).cast("int")).drop("__all", "__rank")


def split_by_hash(rows: DataFrame, share: float, seed: int, ids: list[str]) -> DataFrame:
    """``split``: train for about ``share`` of the rows, else test; no shuffle."""
    unit = hash_unit(seed, *(F.col(c).cast("string") for c in ids))
    return rows.withColumn("split", F.when(unit < share, "train").otherwise("test"))


def weighted_choice(rows: DataFrame, weights: dict[str, int], seed: int, ids: list[str], name: str) -> DataFrame:
    """``name``: one of the choices by weight (integers; their sum is the whole)."""
    unit = hash_unit(seed, *(F.col(c).cast("string") for c in ids)) * sum(weights.values())
    chosen, upto = F.lit(None).cast("string"), sum(weights.values())
    for choice in reversed(list(weights)):
        chosen = F.when(unit < upto, F.lit(choice)).otherwise(chosen)
        upto -= weights[choice]
    return rows.withColumn(name, chosen)


def merged_intervals(intervals: DataFrame, group: str, start: str, end: str) -> DataFrame:
    """(group, first, last, n): overlapping or touching intervals merged."""
    by = Window.partitionBy(group).orderBy(start, end)
    reach = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0)
    marked = intervals.withColumn("__new", fresh).withColumn(
        "__island", F.sum("__new").over(by.rowsBetween(Window.unboundedPreceding, 0))
    )
    return marked.groupBy(group, "__island").agg(
        F.min(start).alias("first"), F.max(end).alias("last"), F.count(F.lit(1)).alias("n")
    ).drop("__island")


def overlapping_pairs(intervals: DataFrame, group: str, key: str, start: str, end: str, width: int) -> DataFrame:
    """(group, key_a, key_b): intervals of a group that share a point (ends included), key_a < key_b.

    Intervals meet in cells of ``width`` rather than in all pairs; a pair counts in the cell of its later start.
    """
    cells = F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width)))
    base = intervals.select(group, key, start, end, cells.alias("__cell"))
    a, b = base.toDF(group, "key_a", "sa", "ea", "__cell"), base.toDF(group, "key_b", "sb", "eb", "__cell")
    met = a.join(b, [group, "__cell"]).where("key_a < key_b and sa <= eb and sb <= ea")
    later = F.floor(F.greatest("sa", "sb") / width) == F.col("__cell")
    return met.where(later).select(group, "key_a", "key_b")


def disjoint_ranges(intervals: DataFrame, group: str, key: str, start: str, end: str) -> DataFrame:
    """(group, key, start, end): ranges kept greedily in key order, each unless it overlaps one kept before.

    Order-dependent, so a group (an entity's edits) is one call.
    """
    prepare(intervals.sparkSession)

    def keep(batch: pd.DataFrame) -> pd.DataFrame:
        kept: list[int] = []
        batch = batch.sort_values([key, start, end]).reset_index(drop=True)
        for i, (s, e) in enumerate(zip(batch[start], batch[end], strict=True)):
            if all(e < batch[start][j] or s > batch[end][j] for j in kept):
                kept.append(i)
        return batch.loc[kept]

    table = intervals.select(group, key, start, end)
    return table.groupBy(group).applyInPandas(keep, table.schema)


def capped_combinations(items: DataFrame, group: str, item: str, size: int, most: int) -> DataFrame:
    """(group, combo array): the first ``most`` combinations of exactly ``size`` items of each group, in
    lexicographic order of the sorted items. The cap is the feature; combinations are made lazily."""
    prepare(items.sparkSession)
    kind, gkind = dict(items.dtypes)[item], dict(items.dtypes)[group]

    def make(batch: pd.DataFrame) -> pd.DataFrame:
        found = [list(c) for c in islice(combinations(sorted(batch[item]), size), most)]
        key = pd.Series([batch[group].iloc[0]] * len(found), dtype=object)
        return pd.DataFrame({group: key, "combo": pd.Series(found, dtype=object)})

    # the first `most` combinations only ever use the first size + most items
    first = Window.partitionBy(group).orderBy(item)
    few = items.select(group, item).distinct().withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= size + most)
    return few.drop("__n").groupBy(group).applyInPandas(make, f"{group} {gkind}, combo array<{kind}>")
