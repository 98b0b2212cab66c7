"""Ranks within groups of any size, without a task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, key: str, order: list[str], rank: str = "rank", bucket_rows: int = 200_000) -> DataFrame:
    """``df`` with ``rank``: 0, 1, ... within each value of ``key``, unique and without gaps.

    A group is cut into buckets of about ``bucket_rows`` rows by a hash of ``order``; rows are numbered
    within their bucket, and a running sum over the bucket sizes gives each bucket its offset. So no
    task holds a whole group, and equal inputs give equal ranks, whichever executor runs what. Rows
    that agree in all of ``order`` are interchangeable. ``key`` may be null; an empty table stays empty.
    """
    sizes = df.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.select("__k", F.ceil(F.col("__n") / bucket_rows).cast("int").alias("__buckets"))
    large = sizes.where("__buckets > 1")  # at most the rows of the table / bucket_rows
    placed = df.join(large, F.col(key).eqNullSafe(F.col("__k")), "left").withColumn(
        "__bucket", F.pmod(F.xxhash64(*order), F.coalesce("__buckets", F.lit(1)))
    )
    counts = placed.groupBy(key, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(key).alias("__ok"), F.col("__bucket").alias("__ob"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
    )
    local = Window.partitionBy(key, "__bucket").orderBy(*order)
    numbered = placed.drop("__k", "__buckets").withColumn("__local", F.row_number().over(local))
    return (
        numbered.join(offsets, F.col(key).eqNullSafe(F.col("__ok")) & (F.col("__bucket") == F.col("__ob")))
        .withColumn(rank, F.col("__offset") + F.col("__local") - 1)
        .drop("__ok", "__ob", "__offset", "__local", "__bucket")
    )
