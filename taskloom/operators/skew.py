"""Per-key results over keys of any skew: heavy keys are salted, aggregated in parts, and merged."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import parallelism

#: A partial of each kind, and how partials merge; every kind is associative, so salting is exact.
_PART = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "rows": lambda c: F.count(F.lit(1))}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "rows": F.sum}


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """(key, n, total) of the keys held by more than ``share`` of all rows, null keys included.

    The count combines on the map side, so a key's skew never reaches one task, and the result
    has fewer than ``1 / share`` rows whatever the input.
    """
    part = Fraction(str(share))
    counts = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    total = df.agg(F.count(F.lit(1)).alias("__total"))
    return counts.withColumn("__total", total.scalar()).where(
        F.col("__n") * part.denominator > F.col("__total") * part.numerator
    )


def salted_aggregate(
    df: DataFrame,
    key: str,
    measures: dict[str, tuple[str, Column | None]],
    distinct: tuple[str, Column] | None = None,
    heavy_share: float = 0.01,
    salts: int | None = None,
    spread: Column | None = None,
) -> DataFrame:
    """One row per value of ``key`` (null is a value), by two-stage salted aggregation.

    measures: output name -> (kind, column) with kind sum, count, min, max or rows.
    distinct: (output name, column) for one exact distinct count of non-null values.
    heavy_share: a key with more than this share of the rows is salted; at most ``1 / heavy_share``
    keys are, which bounds the broadcast table of heavy keys.
    salts: salts of a key holding all rows (default: the shuffle partitions); a key gets its share.

    spread: what the salt is a hash of, if neither the distinct column nor the measured ones are to be.

    The salt is a hash of the row's distinct column, or of all measured columns, rather than
    ``rand()``: a task rerun after the loss of an executor gives every row the same salt again, and
    equal values of the distinct column meet under one salt, so partial distinct counts add up.
    A repeated row changes nothing but the counts; an empty table gives an empty result; columns of
    the input that aren't used may have any name. Sums of nothing but nulls are 0.
    """
    if salts is None:
        salts = max(2, parallelism(df.sparkSession))
    heavy = F.broadcast(
        heavy_keys(df, key, heavy_share).select(
            "__key", F.ceil(F.col("__n") * F.lit(salts) / F.col("__total")).cast("int").alias("__salts")
        )
    )
    cols = {name: (F.lit(1) if column is None else column) for name, (_, column) in measures.items()}
    if distinct or spread is None:
        spread = distinct[1] if distinct else F.struct(*cols.values())
    rows = df.select(
        F.col(key).alias("__k"),
        F.xxhash64(spread).alias("__h"),
        *([distinct[1].alias("__d")] if distinct else []),
        *(c.alias(f"__m_{name}") for name, c in cols.items()),
    )
    rows = rows.join(heavy, F.col("__k").eqNullSafe(F.col("__key")), "left").withColumn(
        "__salt", F.when(F.col("__salts") > 1, F.pmod(F.col("__h"), F.col("__salts"))).otherwise(F.lit(0))
    )
    kinds = {name: kind for name, (kind, _) in measures.items()}
    first = ["__k", "__salt"] + (["__d"] if distinct else [])
    out = rows.groupBy(*first).agg(*(_PART[k](F.col(f"__m_{n}")).alias(f"__m_{n}") for n, k in kinds.items()))
    merge = [_MERGE[k](F.col(f"__m_{n}")).alias(f"__m_{n}") for n, k in kinds.items()]
    if distinct:
        out = out.groupBy("__k", "__salt").agg(*merge, F.count("__d").alias("__d"))
        merge.append(F.sum("__d").alias("__d"))
    out = out.groupBy("__k").agg(*merge)
    return out.select(
        F.col("__k").alias(key),
        *(
            (F.coalesce(F.col(f"__m_{n}"), F.lit(0)) if k in ("sum", "count", "rows") else F.col(f"__m_{n}")).alias(n)
            for n, k in kinds.items()
        ),
        *([F.col("__d").alias(distinct[0])] if distinct else []),
    )


def repo_results(instances: DataFrame) -> DataFrame:
    """Per ``repo`` of task_instances: rows, distinct instances, tests listed, patch sizes.

    Null lists and null or empty patches count as no test and no patch. Repeated rows count.
    """
    size = lambda c: F.coalesce(F.array_size(F.col(c)), F.lit(0)).cast("long")
    length = F.when(F.col("patch") != "", F.length("patch").cast("long"))
    return salted_aggregate(
        instances,
        "repo",
        {
            "n_rows": ("rows", None),
            "n_fail_to_pass": ("sum", size("FAIL_TO_PASS")),
            "n_pass_to_pass": ("sum", size("PASS_TO_PASS")),
            "n_patches": ("count", length),
            "patch_chars": ("sum", length),
            "patch_chars_min": ("min", length),
            "patch_chars_max": ("max", length),
        },
        distinct=("n_instances", F.col("instance_id")),
    )


def heavy_repos(instances: DataFrame, share: float = 0.05) -> DataFrame:
    """The non-null ``repo`` values held by more than ``share`` of all rows (null rows count)."""
    part = Fraction(str(share))
    total = instances.agg(F.count(F.lit(1)).alias("__total"))
    counts = salted_aggregate(instances, "repo", {"n_rows": ("rows", None)}, spread=F.col("instance_id"))
    return counts.where(
        F.col("repo").isNotNull() & (F.col("n_rows") * part.denominator > total.scalar() * part.numerator)
    ).select("repo")


def look_up(rows: DataFrame, mapping: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """Inner join of rows with a table unique in ``key``, for keys of any skew.

    Keys of more than ``share`` of the rows, fewer than ``1 / share``, are broadcast; rows of all
    others are joined by a shuffle in which none of them is large. Null keys match nothing.
    """
    hot = mapping.join(F.broadcast(heavy_keys(rows, key, share).select(F.col("__key").alias(key))), key, "left_semi")
    hot = F.broadcast(hot)
    cold = rows.join(hot.select(key), key, "left_anti").join(mapping, key)
    return rows.join(hot, key).unionByName(cold)


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: list[str], share: float = 0.01) -> DataFrame:
    """Inner join on ``key`` in which left rows of a hot key are dealt out over salts, and the right rows of that key copied to each.

    A key is hot if it has more than ``share`` of the left rows, so fewer than ``1 / share`` are; it gets its share of the
    shuffle partitions as salts. The salt is a hash of the columns ``spread``, so reruns agree. Null keys match nothing.
    """
    salts = parallelism(left.sparkSession)
    hot = heavy_keys(left, key, share).where("__key is not null").select(
        "__key", F.greatest(F.ceil(F.col("__n") * F.lit(salts) / F.col("__total")), F.lit(1)).cast("int").alias("__salts")
    )
    hot = F.broadcast(hot)
    of = F.coalesce("__salts", F.lit(1))
    a = left.join(hot, F.col(key) == F.col("__key"), "left").withColumn("__salt", F.pmod(F.xxhash64(*spread), of).cast("int"))
    b = right.join(hot, F.col(key) == F.col("__key"), "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), of - 1)))
    return a.drop("__key", "__salts").join(b.drop("__key", "__salts"), [key, "__salt"]).drop("__salt")
