"""Running values within ordered groups of any size, without a task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: How a value runs up to and including a row, and how it joins what earlier pieces of the group gave.
_LOCAL = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
_JOINED = {
    "sum": lambda prior, own: F.coalesce(prior, F.lit(0)) + F.coalesce(own, F.lit(0)),
    "max": lambda prior, own: F.greatest(prior, own),
    "last": lambda prior, own: F.coalesce(own, prior),
}


def running(rows: DataFrame, group: str, order: list[str], measures: dict[str, tuple[str, Column]], at_once: int = 1_000_000) -> DataFrame:
    """``rows`` with a column for each measure (kind, column), over the rows of the group up to this one in ``order``, which
    must tell the rows of a group apart. Kinds: sum (nulls are 0), max, last (non-null), previous (the row before, this one left out).

    Groups of at most ``at_once`` rows are a window each. The rows of larger ones are range-partitioned by group and
    order, cut by a checkpoint so that a rerun finds the same pieces, run within their piece, and joined with what the
    earlier pieces of the group amount to, one row a piece. A null group is a group.
    """
    given = rows.columns
    held = rows.withColumns({f"__m_{n}": (F.struct(c.alias("v")) if kind == "previous" else c) for n, (kind, c) in measures.items()})
    counts = rows.groupBy(F.col(group).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    large = counts.where(F.col("__n") > at_once).select("__k")
    if not large.limit(1).count():
        return _within(held, [group], order, measures).select(*given, *(_plain(n, kind) for n, (kind, _) in measures.items()))
    large = cut(large)
    same = F.col(group).eqNullSafe(F.col("__k"))
    small = _within(held.join(large, same, "left_anti"), [group], order, measures)
    hot = cut(held.join(large, same, "left_semi").repartitionByRange(group, *order).withColumn("__piece", F.spark_partition_id()))
    pieces = hot.groupBy(F.col(group).alias("__k"), F.col("__piece").alias("__p")).agg(*(
        (F.max_by(f"__m_{n}", F.when(F.col(f"__m_{n}").isNotNull(), F.struct(*order))) if kind in ("last", "previous") else _LOCAL[kind](f"__m_{n}")).alias(f"__t_{n}")
        for n, (kind, _) in measures.items()
    ))
    before = Window.partitionBy("__k").orderBy("__p")
    upto = before.rowsBetween(Window.unboundedPreceding, -1)
    prior = pieces.select("__k", "__p", *(
        (F.lag(f"__t_{n}").over(before) if kind == "previous" else _LOCAL[kind](F.col(f"__t_{n}")).over(upto)).alias(f"__p_{n}")
        for n, (kind, _) in measures.items()
    ))
    inside = _within(hot, [group, "__piece"], order, measures)
    both = inside.join(prior, same & (F.col("__piece") == F.col("__p")))
    whole = both.withColumns({
        f"__r_{n}": F.coalesce(f"__r_{n}", f"__p_{n}") if kind == "previous" else _JOINED[kind](F.col(f"__p_{n}"), F.col(f"__r_{n}"))
        for n, (kind, _) in measures.items()
    })
    names = [f"__r_{n}" for n in measures]
    out = small.select(*given, *names).unionByName(whole.select(*given, *names))
    return out.select(*given, *(_plain(n, kind) for n, (kind, _) in measures.items()))


def _plain(name: str, kind: str) -> Column:
    run = F.col(f"__r_{name}")
    return (run["v"] if kind == "previous" else F.coalesce(run, F.lit(0)) if kind == "sum" else run).alias(name)


def _within(rows: DataFrame, keys: list[str], order: list[str], measures: dict[str, tuple[str, Column]]) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(*order)
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({
        f"__r_{n}": F.lag(f"__m_{n}").over(by) if kind == "previous" else _LOCAL[kind](F.col(f"__m_{n}")).over(upto)
        for n, (kind, _) in measures.items()
    })
