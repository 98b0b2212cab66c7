"""Items of varying length into containers of fixed capacity, planned over the histogram of lengths.

Best fit runs over (length, count) pairs from the longest down, not over documents: all containers with
one content are one entry with a multiplicity, so the plan's size depends on the capacity alone. The
documents then take the planned slots: their rank among the items of their length is the slot's number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import rank_within
from ..session import cut, prepare
from .encode import LEAF_CHARS, VOCABULARY, encode_documents

_SHIFT = 44  #: a slot key is (length << 44) + rank; both fit for up to 2**44 items of a length


@dataclass
class Plan:
    """Slot runs sorted by key: ``keys`` (length and first rank), the first container of the run, items
    per container, and the place of the run's first item in its container."""

    keys: np.ndarray
    container: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    containers: int


def plan_containers(histogram: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over counts. ``histogram``: items of each length, 1 to ``capacity``.

    A length visits each group of equal containers at most once and splits at most one, so there are
    at most four groups a length: the plan is bounded by the capacity, whatever the number of items.
    """
    groups: dict[int, dict[tuple, int]] = {}  # free space -> {content: containers}

    def put(free: int, content: tuple, n: int) -> None:
        if n:
            at = groups.setdefault(free, {})
            at[content] = at.get(content, 0) + n

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if length < 1 or length > capacity:
            raise ValueError(f"length {length} does not fit the capacity {capacity}")
        for free in sorted(f for f in groups if f >= length):
            each = free // length
            for content, n in sorted(groups.pop(free).items()):
                full = min(n, left // each)
                put(free - each * length, (*content, (length, each)), full)
                left -= full * each
                if full < n:
                    rest = left  # less than fits one container, or none at all
                    if rest:
                        put(free - rest * length, (*content, (length, rest)), 1)
                        left = 0
                    put(free, content, n - full - (1 if rest else 0))
            if not left:
                break
        if left:
            each = capacity // length
            put(capacity - each * length, ((length, each),), left // each)
            if rest := left % each:
                put(capacity - rest * length, ((length, rest),), 1)
    taken: dict[int, int] = {}
    runs, first = [], 0
    for free in sorted(groups):
        for content, n in sorted(groups[free].items()):
            place = 0
            for length, each in content:
                start = taken.get(length, 0)
                runs.append(((length << _SHIFT) + start, first, each, place))
                taken[length] = start + n * each
                place += length * each
            first += n
    if taken != {k: v for k, v in histogram.items() if v}:
        raise AssertionError("the plan must give every item one slot")
    runs.sort()
    columns = np.array(runs, dtype=np.int64).reshape(-1, 4).T
    return Plan(columns[0], columns[1], columns[2], columns[3], first)


def pack_items(items: DataFrame, size: str, order: list[str], capacity: int) -> DataFrame:
    """``items`` with ``container`` and ``place`` (where in the container the item starts).

    Sizes must be 1 to ``capacity``. Only the histogram, at most ``capacity`` rows, reaches the driver.
    """
    spark = prepare(items.sparkSession)
    counts = items.groupBy(size).agg(F.count(F.lit(1)).alias("n")).collect()
    plan = plan_containers({r[0]: r["n"] for r in counts}, capacity)
    shared = spark.sparkContext.broadcast(plan)
    ranked = rank_within(items, size, order, rank="__rank")
    schema = ranked.drop("__rank").schema.add("container", "long").add("place", "long")

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = shared.value
        for batch in batches:
            if batch.empty:
                continue
            length, rank = batch[size].to_numpy(np.int64), batch["__rank"].to_numpy(np.int64)
            run = np.searchsorted(p.keys, (length << _SHIFT) + rank, side="right") - 1
            nth = rank - (p.keys[run] & ((1 << _SHIFT) - 1))
            yield batch.drop(columns="__rank").assign(
                container=p.container[run] + nth // p.each[run], place=p.offset[run] + nth % p.each[run] * length
            )

    return ranked.mapInPandas(take, schema)


def token_counts(documents: DataFrame, id_col: str, text_col: str, vocabulary: str, leaf_chars: int) -> DataFrame:
    ids = encode_documents(documents, id_col, text_col, vocabulary, leaf_chars)
    return ids.select(F.col(id_col).alias("__id"), F.size("ids").cast("bigint").alias("__tokens"))


def pack_documents(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    vocabulary: str = VOCABULARY,
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """(id, piece, n_tokens, container, place): where each text, or piece of a text, goes.

    A text of more than ``capacity`` tokens is cut into full pieces and a last one, and only such texts
    are cut; any other is one piece 0 in one container. Null and empty texts need no space: one row
    with 0 tokens and a null container and place. Repeated rows each get a place; extra columns are
    ignored; an empty table gives an empty result. ``place`` counts tokens from the container's start.
    """
    kind = dict(documents.dtypes)[id_col]
    sizes = cut(token_counts(documents, id_col, text_col, vocabulary, leaf_chars))
    pieces = F.sequence(F.lit(0), F.ceil(F.col("__tokens") / capacity).cast("int") - 1)
    items = sizes.where("__tokens > 0").select("__id", "__tokens", F.explode(pieces).alias("piece")).select(
        "__id",
        "piece",
        F.least(F.lit(capacity), F.col("__tokens") - F.col("piece") * capacity).cast("bigint").alias("n_tokens"),
    )
    packed = pack_items(items, "n_tokens", ["__id", "piece"], capacity)
    none = sizes.where("__tokens = 0").select(
        "__id", F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("n_tokens"),
        F.lit(None).cast("bigint").alias("container"), F.lit(None).cast("bigint").alias("place"),
    )
    return packed.unionByName(none).withColumn("__id", F.col("__id").cast(kind)).withColumnRenamed("__id", id_col)
