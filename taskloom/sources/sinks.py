"""Sinks: lines and arrays of JSON, reports by repository, run metadata, and files by row."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_lines(rows: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines, one file a partition; ``append`` adds files to what is there."""
    rows.write.mode("append" if append else "overwrite").json(path)


def write_arrays(rows: DataFrame, path: str, per_file: int = 10_000) -> None:
    """JSON arrays of at most ``per_file`` rows, one a line of text, made in each partition: nothing is shuffled."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= per_file:
                yield pa.RecordBatch.from_pydict({"value": [f"[{','.join(held[:per_file])}]"]})
                held = held[per_file:]
        if held:
            yield pa.RecordBatch.from_pydict({"value": [f"[{','.join(held)}]"]})

    rows.select(F.to_json(F.struct("*")).alias("r")).mapInArrow(pack, "value string").write.mode("overwrite").text(path)


def write_reports(rows: DataFrame, path: str, by: str = "repo_key") -> None:
    """Parquet in a folder per repository, so that a later scan prunes; a hot one is spread over files."""
    rows.write.mode("overwrite").option("maxRecordsPerFile", 1_000_000).partitionBy(by).parquet(path)


def run_metadata(rows: DataFrame, seed: int, most: int) -> DataFrame:
    """One row: how many rows, from how many instances, under which seed and cap."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("instance_id").alias("n_instances"),
        F.lit(seed).alias("seed"), F.lit(most).alias("max_per_instance"),
    )


def normalised(tasks: DataFrame) -> DataFrame:
    """Tasks for publishing: image names without an architecture suffix, no null statement."""
    return tasks.withColumns({
        "image_name": F.regexp_replace("image_name", r"\.(x86_64|arm64)(?=\.|$)", ""),
        "problem_statement": F.coalesce("problem_statement", F.lit("")),
    })


def removable(files: DataFrame, suffixes: list[str], keep: str) -> DataFrame:
    """(folder, n): how many files of each folder a clean-up would remove: those with a suffix, except ``keep``."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    gone = F.exists(F.array(*(F.lit(s) for s in suffixes)), lambda s: name.endswith(s)) & (name != keep)
    return files.where(gone).groupBy(F.regexp_replace("path", r"/?[^/]*$", "").alias("folder")).agg(F.count(F.lit(1)).alias("n"))


def export_files(rows: DataFrame, path: str, name: str, content: str) -> None:
    """One text file a row, as the last step only: each is written by the task that holds its row."""
    from pyspark.sql import Row

    def write(part) -> None:
        import os

        os.makedirs(path, exist_ok=True)
        for r in part:
            r: Row
            with open(os.path.join(path, os.path.basename(r[0])), "w", encoding="utf-8") as file:
                file.write(r[1] or "")

    rows.select(name, content).foreachPartition(write)
