"""Resumable runs: new files are taken once, results are appended, finished keys are skipped."""

from __future__ import annotations

import uuid
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def run_increment(
    spark: SparkSession, source: str, work: str, key: list[str], transform=None, schema=None
) -> DataFrame:
    """Process the files of ``source`` that no earlier increment of ``work`` has seen; all results so far.

    ``availableNow`` with a checkpoint under ``work`` takes each file exactly once. Rows whose ``key`` has
    a result already are skipped by an anti-join within the batch, so copies that arrive later change
    nothing; a batch that is run again after a failure overwrites its own folder.
    """
    path = PurePosixPath(source)
    schema = schema or spark.read.parquet(source).schema
    pattern = path.name if path.suffix == ".parquet" else "*.parquet"
    folder = str(path.parent) if path.suffix == ".parquet" else source
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    out = f"{work}/results"

    def batch(rows: DataFrame, number: int) -> None:
        rows = transform(rows) if transform else rows
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(out)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        rows = rows.dropDuplicates(key)
        if fs.exists(at):
            done = spark.read.option("basePath", out).parquet(out).where(F.col("batch") != number).select(*key)
            same = [F.col(f"__{k}").eqNullSafe(F.col(k)) for k in key]
            rows = rows.join(done.toDF(*(f"__{k}" for k in key)), same, "left_anti")
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{work}/checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.option("basePath", out).parquet(out)


def counts_by_increments(spark: SparkSession, source: str) -> DataFrame:
    """(run, status, n) of status rows taken as a stream: the state after all available files."""
    work = f"{checkpoint_dir(spark)}/increments-{uuid.uuid4()}"
    path = PurePosixPath(source)
    schema = spark.read.parquet(source).schema
    single = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    fs = single.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(single).isDirectory():
        stream = spark.readStream.schema(schema).parquet(source)
    else:
        stream = spark.readStream.schema(schema).option("pathGlobFilter", path.name).parquet(str(path.parent))
    part = f"{work}/counts"

    def batch(rows: DataFrame, number: int) -> None:
        counts = rows.groupBy("run", "status").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("overwrite").parquet(f"{part}/batch={number}")

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{work}/checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.option("basePath", part).parquet(part).groupBy("run", "status").agg(F.sum("n").alias("n"))
