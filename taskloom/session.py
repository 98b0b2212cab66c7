"""Session helpers shared by every operator: worker import path, checkpoints, table loading."""

from __future__ import annotations

import re
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def build(master: str = "local[8]", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and local benchmarks; on a cluster the caller's session is used instead."""
    return (
        SparkSession.builder.master(master)
        .appName("taskloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="taskloom-checkpoint-"))
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver imported it (a shared or local
    path; on clusters without one, ship the package with ``--py-files``)."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(":"):
        env["PYTHONPATH"] = f"{ROOT}:{have}" if have else ROOT
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Where that is unset: a temporary one if driver and executors are
    one process, else a folder in the warehouse, which all of them reach."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        one = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
        path = tempfile.mkdtemp(prefix="taskloom-checkpoint-") if one else f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder (never a local one)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def spread(rows: DataFrame) -> DataFrame:
    """A scan with fewer partitions than the cluster has cores, dealt out to all of them, for work that costs
    far more than moving its input. Larger inputs have more partitions and pass as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)
