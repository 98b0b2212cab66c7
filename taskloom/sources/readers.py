"""Scans of datasets, predictions, diffs, logs, reports, trajectories and source trees.

Schemas are given, never inferred; a record that can't be read is kept aside in ``_corrupt_record``
rather than failing the scan. Keys that paths carry become columns.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.scalar import matches_any

INSTANCE = (
    "instance_id string, repo string, patch string, image_name string, problem_statement string, "
    "FAIL_TO_PASS array<string>, PASS_TO_PASS array<string>"
)
PREDICTION = "instance_id string, model_patch string, model_name_or_path string"
PULL = (
    "number bigint, title string, body string, merged_at string, created_at string, additions int, deletions int, "
    "changed_files int, review_comments int, base struct<sha:string,repo:string>, resolved_issues array<string>"
)
REPORT = (
    "FAIL_TO_PASS array<string>, PASS_TO_PASS array<string>, FAIL_TO_FAIL array<string>, PASS_TO_FAIL array<string>, timed_out boolean"
)


def dataset(spark: SparkSession, path: str, schema: str = INSTANCE, per_line: bool = False) -> DataFrame:
    """A ``.json`` array (or, ``per_line``, an array on each line), ``.jsonl`` lines or Parquet; any other extension is an error."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if not path.endswith((".json", ".jsonl")):
        raise ValueError(f"unsupported file format (must be .json, .jsonl or .parquet): {path}")
    fields = f"{schema}, _corrupt_record string"
    if path.endswith(".jsonl"):
        lines = spark.read.text(path).where(F.trim("value") != "")
        return lines.select(F.from_json("value", fields, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    whole = spark.read.text(path, wholetext=not per_line)
    kind = f"array<struct<{', '.join(':'.join(c.split(' ', 1)) for c in _fields(schema))}>>"
    rows = whole.select(F.explode(F.from_json("value", kind)).alias("r")).select("r.*")
    return rows.withColumn("_corrupt_record", F.lit(None).cast("string"))


def good(rows: DataFrame) -> DataFrame:
    """Rows that could be read."""
    return rows.where("_corrupt_record is null").drop("_corrupt_record")


def predictions(spark: SparkSession, path: str, instances: DataFrame | None = None) -> DataFrame:
    """Predictions: an object keyed by id, lines, or ``gold``: the patches of the instances themselves."""
    if path == "gold":
        return instances.select("instance_id", F.col("patch").alias("model_patch"), F.lit("gold").alias("model_name_or_path"))
    if path.endswith(".jsonl"):
        return good(dataset(spark, path, PREDICTION))
    text = spark.read.text(path, wholetext=True)
    value = "map<string,struct<instance_id:string,model_patch:string,model_name_or_path:string>>"
    return text.select(F.explode(F.from_json("value", value)).alias("id", "p")).select(
        F.coalesce("p.instance_id", "id").alias("instance_id"), "p.model_patch", "p.model_name_or_path"
    )


def _keyed(spark: SparkSession, root: str, glob: str, pattern: str, names: list[str]) -> DataFrame:
    """Whole files below a folder, with the groups of ``pattern`` in their paths as columns."""
    files = (
        spark.read.option("pathGlobFilter", glob).text(root, wholetext=True, recursiveFileLookup=True)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )
    return files.select(*(F.regexp_extract("path", pattern, i + 1).alias(n) for i, n in enumerate(names)), "value")


def patch_files(spark: SparkSession, root: str, kind: str = "", most: int | None = None) -> DataFrame:
    """(bug_type, key, patch, metadata): ``bug__<type>__<key>.diff`` files with their metadata siblings, if any.

    kind: keep types that start with it; most: the first so many by type and key (the cap is the feature).
    """
    diffs = _keyed(spark, root, "bug__*.diff", r"bug__(.*)__([^_/]+)\.diff$", ["bug_type", "key"]).withColumnRenamed("value", "patch")
    meta = _keyed(spark, root, "metadata__*.json", r"metadata__(.*)__([^_/]+)\.json$", ["bug_type", "key"]).withColumnRenamed("value", "metadata")
    out = diffs.where(F.col("bug_type").startswith(kind)).join(meta, ["bug_type", "key"], "left")
    return out.orderBy("bug_type", "key").limit(most) if most is not None else out


def run_logs(spark: SparkSession, root: str, name: str = "test_output*.txt") -> DataFrame:
    """(run, instance_id, file, log) of ``<run>/<instance>/<file>``."""
    return _keyed(spark, root, name, r"([^/]+)/([^/]+)/([^/]+)$", ["run", "instance_id", "file"]).withColumnRenamed("value", "log")


def run_reports(spark: SparkSession, root: str, schema: str = REPORT) -> DataFrame:
    """(run, instance_id, columns of the report); a report nested under its instance's id is unwrapped."""
    rows = _keyed(spark, root, "report.json", r"([^/]+)/([^/]+)/report\.json$", ["run", "instance_id"])
    kind = f"struct<{', '.join(':'.join(c.split(' ', 1)) for c in _fields(schema))}>"
    nested = F.get(F.map_values(F.from_json("value", f"map<string,{kind}>")), F.lit(0))
    flat = F.from_json("value", kind)
    inside = F.try_variant_get(F.try_parse_json("value"), F.concat(F.lit("$['"), F.col("instance_id"), F.lit("']")), "variant")
    return rows.select("run", "instance_id", F.when(inside.isNotNull(), nested).otherwise(flat).alias("r")).select("run", "instance_id", "r.*")


def _fields(schema: str) -> list[str]:
    out, depth, last = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[last:i].strip())
            last = i + 1
    return [*out, schema[last:].strip()]


def trajectory_files(spark: SparkSession, root: str) -> DataFrame:
    """(instance_id, text) of ``<instance>/<instance>.traj`` files."""
    return _keyed(spark, root, "*.traj", r"([^/]+)/[^/]+\.traj$", ["instance_id"]).withColumnRenamed("value", "text")


def pulls(spark: SparkSession, path: str) -> DataFrame:
    """Dumped pull requests, one a line; rows that can't be read drop out."""
    return good(dataset(spark, path, PULL))


def annotations(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header, by a given schema."""
    return spark.read.csv(path, header=True, schema=schema)


def is_test_path(path: Column) -> Column:
    """Whether a path is a test's: its name starts with test, or its stem ends with it, or a folder says so."""
    name = F.lower(F.regexp_extract(path, r"([^/]*)$", 1))
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    folders = F.split(F.lower(F.regexp_replace(path, r"/?[^/]*$", "")), "/")
    known = F.array(*(F.lit(x) for x in ("tests", "test", "specs")))
    return name.startswith("test") | stem.endswith("test") | F.arrays_overlap(folders, known)


def source_tree(
    spark: SparkSession,
    root: str,
    extensions: list[str],
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    skip_files: list[str] | None = None,
    tests: bool = False,
) -> DataFrame:
    """(path, ext, content) of the sources below a folder. Extensions are pruned while files are listed;
    folders, names and tests before any content is read. Files that aren't UTF-8 drop out."""
    glob = "*.{" + ",".join(extensions) + "}" if len(extensions) > 1 else f"*.{extensions[0]}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    base = root.rstrip("/").removeprefix("file://")
    path = F.regexp_replace(F.regexp_replace("path", r"^\w+:/*", "/"), f"^{base}/", "")
    rows = files.select(path.alias("path"), "content")
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    if include:
        rows = rows.where(F.reduce(F.array(*(F.contains(folder, F.lit(x)) for x in include)), F.lit(False), lambda a, b: a | b))
    for x in exclude or []:
        rows = rows.where(~F.contains(folder, F.lit(x)))
    if skip_files:
        rows = rows.where(~matches_any(F.regexp_extract("path", r"([^/]*)$", 1), skip_files))
    if not tests:
        rows = rows.where(~is_test_path(F.col("path")))
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    return rows.select("path", F.regexp_extract("path", r"\.([^.]*)$", 1).alias("ext"), text.alias("content")).where("content is not null")


class PagedSource(DataSource):
    """Records of a paged service, read from a folder of its dumped pages: ``page-<n>.json`` arrays.

    A page is a partition, so pages are fetched in parallel and a lost task fetches its page again. A
    subclass may override ``fetch`` to call a service, and wait out its rate limit there.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page int, position int, record string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.pages = options["path"], int(options["pages"])

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(1, self.pages + 1)]

    def fetch(self, page: int) -> list:
        try:
            with open(f"{self.folder}/page-{page}.json", encoding="utf-8") as file:
                return json.load(file)
        except FileNotFoundError:
            return []

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for i, record in enumerate(self.fetch(partition.value)):
            yield partition.value, i, json.dumps(record)
