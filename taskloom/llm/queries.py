"""Queries of the subpackage over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import spread, table
from . import canon, encode, leaks, pack, residue, splits


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text"))


def _statements(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "task_instances").select("row_id", "problem_statement"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return splits.same_project_pairs(table(spark, folder, "task_instances"), table(spark, folder, "profiles"))


def p1_splits(spark: SparkSession, folder: str) -> DataFrame:
    return splits.project_splits(table(spark, folder, "task_instances"), table(spark, folder, "profiles"))


def p1_balance(spark: SparkSession, folder: str) -> DataFrame:
    rows = p1_splits(spark, folder)
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("project").alias("n_projects"))


def p1_check(spark: SparkSession, folder: str) -> DataFrame:
    """What every division must keep: all rows once, no project divided, splits as near to 80/10/10 as half the largest project or a row."""
    rows, names = p1_splits(spark, folder), list(splits.PROPORTIONS)
    by = rows.groupBy("project").agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col("split") == s).alias(s) for s in names))
    used = sum((F.col(s) > 0).cast("int") for s in names)
    out = by.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_projects"), F.count_if(used != 1).alias("n_divided"),
        F.max("n").alias("most"), *(F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in names),
    )
    off = F.greatest(*(F.abs(F.col(s) - F.col("n_rows") * p) for s, p in splits.PROPORTIONS.items()))
    near = off <= F.greatest(F.col("most") / 2, F.lit(1.0))
    return out.select("n_rows", "n_projects", "n_divided", near.alias("near"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaked_pairs(_texts(spark, folder), table(spark, folder, "eval_instances"))


def p3_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Passages with an edit too, and items of five words or more."""
    return leaks.leaked_items(_texts(spark, folder), table(spark, folder, "eval_instances"), shortest=5)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue(_statements(spark, folder)).select("row_id")


def p4_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = residue.residue(_statements(spark, folder))
    return found.select("row_id", F.round("coverage", 6).alias("coverage"), "kinds", "passages")


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode.encode_documents(_texts(spark, folder))


def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    return pack.pack_documents(_texts(spark, folder))


def p7_check(spark: SparkSession, folder: str) -> DataFrame:
    """What every packing must keep: each text in one place, or cut only if it exceeds a container; no container above its
    capacity, no two items in one place; and at most one container in a hundred more than full ones would need."""
    rows = pack.pack_documents(_texts(spark, folder)).where("n_tokens > 0")
    by_text = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("piece").alias("k"), F.max("piece").alias("last"), F.sum("n_tokens").alias("size"))
    wrong = (F.col("n") != F.col("k")) | (F.col("last") + 1 != F.col("n")) | (F.col("n") != F.ceil(F.col("size") / 1024))
    texts = by_text.agg(F.count(F.lit(1)).alias("n_texts"), F.count_if(wrong).alias("n_wrong"))
    before = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("container").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    full = rows.withColumn("gap", before != F.col("place")).groupBy("container").agg(F.sum("n_tokens").alias("held"), F.count_if("gap").alias("gaps"))
    used = full.agg(F.count_if(F.col("held") > 1024).alias("n_over"), F.sum("gaps").alias("n_gaps"), (F.count(F.lit(1)) <= F.sum("held") / 1024 * 1.01 + 1).alias("near"))
    one = lambda f: f.withColumn("k", F.lit(1))
    return one(texts).join(one(used), "k").drop("k")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return canon.look_alike_pairs(_texts(spark, folder))


def p8_classes(spark: SparkSession, folder: str) -> DataFrame:
    return canon.look_alike_classes(_texts(spark, folder))


def p8_text(spark: SparkSession, folder: str) -> DataFrame:
    return canon.consistent_documents(_texts(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        p1_found, p1_splits, p1_balance, p1_check, p3_found, p3_leaks, p4_found, p4_passages, p6_ids, p7_containers, p7_check,
        p8_found, p8_classes, p8_text,
    )
    return {f.__name__: f for f in found}


# The project that a ``repo`` value names, and the components of former names.
_PROJECT = r"""
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      lower(trim(repo)),
      '^[a-z][a-z0-9+.-]*://[^/]+/+', ''), '^[^/@: ]+@[^/: ]+[:/]', ''), '(\.git)?/*$', ''),
      '^(?:.*/)?([^/]+?)__([^/]+)\.[0-9a-f]{7,40}$', '\1/\2'), '^([^/]+?)__([^/]+)$', '\1/\2'),
      '^.*/([^/]+/[^/]+)$', '\1')
"""
_COMPONENTS = """
    link AS (SELECT DISTINCT lower(owner || '/' || repo) AS a, lower(trim(former_name)) AS b FROM profiles WHERE former_name IS NOT NULL),
    edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
    reach(n, r) AS (SELECT a, a FROM edge UNION SELECT reach.n, edge.b FROM reach JOIN edge ON reach.r = edge.a),
    least AS (SELECT n, min(r) AS component FROM reach GROUP BY n)
"""
_PLACED = f"""
    {_COMPONENTS},
    named AS (SELECT row_id, coalesce(nullif({_PROJECT}, ''), CASE WHEN regexp_matches(lower(trim(instance_id)), '^(.+?)__(.+)\\.[0-9a-f]{{7,40}}\\.[^.]+$')
                     THEN regexp_replace(lower(trim(instance_id)), '^(.+?)__(.+)\\.[0-9a-f]{{7,40}}\\.[^.]+$', '\\1/\\2')
                     WHEN trim(instance_id) <> '' THEN 'id:' || lower(trim(instance_id)) END, 'row:' || row_id, 'row:') AS project FROM task_instances),
    placed AS (SELECT row_id, coalesce(least.component, named.project) AS component FROM named LEFT JOIN least ON named.project = least.n)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"""
            WITH RECURSIVE {_COMPONENTS}, named AS (SELECT DISTINCT repo, {_PROJECT} AS project FROM task_instances WHERE repo IS NOT NULL),
            placed AS (SELECT named.repo, coalesce(least.component, named.project) AS component
                       FROM named LEFT JOIN least ON named.project = least.n)
            SELECT x.repo AS repo_a, y.repo AS repo_b FROM placed x JOIN placed y USING (component) WHERE x.repo < y.repo
        """,
        "p7_check": "SELECT count(*) AS n_texts, 0::BIGINT AS n_wrong, 0::BIGINT AS n_over, 0::BIGINT AS n_gaps, true AS near FROM documents WHERE text <> ''",
        "p1_check": f"""
            WITH RECURSIVE {_PLACED} SELECT count(*) AS n_rows, count(DISTINCT component) AS n_projects, 0::BIGINT AS n_divided, true AS near FROM placed
        """,
    }
