"""Every query of the core by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import loglines, skew
from ..session import spread, table
from . import code, extra, rounds, tasks, texts

Query = Callable[[SparkSession, str], DataFrame]


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return skew.heavy_repos(table(spark, folder, "task_instances"))


def p2_repo_results(spark: SparkSession, folder: str) -> DataFrame:
    return skew.repo_results(table(spark, folder, "task_instances"))


def p5_entries(spark: SparkSession, folder: str) -> DataFrame:
    return loglines.log_entries(spread(table(spark, folder, "run_outputs").select("output_id", "output", "captured_at")))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_entries(spark, folder).drop("message")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return tasks.transition_report(spark, folder)


def queries() -> dict[str, Query]:
    own = (p2_found, p2_repo_results, p5_found, p5_entries)
    return {f.__name__: f for f in (*own, *tasks.QUERIES, *texts.QUERIES, *rounds.QUERIES, *extra.QUERIES, *code.QUERIES)}


def oracle_sql() -> dict[str, str]:
    return tasks.SQL | texts.SQL | rounds.SQL | extra.SQL | code.SQL | {
        "p2_found": """
            SELECT repo FROM task_instances WHERE repo IS NOT NULL GROUP BY repo
            HAVING count(*) * 20 > (SELECT count(*) FROM task_instances)
        """,
        "p2_repo_results": """
            SELECT repo, count(*) AS n_rows,
                   coalesce(sum(len(FAIL_TO_PASS)), 0)::BIGINT AS n_fail_to_pass,
                   coalesce(sum(len(PASS_TO_PASS)), 0)::BIGINT AS n_pass_to_pass,
                   count(nullif(patch, '')) AS n_patches,
                   coalesce(sum(length(nullif(patch, ''))), 0)::BIGINT AS patch_chars,
                   min(length(nullif(patch, '')))::BIGINT AS patch_chars_min,
                   max(length(nullif(patch, '')))::BIGINT AS patch_chars_max,
                   count(DISTINCT instance_id) AS n_instances
            FROM task_instances GROUP BY repo
        """,
    }
