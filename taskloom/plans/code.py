"""Queries over code in eleven languages: entities and mutated entities, from the tables' own sources and from functions
written in each language under the names that the tables hold."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import diffs, entities, joins
from ..session import spread, table
from . import texts

#: A function in each language, with ``@`` for its name: a condition with two sides, a loop, an assignment and arithmetic.
WRITTEN = {
    "py": "def @(a, b):\n    total = a * 2\n    for i in range(a):\n        total = total + i\n    if total > b:\n        return total - b\n    else:\n        return b\n",
    "go": "func @(a int, b int) int {\n\ttotal := a * 2\n\tfor i := 0; i < a; i++ {\n\t\ttotal = total + i\n\t}\n\tif total > b {\n\t\treturn total - b\n\t} else {\n\t\treturn b\n\t}\n}\n",
    "rs": "pub fn @(a: i32, b: i32) -> i32 {\n    let mut total = a * 2;\n    for i in 0..a {\n        total = total + i;\n    }\n    if total > b {\n        return total - b;\n    } else {\n        return b;\n    }\n}\n",
    "js": "export function @(a, b) {\n  let total = a * 2;\n  for (let i = 0; i < a; i++) {\n    total = total + i;\n  }\n  if (total > b) {\n    return total - b;\n  } else {\n    return b;\n  }\n}\n",
    "ts": "export function @(a: number, b: number): number {\n  let total = a * 2;\n  for (let i = 0; i < a; i++) {\n    total = total + i;\n  }\n  if (total > b) {\n    return total - b;\n  } else {\n    return b;\n  }\n}\n",
    "java": "public int @(int a, int b) {\n    int total = a * 2;\n    for (int i = 0; i < a; i++) {\n        total = total + i;\n    }\n    if (total > b) {\n        return total - b;\n    } else {\n        return b;\n    }\n}\n",
    "php": "<?php\nfunction @($a, $b) {\n    $total = $a * 2;\n    for ($i = 0; $i < $a; $i++) {\n        $total = $total + $i;\n    }\n    if ($total > $b) {\n        return $total - $b;\n    } else {\n        return $b;\n    }\n}\n",
    "cpp": "int @(int a, int b) {\n    int total = a * 2;\n    for (int i = 0; i < a; i++) {\n        total = total + i;\n    }\n    if (total > b) {\n        return total - b;\n    } else {\n        return b;\n    }\n}\n",
    "c": "int @(int a, int b) {\n    int total = a * 2;\n    for (int i = 0; i < a; i++) {\n        total = total + i;\n    }\n    if (total > b) {\n        return total - b;\n    } else {\n        return b;\n    }\n}\n",
    "cs": "public int @(int a, int b) {\n    int total = a * 2;\n    for (int i = 0; i < a; i++) {\n        total = total + i;\n    }\n    if (total > b) {\n        return total - b;\n    } else {\n        return b;\n    }\n}\n",
    "rb": "def @(a, b)\n  total = a * 2\n  while total < a\n    total = total + 1\n  end\n  if total > b\n    return total - b\n  else\n    return b\n  end\nend\n",
}


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, n, block, ext): the blocks of source documents that define a function, by the language of its first line."""
    rows = table(spark, folder, "documents").where("kind = 'source'").select("doc_id", F.posexplode(F.split("text", r"\r?\n\r?\n")).alias("n", "block"))
    rows = rows.withColumn("block", F.regexp_replace("block", "(?m)^```.*$", ""))  # the fences of quoted code aren't code
    return spread(rows.withColumn("ext", entities.language_of(F.col("block"))).where("ext is not null"))


def source_entities(spark: SparkSession, folder: str) -> DataFrame:
    return entities.entities(blocks(spark, folder), ["doc_id", "n"], "block", F.col("ext")).select("doc_id", "n", "ext", "name")


def modifier_candidates(spark: SparkSession, folder: str) -> DataFrame:
    found = entities.entities(blocks(spark, folder), ["doc_id", "n"], "block", F.col("ext"))
    return joins.applicable(found, entities.modifiers(spark)).groupBy("ext", "modifier").agg(F.count(F.lit(1)).alias("n"))


def mutated_entities(spark: SparkSession, folder: str) -> DataFrame:
    return entities.mutations(blocks(spark, folder), ["doc_id", "n"], "block", F.col("ext"), seed=24)


def _named(spark: SparkSession, folder: str, ext: str) -> DataFrame:
    names = texts._functions(spark, folder).select("name").distinct()
    return names.select(F.col("name").alias("wanted"), F.replace(F.lit(WRITTEN[ext]), F.lit("@"), F.col("name")).alias("source"))


def _entities(ext: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        found = entities.entities(_named(spark, folder, ext), ["wanted"], "source", F.lit(ext))
        return found.select("wanted", "name", "line_start", "line_end", *(F.array_contains("tags", t).alias(t) for t in ("has_loop", "has_if", "has_binary_op")))

    query.__name__ = f"entities_{ext}"
    query.__doc__ = f"Functions written in {ext} under every name of the table, found again with their lines and tags."
    return query


def _mutations(ext: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = _named(spark, folder, ext)
        made = entities.mutations(rows.select(F.col("wanted"), "source", F.col("source").alias("before")), ["wanted", "before"], "source", F.lit(ext), seed=24)

        @F.pandas_udf("boolean")
        def undone(before: pd.Series, patch: pd.Series) -> pd.Series:
            """Whether a patch applies, changes something, and its inverse gives the source back."""
            out = []
            for b, p in zip(before, patch, strict=True):
                after = diffs.apply_to(b, diffs.parse(p)[0].hunks)
                out.append(after is not None and after != b and diffs.apply_to(after, diffs.parse(diffs.inverted(p))[0].hunks) == b)
            return pd.Series(out)

        checked = made.groupBy("wanted").agg(F.count(F.lit(1)).alias("n"), F.count_if(~undone("before", "patch")).alias("n_bad"))
        return rows.select("wanted").join(checked, "wanted", "left").select("wanted", (F.coalesce("n", F.lit(0)) > 0).alias("mutated"), F.coalesce("n_bad", F.lit(0)).alias("n_bad"))

    query.__name__ = f"mutations_{ext}"
    query.__doc__ = f"Functions written in {ext}: whether some modifier changed each, and how many of its patches don't apply and undo."
    return query


_NAMES = f"""WITH {texts._FUNCTIONS}, names AS (SELECT DISTINCT name FROM functions)"""


def _lines(ext: str) -> tuple[int, int]:
    count = WRITTEN[ext].count("\n")
    return (2, count) if ext == "php" else (1, count)


_UNCHANGED = ("c", "cs")  #: languages without modifiers

SQL = {
    "source_entities": r"""WITH b AS (SELECT doc_id, unnest(string_split_regex(text, '\r?\n\r?\n')) AS block,
                generate_subscripts(string_split_regex(text, '\r?\n\r?\n'), 1) - 1 AS n FROM documents WHERE kind = 'source' AND text IS NOT NULL),
            m AS (SELECT *, regexp_extract(block, '(?m)^(def|func|function|export function|fn|pub fn) ([\pL\pN_]+)[^\s(\[]*\(', ['head', 'name']) AS f FROM b)
        SELECT doc_id, n::INT AS n, CASE f.head WHEN 'def' THEN 'py' WHEN 'func' THEN 'go' WHEN 'fn' THEN 'rs' WHEN 'pub fn' THEN 'rs' ELSE 'js' END AS ext, f.name AS name
        FROM m WHERE f.name <> ''""",
} | {
    f"entities_{ext}": f"""{_NAMES} SELECT name AS wanted, name, {_lines(ext)[0]} AS line_start, {_lines(ext)[1]} AS line_end,
        true AS has_loop, true AS has_if, true AS has_binary_op FROM names"""
    for ext in WRITTEN
} | {f"mutations_{ext}": f"{_NAMES} SELECT name AS wanted, {ext not in _UNCHANGED} AS mutated, 0::BIGINT AS n_bad FROM names" for ext in WRITTEN}

QUERIES = (source_entities, modifier_candidates, mutated_entities, *map(_entities, WRITTEN), *map(_mutations, WRITTEN))
