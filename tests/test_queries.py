"""Every core query runs on the smallest tables and agrees with its SQL."""

import math
from pathlib import Path

import duckdb
import pytest

from taskloom.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in found)


def test_names():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 70


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, name):
    frame = QUERIES[name](spark, data)
    got = rows(frame.columns, frame.collect())
    if name in SQL:
        db = duckdb.connect()
        for p in Path(data).glob("*.parquet"):
            db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        result = db.execute(SQL[name])
        assert got == rows([c[0] for c in result.description], result.fetchall())


def test_flagship(spark, data):
    assert registry.flagship(spark, data).count() > 0
