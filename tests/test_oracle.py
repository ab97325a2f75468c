"""Every query with SQL gives the same rows in Spark and in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from docweir.plans.catalog import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{small}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'" if os.path.isdir(path) else f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float) and math.isfinite(value):
        return float(f"{value:.9g}")
    return value if isinstance(value, (int, str)) else str(value)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(name, spark, duck, small):
    got = QUERIES[name](spark, small)
    want = duck.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, map(tuple, got.collect())) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(name, spark, small):
    assert QUERIES[name](spark, small).count() > 0
