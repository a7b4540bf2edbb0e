"""Every registered query against its check SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registry

from .conftest import SMALL

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(0.0 if r[i] == 0 else r[i]) for i in order) for r in rows)


def test_every_check_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_check(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cursor = duck.execute(SQL[name])
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(list(kinds), expected)


def test_entry(spark):
    df = registry.entry(spark)
    assert sorted(df.columns) == ["FL_DAY_OF_WEEK", "avg_delay", "flights"]
    assert df.count() == 7
