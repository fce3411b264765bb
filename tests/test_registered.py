"""Every registered query against its SQL, on the smallest tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from lakequery.plans.catalog import ORACLES, PLANS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return connection


def as_bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(PLANS) == set(ORACLES)
    assert set(PLANS) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query_agrees_with_sql(spark, duck, small, name):
    df = entry_points.queries()[name](spark, small)
    result = duck.execute(entry_points.oracle_sql()[name])
    expected = as_bag([d[0] for d in result.description], result.fetchall())
    assert as_bag(df.columns, df.collect()) == expected


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "o_orderkey" and df.count() == 1000


SQL_TYPES = {"boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_types_and_plan(spark, duck, small, name):
    df = entry_points.queries()[name](spark, small)
    described = duck.execute(f"DESCRIBE {entry_points.oracle_sql()[name]}").fetchall()
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == {row[0]: row[1] for row in described}
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert slow not in plan
