"""Every registered query against its SQL, on the smallest benchmark tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from chartloom.catalogue import QUERIES as CATALOGUE
from chartloom.catalogue.base import TABLES
from tools.check import rows_of

FOLDER = "/root/testdata/sf0.001"
RUNS, ALL_SQL = entry.queries(), entry.oracle_sql()
QUERIES = {name: RUNS[name] for name in CATALOGUE}
SQL = {name: sql for name, sql in ALL_SQL.items() if name in CATALOGUE}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, df.collect())
    cur = database.execute(SQL[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    """No cartesian product, no Python rows in the plan."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "recorded_dttm" in df.columns


def test_one_sql_per_query():
    assert set(SQL) == set(QUERIES)
