"""Every registered query against its SQL, at the smallest scale, and the shape of its plan."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def ordered(columns, rows):
    positions = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in positions) for row in rows)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    df = contract.queries()[name](spark, SF)
    result = db.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.columns, df.collect()) == ordered(columns, result.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan, node


def test_entry(spark):
    assert contract.entry(spark).count() > 0
