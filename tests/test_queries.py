"""Every registered query against its SQL on the smallest data folder."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402
from testbed.catalogue import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{FOLDER}/{name}'")
    return con


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple("~" if r[i] is None else str(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
    got = table(df.columns, df.collect())
    answer = duck.execute(SQL[name])
    want = table([d[0] for d in answer.description], answer.fetchall())
    assert got == want


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
