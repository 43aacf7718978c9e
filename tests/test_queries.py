"""Every registered query of the warehouse against its SQL, and the shape of its plan.

The training-data queries have tests of their own, which go with their folder.
"""

import os

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


def test_every_query_has_its_sql():
    assert set(registry._ORACLES) == set(registry._QUERIES)
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry._QUERIES))
def test_query(spark, db, name):
    df = registry.queries()[name](spark, SF_DIR)
    want = db.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(repr(r) for r in want.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect()) == expected
    assert expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert costly not in plan


def test_entry(spark):
    assert registry.entry(spark).count() > 0
