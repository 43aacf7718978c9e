"""The registered training-data queries: against their SQL, and native ones without Python."""

import os

import duckdb
import pytest

import __spark_entry__ as registry
import corpus_pipeline
from tallyhouse.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

NATIVE = {3, 4, 7, 9}


def test_all_are_registered():
    assert {**QUERIES, "pipeline": corpus_pipeline.run}.items() <= registry.queries().items()
    assert ORACLES.items() <= registry.oracle_sql().items()
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    db = duckdb.connect()
    for file in os.listdir(SF_DIR):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    want = db.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == sorted(map(repr, want.fetchall()))


@pytest.mark.parametrize("name", sorted(name for name in QUERIES if int(name[2:].split("_")[0]) in NATIVE))
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for python in ("EvalPython", "InPandas", "InArrow", "ExistingRDD", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert python not in plan
