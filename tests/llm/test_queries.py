"""Every registered query against its DuckDB oracle, and its contract's columns."""

import pytest
from oracle_check import duck, frames_equal
from strataflow.llm.oracles import ORACLES
from strataflow.llm.queries import QUERIES

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, sf01, key):
    got = QUERIES[key](spark, sf01).toPandas()
    ok, msg = frames_equal(got, duck(sf01).execute(ORACLES[key]).df())
    assert ok, msg


@pytest.mark.parametrize("key", ["op1_sharding", "op5_secret_scan"])
def test_native_queries_run_no_python(spark, sf001, key):
    plan = QUERIES[key](spark, sf001)._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in PYTHON)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_joins(spark, sf001, key):
    df = QUERIES[key](spark, sf001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
