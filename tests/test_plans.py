"""Plan guards for every registered query: no cartesian / nested-loop joins,
no Python UDF evaluation, and the scan reads only the needed event columns."""

import pytest

from strataflow.plans.catalog import REGISTRY

KEYS = sorted(REGISTRY)
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
          "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("key", KEYS)
def test_plan_is_scalable(spark, sf001, key):
    df = REGISTRY[key](spark, sf001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in BANNED:
        assert node not in plan, f"{key}: {node} in plan"
    # the events scan never reads the columns no trip column is derived from
    for line in plan.splitlines():
        if "FileScan parquet" in line and "events.parquet" in line:
            assert "user_id" not in line and "event_type" not in line, f"{key}: unpruned scan"
