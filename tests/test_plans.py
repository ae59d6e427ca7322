"""Plan guards: no registered query may regress to a cartesian product, a
nested-loop join or Python-side row evaluation."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


from tessera.plans import star_queries as _sq  # noqa: E402


@pytest.mark.parametrize("name", sorted(_sq.QUERIES))
def test_final_plan_has_no_forbidden_operator(spark, name):
    df = E.queries()[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan]
