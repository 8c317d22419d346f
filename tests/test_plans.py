"""Physical-plan properties the design relies on."""

import re

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

# The training-data operators have plan tests of their own. Spark's ALS plans a
# blocked CartesianProduct of user and item blocks inside recommendForAllUsers.
QUERIES = {k: v for k, v in E.queries().items() if not re.match(r"op\d+_|pipeline$|als_", k)}
NO_PLAN = {"stream_recs", "table_roundtrip"}


def plan_of(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_PLAN))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["recent_n", "recent_queue", "factor_topk", "itemcf_recs", "stream_candidates"])
def test_top_k_windows_are_limited_before_shuffle(spark, name):
    assert "WindowGroupLimit" in plan_of(spark, name)


@pytest.mark.parametrize("name", ["rate_more", "average_score", "monthly_counts"])
def test_partial_aggregation_and_pruned_scan(spark, name):
    plan = plan_of(spark, name)
    assert plan.count("HashAggregate") >= 2
    assert "l_extendedprice" not in plan and "l_comment" not in plan


def test_python_only_in_blocked_kernels(spark):
    for name in sorted(set(QUERIES) - NO_PLAN):
        plan = plan_of(spark, name)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
