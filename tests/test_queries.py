"""Every registered query against its SQL, and plans that must hold at scale."""

import os

import pytest

from __spark_entry__ import entry
from adlake.workload import ORACLES, QUERIES
from tools.check import compare, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""


def test_entry(spark):
    assert entry(spark).count() == 5


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    plan = plan_of(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "MapInArrow"):
        assert bad not in plan


def test_flat_metrics_need_no_shuffle(spark):
    assert "Exchange" not in plan_of(spark, "flatten_insights")
    assert "Generate" not in plan_of(spark, "flatten_insights")


def test_report_merge_shuffles_the_merged_rows_once(spark):
    plan = plan_of(spark, "report_merge")
    assert "Join" not in plan


def test_columns_are_pruned(spark):
    plan = plan_of(spark, "day_key_counts")
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan and "GreaterThanOrEqual(ts" in plan
