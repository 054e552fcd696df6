"""Plan-shape guards: pushdown, no Python in the plan, exchange reuse in the ledger scan."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("key,pushed", [("horizon_filter", "GreaterThanOrEqual(ts"),
                                        ("daily_average", "GreaterThanOrEqual(ts")])
def test_range_filters_reach_the_scan(spark, key, pushed):
    plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and pushed in plan


@pytest.mark.parametrize("key", ["battery_ledger", "interpolate_linear", "align_nearest", "seq_to_seq_windows",
                                 "extract_price_table", "sun_position", "plan_audit"])
def test_no_python_evaluation(spark, key):
    plan = _final_plan(E.queries()[key](spark, SF))
    for node in ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_ledger_bucket_tables_are_reused(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _final_plan(E.queries()["battery_ledger"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan


def test_bucketed_plan_inputs_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _final_plan(E.queries()["join_plan_inputs_bucketed"](spark, SF))
        other = _final_plan(E.queries()["join_plan_inputs"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan and plan.count("Bucketed: true") == 4
    assert "Exchange" in other
