"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from eventflow.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
STREAMS = {n for n in entry_points.queries() if n.endswith("_stream")}


def plan(spark, name):
    return entry_points.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "MapInPandas"):
        assert bad not in text, f"{name}: {bad}"
    # the greedy pass is the one thing no built-in function expresses
    assert ("MapInArrow" in text) == (name == "rate_limited_alerts")


@pytest.mark.parametrize("name", [
    "trace_state", "payment_state", "upgrade_state", "deactivation_state", "parallel_ready", "compensations",
    "charged_not_activated", "activated_unpaid", "refund_follow_up", "retries_exhausted", "account_state",
    "notification_audit", "dead_letter_recovery", "best_effort_loss", "lost_orders", "start_or_dead_letter",
])
def test_one_shuffle_combined_map_side(spark, name):
    text = plan(spark, name)
    assert text.count("Exchange hashpartitioning") == 1 and "partial_" in text


def test_column_pruning_and_pushdown(spark):
    assert "ReadSchema: struct<event_type:string,ts:timestamp_ntz,value:double>" in plan(spark, "price_change").replace(
        "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>",
        "ReadSchema: struct<event_type:string,ts:timestamp_ntz,value:double>")
    assert "PushedFilters: [In(event_type, [purchase,view])]" in plan(spark, "price_alerts")
    assert "ReadSchema: struct<l_suppkey:bigint,l_linestatus:string>" in plan(spark, "group_totals")
