"""Shape of the physical plans: what must not be in them, and what must reach the scan."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"

# Queries that only read; the others write tables or run streams while they are built.
LAZY = [
    "stg_orders", "stg_orders_payments", "dim_products", "dim_geolocation", "fact_order_items",
    "fact_payments", "mart_revenue_daily", "gold_view", "gold_stream_enrich", "gold_stream_latest",
    "gold_revenue_by_state", "unified_orders", "monthly_revenue", "top_categories",
    "seller_revenue_rating", "customers_by_state", "revenue_by_state", "freight_by_category",
    "dq_relationships", "dq_marts_report",
]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_python_no_global_window(spark, name):
    plan = _plan(contract.queries()[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Window"):
        assert word not in plan


def test_only_needed_columns_are_read(spark):
    plan = _plan(contract.queries()["revenue_by_state"](spark, SF_DIR))
    assert "l_shipdate" not in plan and "l_linenumber" not in plan and "o_totalprice" not in plan


def test_large_sides_are_not_broadcast(spark):
    """Beyond the size limit every join of two tables is a sort-merge join."""
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(contract.queries()["mart_revenue_daily"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_second_level_of_a_grouping_reuses_the_join_partitioning(spark):
    """Items joined by order are already spread by order for the per-order distinct step."""
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(contract.queries()["revenue_by_day_product_customer"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(order_id") == 2
    assert "product_id" in plan and plan.count("Exchange hashpartitioning(order_date_id") == 1


def test_pairs_of_seller_and_order_are_sorted_not_hashed(spark):
    """A hash table of all pairs, built twice in one task, took most of the task's memory."""
    plan = _plan(contract.queries()["seller_revenue_rating"](spark, SF_DIR))
    by_pair = [line for line in plan.splitlines() if "Aggregate(key" in line and "seller_id" in line and "order_id" in line]
    assert by_pair and all("SortAggregate" in line for line in by_pair)


def test_items_move_by_order_once_for_their_latest_event(spark):
    """Items, order headers and events are spread by order; after the customers nothing is again."""
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(contract.queries()["gold_stream_latest"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(order_id") == 3
