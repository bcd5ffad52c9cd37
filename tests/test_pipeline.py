from __future__ import annotations

import pytest
from helpers import at, money, raw_rows, rows
from pyspark.sql import functions as F

from ordermill.operators.quality import QualityError
from ordermill.plans import pipeline
from ordermill.sources.catalog import store_raw


def _raw(spark, price="10.00", status="delivered"):
    return {
        "orders": raw_rows(
            spark, "orders",
            {"order_id": "o", "customer_id": "c", "order_status": status, "order_purchase_timestamp": at("2020-01-01T10:00")},
        ),
        "order_items": raw_rows(
            spark, "order_items",
            {"order_id": "o", "order_item_id": 1, "product_id": "p", "seller_id": "s", "price": money(price), "freight_value": money("0")},
        ),
        "payments": raw_rows(spark, "payments", {"order_id": "o", "payment_type": "boleto", "payment_value": money("10")}),
        "reviews": raw_rows(spark, "reviews", {"review_id": "r", "order_id": "o", "review_score": 5}),
        "customers": raw_rows(
            spark, "customers",
            {"customer_id": "c", "customer_unique_id": "u", "customer_zip_code_prefix": "01", "customer_state": "SP"},
        ),
        "products": raw_rows(spark, "products", {"product_id": "p", "product_category_name": "livros"}),
        "sellers": raw_rows(spark, "sellers", {"seller_id": "s"}),
        "geolocation": raw_rows(spark, "geolocation", {"geolocation_zip_code_prefix": "01"}),
        "category_translation": raw_rows(
            spark, "category_translation",
            {"product_category_name": "livros", "product_category_name_english": "books"},
        ),
    }


def test_build_twice(spark, layer):
    for _ in range(2):
        stored = pipeline.run(spark, _raw(spark), layer)
        assert {name: df.count() for name, df in stored.items()} == {
            "dim_date": 5479, "dim_customers": 1, "dim_sellers": 1, "dim_products": 1, "dim_geolocation": 1,
            "fact_order_items": 1, "fact_payments": 1, "mart_revenue_daily": 1,
        }
        assert stored["mart_revenue_daily"].first().product_category == "books"


def test_staging_views_are_there_for_other_sessions_and_follow_the_raw_tables(spark, layer):
    raw, staging = _raw(spark), f"{layer}_staging"
    pipeline.load_raw(spark, raw, layer)
    try:
        names = pipeline.staging_views(spark, layer, staging)
        other = spark.newSession()
        assert len(names) == 10 and {t.name for t in other.catalog.listTables(staging)} == set(names)
        assert [r.payment_types for r in other.table(f"{staging}.stg_orders_payments").collect()] == ["boleto"]
        more = raw_rows(spark, "payments", *({"order_id": "o", "payment_type": t, "payment_value": money("1")} for t in ("", "b", "a", None)))
        store_raw(more, "payments", layer)
        row = other.table(f"{staging}.stg_orders_payments").first()
        assert (row.payment_types, row.payment_count, row.payment_total) == (",a,b", 4, money("4"))
        pipeline.staging_views(spark, layer, staging)
        assert other.table(f"{staging}.stg_orders").count() == 1
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {staging} CASCADE")


def test_raw_rows_are_stored_by_the_tasks_that_read_them(spark, layer):
    store_raw(spark.range(0, 4000, 1, 4), "ids", layer)
    spans = spark.table(f"{layer}.ids").groupBy(F.input_file_name().alias("file")).agg(F.min("id"), F.max("id"))
    assert rows(spans.drop("file")) == [(0, 999), (1000, 1999), (2000, 2999), (3000, 3999)]


def test_daily_mart_moves_the_items_once_before_the_dimensions(spark, layer):
    stored = pipeline.run(spark, _raw(spark), layer)
    daily = pipeline.daily_mart(stored)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(order_date_id" in line]
    assert sum("REPARTITION_BY_NUM" in line for line in moved) == 1
    assert not [line for line in moved if "product_id" in line]
    assert rows(daily) == rows(stored["mart_revenue_daily"])


def test_failing_staging_check_stops_before_the_marts(spark, layer):
    with pytest.raises(QualityError, match="order_status accepted_values"):
        pipeline.run(spark, _raw(spark, status="lost"), layer)
    assert not spark.catalog.tableExists(f"{layer}.fact_order_items")


def test_failing_marts_check_is_reported(spark, layer):
    with pytest.raises(QualityError, match="price accepted_range_above_0: 1"):
        pipeline.run(spark, _raw(spark, price="0"), layer)
