from __future__ import annotations

from datetime import date

import pytest
from helpers import at, money, raw_rows, rows
from pyspark.sql import functions as F

from ordermill.functions.dates import utc_wall_time, whole_days
from ordermill.operators import staging
from ordermill.plans import marts


def test_null_key_is_dropped_by_staging(spark):
    raw = raw_rows(spark, "orders", {"order_id": "a"}, {"order_id": None, "customer_id": "c"})
    assert rows(staging.stg_orders(raw), "order_id") == [("a",)]


def test_geolocation_keeps_null_zip_as_one_group(spark):
    raw = raw_rows(
        spark, "geolocation",
        {"geolocation_city": "b", "geolocation_lat": money("1.00")},
        {"geolocation_city": "a", "geolocation_lat": money("2.00")},
    )
    result = marts.dim_geolocation(staging.stg_geolocation(raw)).collect()
    assert len(result) == 1
    assert (result[0].zip_code_prefix, result[0].city, result[0].avg_lat) == (None, "a", 1.5)
    assert result[0].avg_lng is None


def test_category_is_translated_or_kept_or_named_others(spark):
    products = raw_rows(
        spark, "products",
        {"product_id": "1", "product_category_name": "livros"},
        {"product_id": "2", "product_category_name": "novo"},
        {"product_id": "3"},
    )
    names = raw_rows(
        spark, "category_translation",
        {"product_category_name": "livros", "product_category_name_english": "books"},
    )
    result = marts.dim_products(
        staging.stg_products(products), staging.stg_category_translation(names)
    )
    assert rows(result, "product_id", "product_category") == [("1", "books"), ("2", "novo"), ("3", "others")]


def test_payment_types_are_distinct_and_sorted(spark):
    raw = raw_rows(
        spark, "payments",
        {"order_id": "1", "payment_type": "b", "payment_value": money("1.10"), "payment_installments": 3},
        {"order_id": "1", "payment_type": "a", "payment_value": money("2.20"), "payment_installments": 1},
        {"order_id": "1", "payment_type": "b", "payment_value": money("3.30"), "payment_installments": 2},
        {"order_id": "2"},
        {"order_id": None, "payment_type": "a"},
    )
    result = staging.stg_orders_payments(staging.stg_payments(raw))
    assert rows(result, "order_id", "payment_types", "payment_total", "max_installments", "payment_count") == [
        ("1", "a,b", money("6.60"), 3, 3),
        ("2", None, None, None, 1),
    ]


def test_default_calendar(spark):
    days = marts.dim_date(spark)
    assert days.count() == 5479
    first = days.where("date_id = date'2016-01-03'").first()
    assert (first.day_of_week, first.is_weekend, first.quarter) == (0, True, 1)
    assert (first.month_name, first.day_name) == ("January  ", "Sunday   ")


@pytest.mark.parametrize(
    ("start", "end", "days"),
    [
        ("2020-01-01 00:00:00", "2020-01-02 20:00:00", 1),
        ("2020-01-02 20:00:00", "2020-01-01 00:00:00", -1),
        ("2020-01-01 23:00:00", "2020-01-02 01:00:00", 0),
    ],
)
def test_delivery_days_are_whole_periods(spark, start, end, days):
    df = spark.createDataFrame([(start, end)], "s STRING, e STRING").select(
        F.col("s").cast("timestamp_ntz").alias("s"), F.col("e").cast("timestamp_ntz").alias("e")
    )
    assert df.select(whole_days(F.col("s"), F.col("e"))).first()[0] == days


def test_event_time_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-05-01T10:00:00Z",), ("2024-05-01T10:00:00+02:00",)], "t STRING")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        found = rows(df.select(utc_wall_time(F.col("t")).alias("t")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert set(found) == {(at("2024-05-01T08:00:00"),), (at("2024-05-01T10:00:00"),)}


def _facts(spark, *items):
    return spark.createDataFrame(
        [(o, p, c, d, money(price), money("0.50")) for o, p, c, d, price in items],
        "order_id STRING, product_id STRING, customer_id STRING, order_date_id DATE, "
        "price DECIMAL(10,2), freight_value DECIMAL(10,2)",
    )


def test_mart_counts_an_order_per_product_and_drops_days_outside_the_calendar(spark):
    day = date(2020, 5, 1)
    fact = _facts(
        spark,
        ("o1", "p1", "c1", day, "10.00"),
        ("o1", "p2", "c1", day, "20.01"),
        ("o2", "p1", "c1", date(2031, 1, 1), "99.00"),
        ("o3", "missing", "c1", day, "99.00"),
        ("o4", "p1", "missing", day, "99.00"),
    )
    products = spark.createDataFrame([("p1", "toys"), ("p2", "toys")], "product_id STRING, product_category STRING")
    customers = spark.createDataFrame([("c1", "SP")], "customer_id STRING, customer_state STRING")
    result = marts.mart_revenue_daily(fact, marts.dim_date(spark), products, customers).collect()
    assert len(result) == 1
    row = result[0]
    assert (row.date_day, row.year, row.month, row.quarter, row.day) == (day, 2020, 5, 2, 1)
    assert (row.total_orders, row.unique_customers) == (2, 1)
    assert (row.gross_revenue, row.freight_cost, row.total_revenue) == (money("30.01"), money("1.00"), money("31.01"))
    assert row.avg_order_value == money("15.01")


def test_product_volume_and_clean_customers(spark):
    products = raw_rows(
        spark, "products",
        {"product_id": "1", "product_length_cm": money("2"), "product_height_cm": money("3.5"), "product_width_cm": money("4")},
        {"product_id": "2"},
    )
    volumes = {r.product_id: r.volume_cm3 for r in staging.product_volume(products).collect()}
    assert volumes["1"] == 28 and volumes["2"] is None
    people = raw_rows(spark, "customers", {"customer_id": "1", "customer_city": "sao PAULO", "customer_state": "sp"})
    assert rows(staging.clean_customers(people), "customer_city", "customer_state") == [("Sao Paulo", "SP")]
