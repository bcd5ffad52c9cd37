"""Dimensions, facts and the daily revenue mart.

Joins carry no broadcast hint: Spark broadcasts a side only after checking its size
against ``spark.sql.autoBroadcastJoinThreshold``, at planning and again at run time, and
falls back to a skew-aware sort-merge join.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.money import cents, from_cents, mean, order_amount, rounded_mean_of_cents

# Default end points of the calendar and the name for an unknown category.
CALENDAR_START = date(2016, 1, 1)
CALENDAR_END = date(2030, 12, 31)
NO_CATEGORY = "others"


def dim_date(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """One row per day, both ends included."""
    span = spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day"))
    return calendar(span)


def dim_date_covering(facts: DataFrame, day_column: str) -> DataFrame:
    """Calendar from the first to the last day found in ``facts``."""
    return calendar(
        facts.agg(F.min(day_column).alias("first_day"), F.max(day_column).alias("last_day"))
    )


def calendar(span: DataFrame) -> DataFrame:
    day = F.col("date_id")
    return span.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("date_id")
    ).select(
        "date_id",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.dayofmonth(day).alias("day"),
        dates.day_of_week_from_sunday(day).alias("day_of_week"),
        dates.padded_name(day, "MMMM").alias("month_name"),
        dates.padded_name(day, "EEEE").alias("day_name"),
        dates.is_weekend(day).alias("is_weekend"),
    )


def dim_customers(staged: DataFrame) -> DataFrame:
    return staged.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    )


def dim_sellers(staged: DataFrame) -> DataFrame:
    return staged.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def dim_products(staged: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with an English category, else the original one, else ``others``."""
    category = F.coalesce(
        F.col("product_category_name_english"), F.col("product_category_name"), F.lit(NO_CATEGORY)
    )
    return staged.join(translation, "product_category_name", "left").select(
        "product_id", "product_category_name", category.alias("product_category"),
        "product_name_lenght", "product_description_lenght", "product_photos_qty",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )


def dim_geolocation(staged: DataFrame) -> DataFrame:
    """One row per ZIP prefix; rows without one form a group of their own."""

    def centre(name: str):
        return mean(F.sum(name), F.count(name))

    return staged.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        F.min("geolocation_city").alias("city"),
        F.min("geolocation_state").alias("state"),
        centre("geolocation_lat").alias("avg_lat"),
        centre("geolocation_lng").alias("avg_lng"),
    )


def dated_orders(staged_orders: DataFrame) -> DataFrame:
    """Order header columns of the facts, with the purchase day as a real date."""
    return staged_orders.select(
        "order_id", "customer_id", dates.calendar_day(F.col("purchased_at")).alias("order_date_id")
    )


def fact_order_items(staged_items: DataFrame, staged_orders: DataFrame) -> DataFrame:
    """One row per order item, with the customer and day of its order."""
    return staged_items.join(dated_orders(staged_orders), "order_id").select(
        "order_id", "order_item_id", "product_id", "seller_id", "customer_id",
        "order_date_id", "price", "freight_value",
    )


def fact_payments(staged_orders: DataFrame, order_payments: DataFrame) -> DataFrame:
    """One row per paid order."""
    return dated_orders(staged_orders).join(order_payments, "order_id").select(
        "order_id", "customer_id", "order_date_id",
        "payment_total", "payment_count", "max_installments", "payment_types",
    )


def _triples_in_cents(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_date_id", "product_id", "customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum(cents(F.col("price"))).alias("gross_revenue"),
        F.sum(cents(F.col("freight_value"))).alias("freight_cost"),
        F.sum(cents(order_amount())).alias("total_revenue"),
    )


def revenue_by_day_product_customer(fact: DataFrame) -> DataFrame:
    """Facts summed per day, product and customer before any dimension is joined."""
    amounts = ("gross_revenue", "freight_cost", "total_revenue")
    return _triples_in_cents(fact).withColumns({c: from_cents(F.col(c)) for c in amounts})


def mart_revenue_daily(
    fact: DataFrame, days: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Revenue per day, category and state.

    ``total_orders`` adds up per-triple distinct counts and ``avg_order_value`` averages
    over (day, product, customer) triples; both follow the published definition. The
    calendar is joined last: it is one row per group by then, and its columns need not
    travel through the shuffle.
    """
    grouped = (
        _triples_in_cents(fact)
        .join(products.select("product_id", "product_category"), "product_id")
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("order_date_id", "product_category", "customer_state")
        .agg(
            from_cents(F.sum("gross_revenue")).alias("gross_revenue"),
            from_cents(F.sum("freight_cost")).alias("freight_cost"),
            from_cents(F.sum("total_revenue")).alias("total_revenue"),
            F.sum("total_orders").alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
            rounded_mean_of_cents(F.sum("gross_revenue"), F.count("gross_revenue")).alias(
                "avg_order_value"
            ),
        )
    )
    day_columns = days.select(F.col("date_id").alias("date_day"), "year", "month", "quarter", "day")
    return grouped.join(day_columns, F.col("order_date_id") == F.col("date_day")).select(
        "date_day", "year", "month", "quarter", "day", "product_category", "customer_state",
        "gross_revenue", "freight_cost", "total_revenue", "total_orders",
        "unique_customers", "avg_order_value",
    )
