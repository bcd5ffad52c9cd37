"""Documented business metrics over the facts and dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import whole_days
from ..functions.money import AMOUNT, mean
from ..functions.ranking import band, band_edges
from ..session import settle


def _revenue() -> Column:
    return F.sum("price").cast(AMOUNT).alias("revenue")


def _orders() -> Column:
    return F.count_distinct("order_id").alias("total_orders")


def monthly_revenue(fact: DataFrame, days: DataFrame) -> DataFrame:
    return (
        fact.join(
            days.select("date_id", "year", "month"), F.col("order_date_id") == F.col("date_id")
        )
        .groupBy("year", "month")
        .agg(_orders(), F.sum("price").cast(AMOUNT).alias("gross_revenue"))
        .orderBy("year", "month")
    )


def top_categories(fact: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    per_product = fact.groupBy("product_id").agg(F.sum("price").alias("price"))
    return (
        per_product.join(products.select("product_id", "product_category"), "product_id")
        .groupBy("product_category")
        .agg(_revenue())
        .orderBy(F.desc("revenue"), "product_category")
        .limit(n)
    )


def freight_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    per_product = fact.groupBy("product_id").agg(
        F.sum("freight_value").alias("freight"), F.count("freight_value").alias("items")
    )
    return (
        per_product.join(products.select("product_id", "product_category"), "product_id")
        .groupBy("product_category")
        .agg(
            F.sum("freight").cast(AMOUNT).alias("total_freight"),
            mean(F.sum("freight"), F.sum("items")).alias("avg_freight"),
        )
    )


def deliveries(raw_orders: DataFrame) -> DataFrame:
    """Orders with delivery time in whole days and lateness; undelivered ones have NULLs."""
    delivered = F.col("order_delivered_customer_date")
    return raw_orders.select(
        "order_id", "customer_id", "order_status",
        whole_days(F.col("order_purchase_timestamp"), delivered).alias("delivery_days"),
        (delivered > F.col("order_estimated_delivery_date")).alias("is_late"),
    )


def avg_delivery_days(timed: DataFrame) -> DataFrame:
    return timed.where(F.col("order_status") == "delivered").agg(
        mean(F.sum("delivery_days"), F.count("delivery_days")).alias("avg_delivery_days"),
        F.count(F.lit(1)).alias("delivered_orders"),
    )


def late_rate(timed: DataFrame) -> DataFrame:
    late = F.count_if(F.col("is_late"))
    total = F.count(F.lit(1))
    return timed.agg(
        late.alias("late_orders"), total.alias("total_orders"), mean(late, total).alias("late_rate")
    )


def delivery_histogram(timed: DataFrame) -> DataFrame:
    return (
        timed.where(F.col("delivery_days").isNotNull())
        .groupBy("delivery_days")
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("rows"), "table_name")


def customers_by_state(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers and orders per state; customers without orders count as well.

    Orders are counted per customer before the join, so a customer with very many of them
    is one row there.
    """
    per_customer = customer_order_counts(orders)
    return (
        customers.join(per_customer, "customer_id", "left")
        .groupBy("customer_state")
        .agg(
            F.count_distinct("customer_id").alias("customers"),
            F.coalesce(F.sum("total_orders"), F.lit(0)).cast("bigint").alias("orders"),
        )
    )


def customer_order_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(_orders())


def revenue_by_state(fact: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = fact.groupBy("customer_id").agg(F.sum("price").alias("price"))
    return (
        per_customer.join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(_revenue())
    )


def seller_revenue_rating(fact: DataFrame, reviews: DataFrame) -> DataFrame:
    """Revenue and mean rating per seller.

    A review rates its order and so every seller in it, once. Items meet the sums of their order's reviews first and are
    then summed per seller and order, so the fact is read once. What an order's reviews say is the same for all its items, and is
    one value of a struct: such groups are formed by sorting, without a hash table of all pairs of seller and order in a task.
    """
    per_order = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score"), F.count("review_score").alias("reviews")
    )
    in_order = (
        fact.join(per_order.select("order_id", F.struct("score", "reviews").alias("rated")), "order_id", "left")
        .groupBy("order_id", "seller_id")
        .agg(F.sum("price").alias("price"), F.any_value("rated").alias("rated"))
    )
    return (
        in_order.groupBy("seller_id")
        .agg(
            _revenue(),
            mean(F.sum("rated.score"), F.sum("rated.reviews")).alias("avg_review_score"),
            F.coalesce(F.sum("rated.reviews"), F.lit(0)).cast("bigint").alias("review_count"),
        )
    )


def payment_preference(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payments"),
        F.sum("payment_value").cast(AMOUNT).alias("payment_value"),
    )


def rfm_segments(fact: DataFrame, customers: DataFrame, bands: int = 5) -> DataFrame:
    """Recency, frequency and monetary score of every customer, 1 (low) to ``bands``.

    A score says into which equal share of the customers a value falls; equal values get
    equal scores. The shares' edges are exact, see ``ranking.band_edges``.
    """
    per_order = fact.groupBy("customer_id", "order_id").agg(
        F.max("order_date_id").alias("day"), F.sum("price").alias("price")
    )
    measured = settle(
        per_order.groupBy("customer_id")
        .agg(
            F.max("day").alias("last_order_day"),
            F.count(F.lit(1)).alias("orders"),
            F.sum("price").alias("spent"),
        )
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.max("last_order_day").alias("last_order_day"),
            F.sum("orders").alias("frequency"),
            F.sum("spent").cast(AMOUNT).alias("monetary"),
        )
    )
    newest = measured.agg(F.max("last_order_day")).first()[0]
    measures = {
        "r_score": F.unix_date("last_order_day"),
        "f_score": F.col("frequency"),
        "m_score": F.col("monetary"),
    }
    edges = band_edges(measured, measures, bands)
    return measured.select(
        "customer_unique_id",
        F.date_diff(F.lit(newest), F.col("last_order_day")).alias("recency_days"),
        "frequency", "monetary",
        *(band(column, edges[name]).alias(name) for name, column in measures.items()),
    ).withColumn("segment", F.concat(*(F.col(name).cast("string") for name in measures)))
