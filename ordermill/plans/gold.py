"""Queries that join the warehouse tables with the order-event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import event_moment, utc_wall_time
from ..functions.money import AMOUNT, mean, order_amount


_EVENT = ("order_status", "review_score", "created_at")


def order_analytics_gold(fact: DataFrame, customers: DataFrame, products: DataFrame, *more: str) -> DataFrame:
    """Items with the state of their customer and the category of their product; ``more`` columns of the items follow."""
    return (
        fact.join(customers.select("customer_id", "customer_state"), "customer_id")
        .join(products.select("product_id", "product_category_name"), "product_id")
        .select(
            "order_id", "customer_id", "customer_state", "product_id", "product_category_name",
            "price", "freight_value", order_amount().alias("total_order_amount"), *more,
        )
    )


def _as_enriched(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        "order_id", "customer_state", "product_category_name", "total_order_amount",
        F.col("order_status").alias("status_on_s3"),
        F.col("review_score").alias("streaming_review_score"),
        F.col("created_at").alias("streaming_arrival_time"), *more,
    )


def enrich_with_events(gold: DataFrame, events: DataFrame, *more: str) -> DataFrame:
    """Gold rows of orders seen in the stream, one row per item and event; ``more`` event columns follow.

    Works for a batch of events and for a stream of them.
    """
    seen = events.select("order_id", *_EVENT, *more)
    return _as_enriched(seen.join(gold, "order_id"), *more)


def enriched_items(fact: DataFrame, customers: DataFrame, products: DataFrame, latest: DataFrame) -> DataFrame:
    """The gold rows of ``fact`` enriched with events of which no order has more than one, as by ``enrich_with_events``.

    The events meet the items first, while these still lie by order after their join with the order headers. Items are then not moved by
    order a second time, and those of orders that the stream has not seen travel to neither customers nor products.
    """
    seen = latest.select("order_id", *_EVENT).join(fact, "order_id")
    return _as_enriched(order_analytics_gold(seen, customers, products, *_EVENT))


def newest_first(enriched: DataFrame) -> DataFrame:
    """By event time; the order inside one second keeps that second from landing in one task."""
    return enriched.orderBy(
        event_moment(F.col("streaming_arrival_time")).desc_nulls_last(), "order_id", "status_on_s3", "total_order_amount"
    )


def latest_event_per_order(events: DataFrame, tie_break: str = "order_status") -> DataFrame:
    """Newest event of each order by real time; equal times are decided by ``tie_break``, larger first.

    An event whose time does not parse counts as the oldest.

    A maximum over structs is combined map-side, so an order with very many events never
    gathers in one task the way a ranking window would.
    """
    others = [c for c in events.columns if c not in ("order_id", "created_at", tie_break)]
    ranked = F.struct(event_moment(F.col("created_at")).alias("_at"), tie_break, *others, "created_at")
    return (
        events.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.max(ranked).alias("latest"))
        .select("order_id", "latest.*")
        .select(*events.columns)
    )


def revenue_by_state_confirmed(gold: DataFrame, events: DataFrame) -> DataFrame:
    """Revenue per state over all item and event pairs of orders seen in the stream.

    Sums over pairs follow from per-order sums on either side, so the pairs themselves are
    never built: an item amount counts once per event, a score once per item.
    """
    ordered = gold.groupBy("customer_state", "order_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("total_order_amount").cast(AMOUNT).alias("amount"),
        F.count("total_order_amount").alias("priced_items"),
    )
    seen = events.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("review_score").alias("score"),
        F.count("review_score").alias("scored_events"),
    )
    amount = F.sum(F.col("amount") * F.col("events").cast("decimal(18,0)"))
    return (
        ordered.join(seen, "order_id")
        .groupBy("customer_state")
        .agg(
            F.count("order_id").alias("total_orders"),
            amount.cast(AMOUNT).alias("total_revenue"),
            mean(amount, F.sum(F.col("priced_items") * F.col("events"))).alias("avg_order_value"),
            mean(
                F.sum(F.col("score") * F.col("items")),
                F.sum(F.col("scored_events") * F.col("items")),
            ).alias("avg_review_score"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"))
    )


def unified_orders(events: DataFrame, fact: DataFrame) -> DataFrame:
    """Stream events and warehouse items as one list of timed amounts."""
    streamed = events.select(
        F.lit("Streaming").alias("source"), "order_id",
        utc_wall_time(F.col("created_at")).alias("created_at"),
        order_amount().alias("total_amount"),
    )
    batch = fact.select(
        F.lit("Batch").alias("source"), "order_id",
        F.col("order_date_id").cast("timestamp_ntz").alias("created_at"),
        order_amount().alias("total_amount"),
    )
    return streamed.unionByName(batch)
