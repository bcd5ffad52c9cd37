"""The declared checks of the staging and marts layers."""

from __future__ import annotations

from ..operators.quality import Check
from ..schemas import ORDER_STATUSES, REVIEW_SCORES


def _key(model: str, column: str) -> list[Check]:
    return [Check(model, column, "not_null"), Check(model, column, "unique")]


# The checks that the layers declare.
STAGING_CHECKS: list[Check] = [
    *_key("stg_orders", "order_id"),
    Check("stg_orders", "customer_id", "not_null"),
    Check("stg_orders", "order_status", "accepted_values", values=ORDER_STATUSES),
    *_key("stg_orders_payments", "order_id"),
    *_key("stg_customers", "customer_id"),
    *_key("stg_products", "product_id"),
    Check("stg_order_items", "order_id", "not_null"),
    Check("stg_order_items", "price", "not_null"),
    Check("stg_payments", "order_id", "not_null"),
    Check("stg_payments", "payment_type", "not_null"),
    Check("stg_reviews", "review_id", "not_null"),
    Check("stg_reviews", "review_score", "accepted_values", values=REVIEW_SCORES),
    *_key("stg_sellers", "seller_id"),
    Check("stg_geolocation", "geolocation_zip_code_prefix", "not_null"),
    *_key("stg_category_translation", "product_category_name"),
    *_key("stg_category_translation", "product_category_name_english"),
]

MARTS_CHECKS: list[Check] = [
    Check("fact_order_items", "order_id", "not_null"),
    Check(
        "fact_order_items", "order_id", "relationships",
        parent="stg_orders", parent_column="order_id",
    ),
    Check("fact_order_items", "order_item_id", "not_null"),
    Check("fact_order_items", "product_id", "not_null"),
    Check(
        "fact_order_items", "product_id", "relationships",
        parent="stg_products", parent_column="product_id",
    ),
    Check("fact_order_items", "price", "not_null"),
    Check("fact_order_items", "price", "accepted_range", low=0, inclusive=False),
    Check("fact_order_items", "freight_value", "not_null"),
    Check("fact_order_items", "freight_value", "accepted_range", low=0),
    *_key("dim_customers", "customer_id"),
    Check("dim_customers", "customer_unique_id", "not_null"),
    Check("dim_customers", "customer_zip_code_prefix", "not_null"),
    *_key("dim_products", "product_id"),
    Check("dim_products", "product_category", "not_null"),
]
