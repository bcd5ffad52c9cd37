"""Schemas of the raw layer, declared once and never inferred.

Inference would turn ZIP prefixes into integers and money into floating point.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()
_INT = T.IntegerType()
_MOMENT = T.TimestampNTZType()
_MONEY = T.DecimalType(10, 2)
_DEGREES = T.DecimalType(12, 8)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Names and types of the raw tables and of the order event.
RAW: dict[str, T.StructType] = {
    "orders": _table(
        order_id=_TEXT, customer_id=_TEXT, order_status=_TEXT,
        order_purchase_timestamp=_MOMENT, order_approved_at=_MOMENT,
        order_delivered_carrier_date=_MOMENT, order_delivered_customer_date=_MOMENT,
        order_estimated_delivery_date=_MOMENT,
    ),
    "customers": _table(
        customer_id=_TEXT, customer_unique_id=_TEXT, customer_zip_code_prefix=_TEXT,
        customer_city=_TEXT, customer_state=_TEXT,
    ),
    "order_items": _table(
        order_id=_TEXT, order_item_id=_INT, product_id=_TEXT, seller_id=_TEXT,
        shipping_limit_date=_MOMENT, price=_MONEY, freight_value=_MONEY,
    ),
    "payments": _table(
        order_id=_TEXT, payment_sequential=_INT, payment_type=_TEXT,
        payment_installments=_INT, payment_value=_MONEY,
    ),
    "reviews": _table(
        review_id=_TEXT, order_id=_TEXT, review_score=_INT, review_comment_title=_TEXT,
        review_comment_message=_TEXT, review_creation_date=_MOMENT,
        review_answer_timestamp=_MOMENT,
    ),
    "products": _table(
        product_id=_TEXT, product_category_name=_TEXT, product_name_lenght=_INT,
        product_description_lenght=_INT, product_photos_qty=_INT, product_weight_g=_MONEY,
        product_length_cm=_MONEY, product_height_cm=_MONEY, product_width_cm=_MONEY,
    ),
    "sellers": _table(
        seller_id=_TEXT, seller_zip_code_prefix=_TEXT, seller_city=_TEXT, seller_state=_TEXT,
    ),
    "geolocation": _table(
        geolocation_zip_code_prefix=_TEXT, geolocation_lat=_DEGREES, geolocation_lng=_DEGREES,
        geolocation_city=_TEXT, geolocation_state=_TEXT,
    ),
    "category_translation": _table(
        product_category_name=_TEXT, product_category_name_english=_TEXT,
    ),
}

# The fields an event producer sends, then those that may be absent.
ORDER_EVENT: T.StructType = _table(
    order_id=_TEXT, customer_state=_TEXT, product=_TEXT, price=_MONEY, freight_value=_MONEY,
    total_amount=_MONEY, payment_type=_TEXT, order_status=_TEXT, review_score=_INT,
    created_at=_TEXT,
    customer_id=_TEXT, product_id=_TEXT, seller_id=_TEXT, event_timestamp=_MOMENT,
)

# What a status and a score may be.
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "invoiced",
    "processing", "unavailable", "created", "approved",
)
REVIEW_SCORES = (1, 2, 3, 4, 5)
