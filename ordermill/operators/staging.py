"""Staging models: one cleaned projection per raw table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Model:
    """A staging model: the columns of one raw table that go on, for rows that have the key.

    It is SQL text, so that one declaration serves the DataFrame and the view that is kept in the catalog.
    """

    table: str
    key: str | None
    columns: tuple[str, ...]

    def of(self, raw: DataFrame, tolerant: bool = False) -> DataFrame:
        kept = raw.where(F.col(self.key).isNotNull()) if self.key else raw
        return kept.selectExpr(*(c.replace("CAST(", "TRY_CAST(") if tolerant else c for c in self.columns))

    def statement(self, layer: str) -> str:
        kept = f" WHERE {self.key} IS NOT NULL" if self.key else ""
        return f"SELECT {', '.join(self.columns)} FROM {layer}.{self.table}{kept}"


def _time(column: str, alias: str) -> str:
    return f"CAST({column} AS TIMESTAMP_NTZ) AS {alias}"


MODELS = {
    "stg_orders": Model("orders", "order_id", (
        "order_id", "customer_id", "order_status",
        _time("order_purchase_timestamp", "purchased_at"), _time("order_delivered_customer_date", "delivered_at"),
    )),
    "stg_order_items": Model("order_items", "order_id", (
        "order_id", "order_item_id", "product_id", "seller_id",
        _time("shipping_limit_date", "shipping_limit_at"), "price", "freight_value",
    )),
    "stg_payments": Model("payments", "order_id", (
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
    )),
    "stg_reviews": Model("reviews", "review_id", (
        "review_id", "order_id", "review_score",
        _time("review_creation_date", "review_created_at"), _time("review_answer_timestamp", "review_answered_at"),
    )),
    "stg_customers": Model("customers", "customer_id", (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    )),
    "stg_products": Model("products", "product_id", (
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    )),
    "stg_sellers": Model("sellers", "seller_id", ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")),
    # No key filter here: a NULL ZIP stays, and the layer gate reports it.
    "stg_geolocation": Model("geolocation", None, (
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state",
    )),
    "stg_category_translation": Model("category_translation", "product_category_name", (
        "product_category_name", "product_category_name_english",
    )),
}
STAGING = {name: (model.of, model.table) for name, model in MODELS.items()}

stg_orders = MODELS["stg_orders"].of
stg_order_items = MODELS["stg_order_items"].of
stg_payments = MODELS["stg_payments"].of
stg_products = MODELS["stg_products"].of
stg_geolocation = MODELS["stg_geolocation"].of
stg_category_translation = MODELS["stg_category_translation"].of

# Payments summed up per order. Sums go over whole cents; the set of types is built map-side, so a group that holds much of
# the table still sends one short row per task. Types come in byte order, and NULL if there are none.
_ORDER_PAYMENTS = (
    "CAST(CAST(SUM(CAST(payment_value * 100 AS BIGINT)) AS DECIMAL(20, 0)) * 0.01BD AS DECIMAL(18, 2)) AS payment_total",
    "MAX(payment_installments) AS max_installments",
    "COUNT(1) AS payment_count",
    "IF(COUNT(payment_type) > 0, ARRAY_JOIN(ARRAY_SORT(COLLECT_SET(payment_type)), ','), NULL) AS payment_types",
)


def stg_orders_payments(staged_payments: DataFrame) -> DataFrame:
    return staged_payments.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(*map(F.expr, _ORDER_PAYMENTS))


def view_statements(raw_layer: str, staging_layer: str) -> dict[str, str]:
    """SELECT statement of every staging view, in an order in which they can be created."""
    found = {name: model.statement(raw_layer) for name, model in MODELS.items()}
    found["stg_orders_payments"] = (
        f"SELECT order_id, {', '.join(_ORDER_PAYMENTS)} FROM {staging_layer}.stg_payments WHERE order_id IS NOT NULL GROUP BY order_id"
    )
    return found


def stage(raw: DataFrame, model: str) -> DataFrame:
    return MODELS[model].of(raw)


def clean_customers(customers: DataFrame) -> DataFrame:
    """Cities in title case, state codes in upper case."""
    return customers.withColumns(
        {"customer_city": F.initcap("customer_city"), "customer_state": F.upper("customer_state")}
    )


def product_volume(products: DataFrame) -> DataFrame:
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return products.withColumn("volume_cm3", volume.cast("decimal(30,6)"))
