"""Star-schema Parquet tables mapped to the raw order tables.

The given tables follow a generic sales star. Each function below gives one raw table
in the declared schema; only the columns a query asks for are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, so that opening a table does not read its files.
STAR = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": """c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,
                   c_mktsegment STRING""",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
               p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
                 o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
                   l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
                   l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
                 value DOUBLE, props STRING""",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(STAR[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "documents")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey AS STRING) AS order_id",
        "cast(o_custkey AS STRING) AS customer_id",
        """CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
           WHEN 'P' THEN 'processing' ELSE o_orderstatus END AS order_status""",
        "o_orderdate AS order_purchase_timestamp",
        "o_orderdate + interval 1 hour AS order_approved_at",
        "o_orderdate + interval 1 day AS order_delivered_carrier_date",
        """CASE WHEN o_orderstatus = 'F' THEN o_orderdate + make_dt_interval(
               cast(o_custkey % 25 - 3 AS INT), cast(o_orderkey % 24 AS INT))
           END AS order_delivered_customer_date""",
        "o_orderdate + interval 10 days AS order_estimated_delivery_date",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey AS STRING) AS order_id",
        "l_linenumber AS order_item_id",
        "cast(l_partkey AS STRING) AS product_id",
        "cast(l_suppkey AS STRING) AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "cast(l_extendedprice AS DECIMAL(10,2)) AS price",
        """cast(cast(l_extendedprice AS DECIMAL(10,2)) * cast(l_tax AS DECIMAL(10,2))
           AS DECIMAL(10,2)) AS freight_value""",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey AS STRING) AS order_id",
        "l_linenumber AS payment_sequential",
        """CASE l_returnflag WHEN 'A' THEN 'boleto' WHEN 'N' THEN 'credit_card'
           WHEN 'R' THEN 'voucher' ELSE l_returnflag END AS payment_type""",
        "l_linenumber AS payment_installments",
        "cast(l_extendedprice AS DECIMAL(10,2)) AS payment_value",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "events").selectExpr(
        "cast(event_id AS STRING) AS review_id",
        "cast(event_id AS STRING) AS order_id",
        "cast(event_id % 5 + 1 AS INT) AS review_score",
        "event_type AS review_comment_title",
        "props AS review_comment_message",
        "ts AS review_creation_date",
        "ts + interval 1 day AS review_answer_timestamp",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _load(spark, sf_dir, "nation")
    return (
        _load(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "cast(c_custkey AS STRING) AS customer_id",
            "c_name AS customer_unique_id",
            "cast(c_nationkey AS STRING) AS customer_zip_code_prefix",
            "c_mktsegment AS customer_city",
            "n_name AS customer_state",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey AS STRING) AS product_id",
        "p_name AS product_category_name",
        "length(p_name) AS product_name_lenght",
        "length(p_type) AS product_description_lenght",
        "p_size % 7 AS product_photos_qty",
        "cast(p_size AS DECIMAL(10,2)) AS product_weight_g",
        "cast(p_size AS DECIMAL(10,2)) AS product_length_cm",
        "cast(p_size % 10 + 1 AS DECIMAL(10,2)) AS product_height_cm",
        "cast(p_size % 5 + 1 AS DECIMAL(10,2)) AS product_width_cm",
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part name."""
    return (
        _load(spark, sf_dir, "part")
        .selectExpr("p_name AS product_category_name")
        .distinct()
        .selectExpr(
            "product_category_name",
            "replace(upper(product_category_name), ' ', '_') AS product_category_name_english",
        )
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _load(spark, sf_dir, "nation")
    return (
        _load(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "cast(s_suppkey AS STRING) AS seller_id",
            "cast(s_nationkey AS STRING) AS seller_zip_code_prefix",
            "s_name AS seller_city",
            "n_name AS seller_state",
        )
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _load(spark, sf_dir, "nation")
    region = _load(spark, sf_dir, "region")
    return (
        _load(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "cast(c_nationkey AS STRING) AS geolocation_zip_code_prefix",
            "cast(cast(c_acctbal AS DECIMAL(10,2)) AS DECIMAL(12,8)) AS geolocation_lat",
            "cast(-cast(c_acctbal AS DECIMAL(10,2)) AS DECIMAL(12,8)) AS geolocation_lng",
            "c_mktsegment AS geolocation_city",
            "r_name AS geolocation_state",
        )
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten event fields; two events per order, so joins on the order fan out."""
    return _load(spark, sf_dir, "events").selectExpr(
        "cast(event_id div 2 AS STRING) AS order_id",
        "concat('NATION_', user_id % 25) AS customer_state",
        "concat('product_', user_id % 8) AS product",
        "cast(value AS DECIMAL(10,2)) AS price",
        "cast(user_id % 80 AS DECIMAL(10,2)) AS freight_value",
        """cast(cast(value AS DECIMAL(10,2)) + cast(user_id % 80 AS DECIMAL(10,2))
           AS DECIMAL(10,2)) AS total_amount""",
        """CASE user_id % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'voucher'
           WHEN 2 THEN 'debit_card' ELSE 'boleto' END AS payment_type""",
        "event_type AS order_status",
        "cast(event_id % 5 + 1 AS INT) AS review_score",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS created_at",
    )


RAW_TABLES = {
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "reviews": reviews,
    "customers": customers,
    "products": products,
    "sellers": sellers,
    "geolocation": geolocation,
    "category_translation": category_translation,
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return RAW_TABLES[name](spark, sf_dir)
