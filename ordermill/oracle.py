"""The queries once more as ANSI SQL, for an independent engine on the same files.

Named building blocks are common table expressions; each statement gets those it uses.
"""

from __future__ import annotations

import re

from .schemas import RAW

_BLOCKS = {
    "raw_orders": """
        SELECT o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                    WHEN 'P' THEN 'processing' ELSE o_orderstatus END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               o_orderdate + INTERVAL 1 HOUR AS order_approved_at,
               o_orderdate + INTERVAL 1 DAY AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F'
                    THEN o_orderdate + to_hours(24 * (o_custkey % 25 - 3) + o_orderkey % 24)
               END AS order_delivered_customer_date,
               o_orderdate + INTERVAL 10 DAY AS order_estimated_delivery_date
        FROM orders""",
    "raw_order_items": """
        SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS order_item_id,
               l_partkey::VARCHAR AS product_id, l_suppkey::VARCHAR AS seller_id,
               l_shipdate AS shipping_limit_date, l_extendedprice::DECIMAL(10,2) AS price,
               (l_extendedprice::DECIMAL(10,2) * l_tax::DECIMAL(10,2))::DECIMAL(10,2) AS freight_value
        FROM lineitem""",
    "raw_payments": """
        SELECT l_orderkey::VARCHAR AS order_id, l_linenumber AS payment_sequential,
               CASE l_returnflag WHEN 'A' THEN 'boleto' WHEN 'N' THEN 'credit_card'
                    WHEN 'R' THEN 'voucher' ELSE l_returnflag END AS payment_type,
               l_linenumber AS payment_installments,
               l_extendedprice::DECIMAL(10,2) AS payment_value
        FROM lineitem""",
    "raw_reviews": """
        SELECT event_id::VARCHAR AS review_id, event_id::VARCHAR AS order_id,
               (event_id % 5 + 1)::INTEGER AS review_score, event_type AS review_comment_title,
               props AS review_comment_message, ts AS review_creation_date,
               ts + INTERVAL 1 DAY AS review_answer_timestamp
        FROM events""",
    "raw_customers": """
        SELECT c_custkey::VARCHAR AS customer_id, c_name AS customer_unique_id,
               c_nationkey::VARCHAR AS customer_zip_code_prefix,
               c_mktsegment AS customer_city, n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_products": """
        SELECT p_partkey::VARCHAR AS product_id,
               p_name AS product_category_name,
               length(p_name)::INTEGER AS product_name_lenght,
               length(p_type)::INTEGER AS product_description_lenght,
               (p_size % 7)::INTEGER AS product_photos_qty,
               p_size::DECIMAL(10,2) AS product_weight_g, p_size::DECIMAL(10,2) AS product_length_cm,
               (p_size % 10 + 1)::DECIMAL(10,2) AS product_height_cm,
               (p_size % 5 + 1)::DECIMAL(10,2) AS product_width_cm
        FROM part""",
    "raw_category_translation": """
        SELECT DISTINCT p_name AS product_category_name,
               replace(upper(p_name), ' ', '_') AS product_category_name_english
        FROM part""""",
    "raw_sellers": """
        SELECT s_suppkey::VARCHAR AS seller_id, s_nationkey::VARCHAR AS seller_zip_code_prefix,
               s_name AS seller_city, n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_geolocation": """
        SELECT c_nationkey::VARCHAR AS geolocation_zip_code_prefix,
               c_acctbal::DECIMAL(10,2)::DECIMAL(12,8) AS geolocation_lat,
               (-(c_acctbal::DECIMAL(10,2)))::DECIMAL(12,8) AS geolocation_lng,
               c_mktsegment AS geolocation_city, r_name AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
    "order_events": """
        SELECT (event_id // 2)::VARCHAR AS order_id,
               'NATION_' || (user_id % 25)::VARCHAR AS customer_state,
               'product_' || (user_id % 8)::VARCHAR AS product,
               "value"::DECIMAL(10,2) AS price, (user_id % 80)::DECIMAL(10,2) AS freight_value,
               ("value"::DECIMAL(10,2) + (user_id % 80)::DECIMAL(10,2))::DECIMAL(10,2) AS total_amount,
               CASE user_id % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'voucher'
                    WHEN 2 THEN 'debit_card' ELSE 'boleto' END AS payment_type,
               event_type AS order_status, (event_id % 5 + 1)::INTEGER AS review_score,
               strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at
        FROM events""",
    "stg_orders": """
        SELECT order_id, customer_id, order_status, order_purchase_timestamp AS purchased_at,
               order_delivered_customer_date AS delivered_at
        FROM raw_orders WHERE order_id IS NOT NULL""",
    "stg_order_items": """
        SELECT order_id, order_item_id, product_id, seller_id,
               shipping_limit_date AS shipping_limit_at, price, freight_value
        FROM raw_order_items WHERE order_id IS NOT NULL""",
    "stg_payments": "SELECT * FROM raw_payments WHERE order_id IS NOT NULL",
    "stg_reviews": """
        SELECT review_id, order_id, review_score, review_creation_date AS review_created_at,
               review_answer_timestamp AS review_answered_at
        FROM raw_reviews WHERE review_id IS NOT NULL""",
    "stg_customers": "SELECT * FROM raw_customers WHERE customer_id IS NOT NULL",
    "stg_products": "SELECT * FROM raw_products WHERE product_id IS NOT NULL",
    "stg_sellers": "SELECT * FROM raw_sellers WHERE seller_id IS NOT NULL",
    "stg_geolocation": "SELECT * FROM raw_geolocation",
    "stg_category_translation": """
        SELECT * FROM raw_category_translation WHERE product_category_name IS NOT NULL""",
    "stg_orders_payments": """
        SELECT order_id, sum(payment_value)::DECIMAL(18,2) AS payment_total,
               max(payment_installments) AS max_installments, count(*) AS payment_count,
               string_agg(DISTINCT payment_type, ',' ORDER BY payment_type) AS payment_types
        FROM stg_payments GROUP BY order_id""",
    "dim_products": """
        SELECT p.product_id, p.product_category_name,
               coalesce(t.product_category_name_english, p.product_category_name, 'others')
                   AS product_category,
               product_name_lenght, product_description_lenght, product_photos_qty,
               product_weight_g, product_length_cm, product_height_cm, product_width_cm
        FROM stg_products p LEFT JOIN stg_category_translation t
             ON p.product_category_name = t.product_category_name""",
    "fact_order_items": """
        SELECT i.order_id, order_item_id, product_id, seller_id, customer_id,
               purchased_at::DATE AS order_date_id, price, freight_value
        FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id""",
    "fact_payments": """
        SELECT o.order_id, customer_id, purchased_at::DATE AS order_date_id, payment_total,
               payment_count, max_installments, payment_types
        FROM stg_orders o JOIN stg_orders_payments p ON o.order_id = p.order_id""",
    "day_list": """
        SELECT d::DATE AS date_id
        FROM generate_series(DATE '1995-01-01', DATE '2002-12-31', INTERVAL 1 DAY) AS g(d)""",
    "triples": """
        SELECT order_date_id, product_id, customer_id, count(DISTINCT order_id) AS total_orders,
               sum(price)::DECIMAL(18,2) AS gross_revenue,
               sum(freight_value)::DECIMAL(18,2) AS freight_cost,
               sum(price + freight_value)::DECIMAL(18,2) AS total_revenue
        FROM fact_order_items GROUP BY ALL""",
    "mart_revenue_daily": """
        SELECT date_id AS date_day, year(date_id)::INTEGER AS "year", month(date_id)::INTEGER AS "month",
               quarter(date_id)::INTEGER AS "quarter", day(date_id)::INTEGER AS "day",
               product_category, customer_state,
               sum(gross_revenue)::DECIMAL(18,2) AS gross_revenue,
               sum(freight_cost)::DECIMAL(18,2) AS freight_cost,
               sum(total_revenue)::DECIMAL(18,2) AS total_revenue,
               sum(total_orders)::BIGINT AS total_orders,
               count(DISTINCT c.customer_id) AS unique_customers,
               (((2 * (sum(gross_revenue) * 100)::HUGEINT + count(*)) // (2 * count(*)))
                   ::DECIMAL(18,0) * 0.01)::DECIMAL(18,2) AS avg_order_value
        FROM triples f JOIN day_list d ON f.order_date_id = d.date_id
             JOIN dim_products p ON f.product_id = p.product_id
             JOIN stg_customers c ON f.customer_id = c.customer_id
        GROUP BY ALL""",
    "gold": """
        SELECT f.order_id, c.customer_id, c.customer_state, p.product_id, p.product_category_name,
               f.price, f.freight_value, (f.price + f.freight_value) AS total_order_amount
        FROM fact_order_items f JOIN stg_customers c ON f.customer_id = c.customer_id
             JOIN dim_products p ON f.product_id = p.product_id""",
    "enriched": """
        SELECT v.order_id, v.customer_state, v.product_category_name, v.total_order_amount,
               s.order_status AS status_on_s3, s.review_score AS streaming_review_score,
               s.created_at AS streaming_arrival_time
        FROM gold v LEFT JOIN order_events s ON v.order_id = s.order_id
        WHERE s.order_id IS NOT NULL""",
    "latest_event": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY order_id
                ORDER BY created_at DESC, order_status DESC, customer_state DESC, product DESC,
                         price DESC, freight_value DESC, total_amount DESC, payment_type DESC,
                         review_score DESC) AS rn
            FROM order_events) WHERE rn = 1""",
    "deliveries": """
        SELECT order_id, customer_id, order_status,
               trunc(epoch(order_delivered_customer_date - order_purchase_timestamp) / 86400)
                   ::INTEGER AS delivery_days,
               order_delivered_customer_date > order_estimated_delivery_date AS is_late
        FROM raw_orders""",
    "monthly": """
        SELECT year(order_date_id)::INTEGER AS "year", month(order_date_id)::INTEGER AS "month",
               count(DISTINCT order_id) AS total_orders, sum(price)::DECIMAL(18,2) AS gross_revenue
        FROM fact_order_items JOIN day_list ON order_date_id = date_id GROUP BY ALL""",
    "early_orders": "SELECT * FROM stg_orders WHERE purchased_at <= TIMESTAMP '2000-01-01'",
    "customer_totals": """
        SELECT customer_unique_id, max(order_date_id) AS last_order_day,
               count(DISTINCT order_id) AS frequency, sum(price)::DECIMAL(18,2) AS monetary
        FROM fact_order_items f JOIN stg_customers c ON f.customer_id = c.customer_id
        GROUP BY customer_unique_id""",
    "chosen": """
        SELECT *, substr(sha256('clone' || order_id), 1, 16) AS new_id
        FROM raw_orders WHERE order_status = 'delivered'
        ORDER BY sha256('clone' || order_id), order_id LIMIT 100""",
    "all_counts": """
        SELECT 'orders' AS table_name, count(*) AS "rows" FROM raw_orders
        UNION ALL SELECT 'order_items', count(*) FROM raw_order_items
        UNION ALL SELECT 'payments', count(*) FROM raw_payments
        UNION ALL SELECT 'reviews', count(*) FROM raw_reviews
        UNION ALL SELECT 'customers', count(*) FROM raw_customers
        UNION ALL SELECT 'products', count(*) FROM raw_products
        UNION ALL SELECT 'sellers', count(*) FROM raw_sellers
        UNION ALL SELECT 'geolocation', count(*) FROM raw_geolocation
        UNION ALL SELECT 'category_translation', count(*) FROM raw_category_translation""",
}


def _line(table: str) -> str:
    """A raw row as text, absent values as a dash."""
    return "concat_ws('|', " + ", ".join(f"coalesce({c}::VARCHAR, '-')" for c in RAW[table].names) + ")"


def _statement(body: str, **own: str) -> str:
    """Body with every building block it needs, directly or through others, in order."""
    blocks = _BLOCKS | own
    needed: set[str] = set()
    waiting = [body]
    while waiting:
        text = waiting.pop()
        for name in blocks:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                waiting.append(blocks[name])

    ordered: list[str] = []

    def place(name: str) -> None:
        if name in ordered:
            return
        for other in needed - {name}:
            if re.search(rf"\b{other}\b", blocks[name]):
                place(other)
        ordered.append(name)

    for name in sorted(needed):
        place(name)
    ctes = ", ".join(f"{name} AS ({blocks[name]})" for name in ordered)
    return f"WITH {ctes} {body}" if ctes else body


def _failures(model: str, column: str, check: str, count_sql: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{check}' AS check_name, "
        f"({count_sql})::BIGINT AS failures"
    )


def _nulls(model: str, column: str, relation: str | None = None) -> str:
    relation = relation or model
    return _failures(model, column, "not_null", f"SELECT count(*) FROM {relation} WHERE {column} IS NULL")


def _repeats(model: str, column: str, relation: str | None = None) -> str:
    relation = relation or model
    return _failures(
        model, column, "unique",
        f"SELECT count(*) FROM (SELECT {column} FROM {relation} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)",
    )


def _orphans(model: str, column: str, parent: str) -> str:
    return _failures(
        model, column, f"relationships_{parent}",
        f"SELECT count(*) FROM {model} m WHERE m.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} p WHERE p.{column} = m.{column})",
    )


_STATUS_LIST = (
    "'delivered', 'shipped', 'canceled', 'invoiced', 'processing', 'unavailable', 'created', 'approved'"
)

_STAGING_REPORT = " UNION ALL ".join(
    [
        _nulls("stg_orders", "order_id"), _repeats("stg_orders", "order_id"),
        _nulls("stg_orders", "customer_id"),
        _failures(
            "stg_orders", "order_status", "accepted_values",
            f"SELECT count(*) FROM stg_orders WHERE order_status NOT IN ({_STATUS_LIST})",
        ),
        _nulls("stg_orders_payments", "order_id"), _repeats("stg_orders_payments", "order_id"),
        _nulls("stg_customers", "customer_id"), _repeats("stg_customers", "customer_id"),
        _nulls("stg_products", "product_id"), _repeats("stg_products", "product_id"),
        _nulls("stg_order_items", "order_id"), _nulls("stg_order_items", "price"),
        _nulls("stg_payments", "order_id"), _nulls("stg_payments", "payment_type"),
        _nulls("stg_reviews", "review_id"),
        _failures(
            "stg_reviews", "review_score", "accepted_values",
            "SELECT count(*) FROM stg_reviews WHERE review_score NOT IN (1, 2, 3, 4, 5)",
        ),
        _nulls("stg_sellers", "seller_id"), _repeats("stg_sellers", "seller_id"),
        _nulls("stg_geolocation", "geolocation_zip_code_prefix"),
        _nulls("stg_category_translation", "product_category_name"),
        _repeats("stg_category_translation", "product_category_name"),
        _nulls("stg_category_translation", "product_category_name_english"),
        _repeats("stg_category_translation", "product_category_name_english"),
    ]
)

_MARTS_REPORT = " UNION ALL ".join(
    [
        _nulls("fact_order_items", "order_id"),
        _orphans("fact_order_items", "order_id", "stg_orders"),
        _nulls("fact_order_items", "order_item_id"),
        _nulls("fact_order_items", "product_id"),
        _orphans("fact_order_items", "product_id", "stg_products"),
        _nulls("fact_order_items", "price"),
        _failures(
            "fact_order_items", "price", "accepted_range_above_0",
            "SELECT count(*) FROM fact_order_items WHERE NOT price > 0",
        ),
        _nulls("fact_order_items", "freight_value"),
        _failures(
            "fact_order_items", "freight_value", "accepted_range_from_0",
            "SELECT count(*) FROM fact_order_items WHERE NOT freight_value >= 0",
        ),
        _nulls("dim_customers", "customer_id", "stg_customers"),
        _repeats("dim_customers", "customer_id", "stg_customers"),
        _nulls("dim_customers", "customer_unique_id", "stg_customers"),
        _nulls("dim_customers", "customer_zip_code_prefix", "stg_customers"),
        _nulls("dim_products", "product_id"), _repeats("dim_products", "product_id"),
        _nulls("dim_products", "product_category"),
    ]
)

# Rows of the early load whose key the later batch lacks, and the batch.
_EARLY_ITEMS = """
    SELECT i.order_id, order_item_id, product_id, seller_id, customer_id,
           purchased_at::DATE AS order_date_id, price, 0::DECIMAL(10,2) AS freight_value
    FROM stg_order_items i JOIN early_orders o ON i.order_id = o.order_id"""
_LATE_ITEMS = """
    SELECT f.* FROM fact_order_items f
    WHERE order_date_id >= (SELECT max(order_date_id) FROM early_items)"""
_EARLY_PAYMENTS = """
    SELECT o.order_id, customer_id, purchased_at::DATE AS order_date_id, payment_total,
           payment_count, {installments} AS max_installments, payment_types
    FROM early_orders o JOIN stg_orders_payments p ON o.order_id = p.order_id"""
_LATE_PAYMENTS = """
    SELECT f.* FROM fact_payments f
    WHERE order_date_id >= (SELECT max(order_date_id) FROM early_payments)"""


def _score(column: str) -> str:
    rank = f"rank() OVER (ORDER BY {column})"
    # Position among all customers: equal values share the lowest one.
    return f"(1 + (5 * ({rank} - 1)) // count(*) OVER ())::INTEGER"


ORACLES: dict[str, str] = {
    **{
        name: _statement(f"SELECT * FROM {name}")
        for name in (
            "stg_orders", "stg_order_items", "stg_payments", "stg_reviews", "stg_customers",
            "stg_products", "stg_sellers", "stg_geolocation", "stg_category_translation",
            "stg_orders_payments", "dim_products", "fact_order_items", "fact_payments",
            "mart_revenue_daily",
        )
    },
    "dim_customers": _statement("SELECT * FROM stg_customers"),
    "dim_sellers": _statement("SELECT * FROM stg_sellers"),
    "dim_date": """
        SELECT d AS date_id, year(d)::INTEGER AS "year", month(d)::INTEGER AS "month",
               quarter(d)::INTEGER AS "quarter", day(d)::INTEGER AS "day",
               dayofweek(d)::INTEGER AS day_of_week,
               rpad(monthname(d), 9, ' ') AS month_name, rpad(dayname(d), 9, ' ') AS day_name,
               isodow(d) IN (6, 7) AS is_weekend
        FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE,
                                            INTERVAL 1 DAY))::DATE AS d FROM orders)""",
    "dim_geolocation": _statement("""
        SELECT geolocation_zip_code_prefix AS zip_code_prefix, min(geolocation_city) AS city,
               min(geolocation_state) AS state,
               sum(geolocation_lat)::DOUBLE / count(geolocation_lat) AS avg_lat,
               sum(geolocation_lng)::DOUBLE / count(geolocation_lng) AS avg_lng
        FROM stg_geolocation GROUP BY 1"""),
    "clean_customers": _statement("""
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
               upper(left(customer_city, 1)) || lower(substr(customer_city, 2)) AS customer_city,
               upper(customer_state) AS customer_state FROM stg_customers"""),
    "text_timestamps": _statement("""
        SELECT order_id, customer_id, order_status,
               CASE WHEN order_id::BIGINT % 7 <> 0 THEN purchased_at END AS purchased_at,
               CASE WHEN order_id::BIGINT % 7 <> 0 THEN delivered_at END AS delivered_at FROM stg_orders"""),
    "product_volume": _statement("""
        SELECT product_id, (product_length_cm::DECIMAL(12,2) * product_height_cm::DECIMAL(12,2)
               * product_width_cm::DECIMAL(12,2))::DECIMAL(30,6) AS volume_cm3 FROM stg_products"""),
    "revenue_by_day_product_customer": _statement("SELECT * FROM triples"),
    "fact_order_items_incremental": _statement(
        """SELECT e.* FROM early_items e WHERE NOT EXISTS (
               SELECT 1 FROM late_items b
               WHERE b.order_id = e.order_id AND b.order_item_id = e.order_item_id)
           UNION ALL SELECT * FROM late_items""",
        early_items=_EARLY_ITEMS, late_items=_LATE_ITEMS,
    ),
    "fact_payments_incremental": _statement(
        """SELECT e.* FROM early_payments e WHERE NOT EXISTS (
               SELECT 1 FROM late_payments b WHERE b.order_id = e.order_id)
           UNION ALL SELECT * FROM late_payments""",
        early_payments=_EARLY_PAYMENTS.format(installments="1"), late_payments=_LATE_PAYMENTS,
    ),
    "column_sync": _statement(
        """SELECT order_id, order_date_id, payment_total, payment_count, max_installments,
                  payment_types, NULL::BOOLEAN AS is_split
           FROM early_payments e WHERE NOT EXISTS (
               SELECT 1 FROM late_payments b WHERE b.order_id = e.order_id)
           UNION ALL
           SELECT order_id, order_date_id, payment_total, payment_count, max_installments,
                  payment_types, payment_count > 1 FROM late_payments""",
        early_payments=_EARLY_PAYMENTS.format(installments="max_installments"),
        late_payments=_LATE_PAYMENTS,
    ),
    "keyed_upsert": _statement("""
        SELECT coalesce(s.seller_id, c.customer_id) AS seller_id,
               CASE WHEN s.seller_id IS NULL THEN c.customer_zip_code_prefix
                    ELSE s.seller_zip_code_prefix END AS seller_zip_code_prefix,
               CASE WHEN c.customer_id IS NULL THEN s.seller_city
                    ELSE c.customer_city END AS seller_city,
               CASE WHEN s.seller_id IS NULL THEN c.customer_state
                    ELSE s.seller_state END AS seller_state
        FROM stg_sellers s FULL JOIN stg_customers c ON s.seller_id = c.customer_id"""),
    "insert_if_absent": _statement("""
        SELECT order_id, review_score AS n FROM stg_reviews
        UNION ALL
        SELECT order_id, min(order_item_id) FROM stg_order_items
        WHERE order_id NOT IN (SELECT order_id FROM stg_reviews) GROUP BY order_id"""),
    "full_refresh": _statement("SELECT * FROM stg_customers"),
    "append_only": _statement("""
        SELECT payment_type, 2 * count(*) AS payments,
               (2 * sum(payment_value))::DECIMAL(18,2) AS payment_value
        FROM stg_payments GROUP BY payment_type"""),
    "gold_view": _statement("SELECT * FROM gold"),
    "gold_stream_enrich": _statement(
        "SELECT * FROM enriched ORDER BY streaming_arrival_time DESC NULLS LAST"
    ),
    "gold_stream_latest": _statement("""
        SELECT v.order_id, v.customer_state, v.product_category_name, v.total_order_amount,
               s.order_status AS status_on_s3, s.review_score AS streaming_review_score,
               s.created_at AS streaming_arrival_time
        FROM gold v JOIN latest_event s ON v.order_id = s.order_id"""),
    "gold_latest_event": _statement("SELECT * FROM latest_event"),
    "gold_revenue_by_state": _statement("""
        SELECT v.customer_state, count(DISTINCT v.order_id) AS total_orders,
               sum(v.total_order_amount)::DECIMAL(18,2) AS total_revenue,
               sum(v.total_order_amount)::DOUBLE / count(v.total_order_amount) AS avg_order_value,
               sum(s.review_score)::DOUBLE / count(s.review_score) AS avg_review_score
        FROM gold v JOIN order_events s ON v.order_id = s.order_id
        GROUP BY v.customer_state ORDER BY total_revenue DESC"""),
    "unified_orders": _statement("""
        SELECT 'Streaming' AS source, order_id,
               strptime(created_at, '%Y-%m-%dT%H:%M:%SZ')::TIMESTAMP AS created_at,
               (price + freight_value) AS total_amount FROM order_events
        UNION ALL
        SELECT 'Batch', order_id, order_date_id::TIMESTAMP, (price + freight_value)
        FROM fact_order_items"""),
    "federated_read": _statement("SELECT * FROM enriched"),
    "monthly_revenue": _statement('SELECT * FROM monthly ORDER BY "year", "month"'),
    "top_categories": _statement("""
        SELECT product_category, sum(price)::DECIMAL(18,2) AS revenue
        FROM fact_order_items f JOIN dim_products p ON f.product_id = p.product_id
        GROUP BY 1 ORDER BY revenue DESC, product_category LIMIT 10"""),
    "delivery_times": _statement("SELECT * FROM deliveries"),
    "avg_delivery_days": _statement("""
        SELECT sum(delivery_days)::DOUBLE / count(delivery_days) AS avg_delivery_days,
               count(*) AS delivered_orders
        FROM deliveries WHERE order_status = 'delivered'"""),
    "late_rate": _statement("""
        SELECT count(*) FILTER (WHERE is_late) AS late_orders, count(*) AS total_orders,
               (count(*) FILTER (WHERE is_late))::DOUBLE / count(*) AS late_rate FROM deliveries"""),
    "delivery_histogram": _statement("""
        SELECT delivery_days, count(*) AS orders FROM deliveries
        WHERE delivery_days IS NOT NULL GROUP BY 1"""),
    "table_counts": _statement('SELECT * FROM all_counts ORDER BY "rows" DESC, table_name'),
    "customers_by_state": _statement("""
        SELECT customer_state, count(DISTINCT c.customer_id) AS customers,
               count(DISTINCT o.order_id) AS orders
        FROM stg_customers c LEFT JOIN stg_orders o ON c.customer_id = o.customer_id GROUP BY 1"""),
    "customer_order_counts": _statement("""
        SELECT customer_id, count(DISTINCT order_id) AS total_orders FROM stg_orders GROUP BY 1"""),
    "revenue_by_state": _statement("""
        SELECT customer_state, sum(price)::DECIMAL(18,2) AS revenue
        FROM fact_order_items f JOIN stg_customers c ON f.customer_id = c.customer_id GROUP BY 1"""),
    "seller_revenue_rating": _statement(
        """SELECT r.seller_id, revenue, avg_review_score,
                  coalesce(review_count, 0)::BIGINT AS review_count
           FROM (SELECT seller_id, sum(price)::DECIMAL(18,2) AS revenue
                 FROM fact_order_items GROUP BY 1) r
           LEFT JOIN (
                 SELECT seller_id, sum(review_score)::DOUBLE / count(review_score) AS avg_review_score,
                        count(review_score) AS review_count
                 FROM (SELECT DISTINCT seller_id, order_id FROM fact_order_items) s
                 JOIN stg_reviews v ON s.order_id = v.order_id GROUP BY 1) g
           ON r.seller_id = g.seller_id"""
    ),
    "payment_preference": _statement("""
        SELECT payment_type, count(*) AS payments, sum(payment_value)::DECIMAL(18,2) AS payment_value
        FROM stg_payments GROUP BY 1"""),
    "freight_by_category": _statement("""
        SELECT product_category, sum(freight_value)::DECIMAL(18,2) AS total_freight,
               sum(freight_value)::DOUBLE / count(freight_value) AS avg_freight
        FROM fact_order_items f JOIN dim_products p ON f.product_id = p.product_id GROUP BY 1"""),
    "rfm_segments": _statement(f"""
        SELECT *, r_score::VARCHAR || f_score::VARCHAR || m_score::VARCHAR AS segment FROM (
            SELECT customer_unique_id,
                   date_diff('day', last_order_day, max(last_order_day) OVER ())::INTEGER AS recency_days,
                   frequency, monetary, {_score("last_order_day")} AS r_score,
                   {_score("frequency")} AS f_score, {_score("monetary")} AS m_score
            FROM customer_totals)"""),
    "currency_convert": _statement("""
        SELECT "year", "month", total_orders, gross_revenue,
               gross_revenue::DOUBLE * (1.0::DOUBLE / 5.4::DOUBLE) AS gross_revenue_usd FROM monthly"""),
    "dq_not_null": _statement("SELECT order_id, order_status FROM stg_orders WHERE delivered_at IS NULL"),
    "dq_unique": _statement("""
        SELECT order_id, count(*) AS copies FROM stg_order_items
        WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1"""),
    "dq_accepted_values": _statement(f"""
        SELECT order_id, order_status, created_at FROM order_events
        WHERE order_status NOT IN ({_STATUS_LIST}, 'view', 'click')"""),
    "dq_relationships": _statement("""
        SELECT order_id, count(*) AS "rows" FROM stg_order_items i
        WHERE NOT EXISTS (SELECT 1 FROM order_events e WHERE e.order_id = i.order_id)
        GROUP BY order_id"""),
    "dq_accepted_range_strict": _statement("""
        SELECT order_id, order_item_id, product_id, freight_value
        FROM stg_order_items WHERE NOT freight_value > 0"""),
    "dq_accepted_range_inclusive": _statement("""
        SELECT geolocation_zip_code_prefix, geolocation_lat
        FROM stg_geolocation WHERE NOT geolocation_lat >= 0"""),
    "dq_staging_report": _statement(_STAGING_REPORT),
    "dq_marts_report": _statement(_MARTS_REPORT),
    "required_tables": _statement("""
        SELECT table_name, true AS present, "rows" FROM all_counts
        UNION ALL SELECT 'streaming_orders', false, NULL"""),
    "csv_load": _statement(
        " UNION ALL ".join(f"SELECT '{name}' AS table_name, {_line(name)} AS line FROM raw_{name}" for name in RAW)
    ),
    "csv_text_fidelity": """
        SELECT doc_id::VARCHAR AS review_id, source AS order_id, lang AS review_comment_title,
               "text" AS review_comment_message FROM documents""",
    "csv_load_report": _statement("""
        SELECT 'orders' AS table_name, count(*) AS "rows", 'loaded' AS outcome FROM raw_orders
        UNION ALL SELECT 'payments', NULL, 'skipped'
        UNION ALL SELECT 'products', count(*), 'loaded' FROM raw_products"""),
    "csv_append": _statement("SELECT * FROM raw_sellers UNION ALL SELECT * FROM raw_sellers"),
    "partitioned_sink": _statement("""
        SELECT year(review_created_at)::INTEGER AS "year", month(review_created_at)::INTEGER AS "month",
               day(review_created_at)::INTEGER AS "day", count(*) AS reviews,
               sum(review_score)::BIGINT AS score_total FROM stg_reviews GROUP BY 1, 2, 3"""),
    "stream_ingest": _statement("""
        SELECT *, strptime(created_at, '%Y-%m-%dT%H:%M:%SZ')::TIMESTAMP AS event_timestamp
        FROM order_events"""),
    "stream_quarantine": _statement("""
        SELECT order_id, CASE WHEN order_status IN ('error', 'click') AND payment_type IN ('boleto', 'voucher')
                              THEN 'quarantined' ELSE 'good' END AS state
        FROM order_events"""),
    "stream_enrich": _statement("SELECT * FROM enriched"),
    "column_statistics": _statement(" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {f'min({c})::VARCHAR' if shown else 'NULL::VARCHAR'} AS min,
                   {f'max({c})::VARCHAR' if shown else 'NULL::VARCHAR'} AS max,
                   count(*) FILTER ({c} IS NULL) AS nulls, count(DISTINCT {c}) AS n_distinct, TRUE AS near FROM fact_order_items"""
        for c, shown in (("order_id", False), ("order_item_id", True), ("order_date_id", True), ("price", True))
    )),
    "stream_bad_files": _statement("""
        SELECT run, 'events' AS what, payment_type AS name, count(*) AS n
        FROM order_events, (VALUES (1), (2)) runs(run)
        WHERE order_id::BIGINT % 16 <> 5 AND (run = 2 OR order_id::BIGINT % 16 <> 3) GROUP BY ALL
        UNION ALL
        SELECT * FROM (VALUES (1, 'failed file', 'slot=3', 1), (1, 'failed file', 'slot=5', 1), (2, 'failed file', 'slot=5', 2))"""),
    "clone_orders": _statement("""
        SELECT new_id AS order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
        FROM chosen"""),
    "clone_order_items": _statement("""
        SELECT new_id AS order_id, order_item_id, product_id, seller_id, shipping_limit_date,
               price, freight_value
        FROM raw_order_items i JOIN chosen c ON i.order_id = c.order_id"""),
    "clone_payments": _statement("""
        SELECT new_id AS order_id, payment_sequential, payment_type, payment_installments, payment_value
        FROM raw_payments p JOIN chosen c ON p.order_id = c.order_id"""),
    "sampled_items": _statement("""
        SELECT * FROM raw_order_items WHERE order_id IN (SELECT order_id FROM chosen)"""),
    "sample_rows": _statement("SELECT order_id, order_status FROM chosen"),
}

_STORED = {
    name: ORACLES[name]
    for name in (
        "dim_date", "dim_customers", "dim_sellers", "dim_products", "dim_geolocation", "fact_order_items",
        "fact_payments", "mart_revenue_daily",
    )
} | {"streaming_orders": ORACLES["stream_ingest"]}
# The build has a fixed calendar; averages are left out of checksums, as engines write them differently.
_STORED["dim_date"] = _STORED["dim_date"].replace("min(o_orderdate)::DATE", "DATE '1995-01-01'").replace(
    "max(o_orderdate)::DATE", "DATE '2002-12-31'").replace("AS d FROM orders)", "AS d)")
_STORED["dim_geolocation"] = f"SELECT zip_code_prefix, city, state FROM ({_STORED['dim_geolocation']})"


def _summed(statements: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS "rows",
                   sum(('0x' || substr(md5(concat_ws('|', *COLUMNS(*))), 1, 8))::BIGINT)::BIGINT AS checksum
            FROM ({statement})"""
        for name, statement in statements.items()
    )


ORACLES["pipeline_build"] = _summed(_STORED)
_VIEWS = {name: statement for name, statement in ORACLES.items() if name.startswith("stg_")}
ORACLES["staging_views"] = _summed(_VIEWS)
