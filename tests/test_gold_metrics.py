from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from helpers import money, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.functions.ranking import band, band_edges
from ordermill.plans import gold, metrics

GOLD = (
    "order_id STRING, customer_id STRING, customer_state STRING, product_id STRING, "
    "product_category_name STRING, price DECIMAL(10,2), freight_value DECIMAL(10,2), "
    "total_order_amount DECIMAL(11,2)"
)
EVENTS = "order_id STRING, order_status STRING, review_score INT, created_at STRING"


def _gold(spark, *items):
    return spark.createDataFrame(
        [(o, "c", s, "p", "k", money(a), money("0"), Decimal(a)) for o, s, a in items], GOLD
    )


def test_enrichment_fans_out_per_event(spark):
    g = _gold(spark, ("o1", "SP", "10.00"), ("o2", "SP", "1.00"))
    events = spark.createDataFrame(
        [("o1", "created", 4, "2024-01-01T00:00:00Z"), ("o1", "shipped", None, "2024-01-02T00:00:00Z"), (None, "x", 1, None)],
        EVENTS,
    )
    assert rows(gold.enrich_with_events(g, events), "order_id", "status_on_s3") == [("o1", "created"), ("o1", "shipped")]
    latest = gold.latest_event_per_order(events)
    assert rows(latest, "order_id", "order_status") == [("o1", "shipped")]


def test_newest_first_puts_missing_times_last(spark):
    g = _gold(spark, ("o1", "SP", "10.00"))
    events = spark.createDataFrame(
        [("o1", "a", 1, None), ("o1", "b", 1, "2024-01-01T00:00:00Z"), ("o1", "c", 1, "2024-01-03T00:00:00Z")], EVENTS
    )
    ordered = gold.newest_first(gold.enrich_with_events(g, events)).collect()
    assert [r.status_on_s3 for r in ordered] == ["c", "b", "a"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    items=st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xy"), st.integers(0, 999)), max_size=8),
    events=st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(1, 5))), max_size=8),
)
def test_revenue_by_state_equals_the_join_of_all_pairs(spark, items, events):
    g = _gold(spark, *((o, s, f"{c / 100:.2f}") for o, s, c in items))
    e = spark.createDataFrame([(o, "s", r, "2024-01-01T00:00:00Z") for o, r in events], EVENTS)
    found = {
        r.customer_state: (r.total_orders, r.total_revenue, r.avg_order_value, r.avg_review_score)
        for r in gold.revenue_by_state_confirmed(g, e).collect()
    }
    expected = {}
    for state in {s for _, s, _ in items}:
        pairs = [(o, c, r) for o, s, c in items if s == state for q, r in events if q == o]
        scores = [r for _, _, r in pairs if r is not None]
        if pairs:
            cents = sum(c for _, c, _ in pairs)
            expected[state] = (
                len({o for o, _, _ in pairs}),
                (Decimal(cents) / 100).quantize(Decimal("0.01")),
                pytest.approx(cents / 100 / len(pairs)),
                sum(scores) / len(scores) if scores else None,
            )
    assert found == expected


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-20, 20)), max_size=40), per_part=st.sampled_from([1, 3, 100]))
def test_bands_equal_a_global_ranking(spark, values, per_part):
    df = spark.createDataFrame([(v,) for v in values], "v INT")
    edges = band_edges(df, {"v": F.col("v")}, 5, per_part)["v"]
    found = sorted((tuple(r) for r in df.select("v", band(F.col("v"), edges)).distinct().collect()), key=repr)
    known = [v for v in values if v is not None]
    expected = {(v, None if v is None else 1 + 5 * sum(w < v for w in known) // len(known)) for v in values}
    assert found == sorted(expected, key=repr)


def test_rating_does_not_multiply_revenue(spark):
    fact = spark.createDataFrame(
        [("s1", "o1", money("10")), ("s1", "o1", money("5")), ("s2", "o2", money("1"))],
        "seller_id STRING, order_id STRING, price DECIMAL(10,2)",
    )
    reviews = spark.createDataFrame([("o1", 5), ("o1", 2)], "order_id STRING, review_score INT")
    assert rows(metrics.seller_revenue_rating(fact, reviews)) == [
        ("s1", Decimal("15.00"), 3.5, 2), ("s2", Decimal("1.00"), None, 0)
    ]


def test_rating_of_missing_keys_and_repeated_rows(spark):
    fact = spark.createDataFrame(
        [("s1", "o1", money("10")), ("s1", "o1", money("10")), ("s1", None, money("2")), (None, "o1", None), ("s2", "o3", None)],
        "seller_id STRING, order_id STRING, price DECIMAL(10,2)",
    )
    reviews = spark.createDataFrame([("o1", 4), ("o1", 4), ("o1", None), (None, 1), ("o3", None)], "order_id STRING, review_score INT")
    assert rows(metrics.seller_revenue_rating(fact, reviews)) == [
        ("s1", Decimal("22.00"), 4.0, 2), ("s2", None, None, 0), (None, None, 4.0, 2)
    ]


def test_items_enriched_first_are_the_gold_rows_enriched(spark):
    fact = spark.createDataFrame(
        [("o1", "c1", "p1", "1"), ("o1", "c1", "p1", "1"), ("o1", None, "p1", "2"), ("o2", "c1", "p9", "3"), ("o3", "c2", "p1", "4"), (None, "c1", "p1", "5")],
        "order_id STRING, customer_id STRING, product_id STRING, price STRING",
    ).select("order_id", "customer_id", "product_id", F.col("price").cast("decimal(10,2)"), F.lit(1).cast("decimal(10,2)").alias("freight_value"))
    customers = spark.createDataFrame([("c1", "SP"), ("c1", "RJ"), ("c2", None)], "customer_id STRING, customer_state STRING")
    products = spark.createDataFrame([("p1", None), (None, "x")], "product_id STRING, product_category_name STRING")
    events = spark.createDataFrame(
        [("o1", "created", 4, "2024-01-01T00:00:00Z"), ("o1", "shipped", None, "2024-01-02T00:00:00Z"), ("o3", "x", 1, None), (None, "x", 1, None)], EVENTS
    )
    latest = gold.latest_event_per_order(events)
    expected = gold.enrich_with_events(gold.order_analytics_gold(fact, customers, products), latest)
    found = gold.enriched_items(fact, customers, products, latest)
    assert found.dtypes == expected.dtypes
    assert rows(found) == rows(expected) and len(rows(found)) == 5


def test_late_rate_and_delivery_days(spark):
    timed = spark.createDataFrame(
        [("delivered", 2, True), ("delivered", 3, False), ("shipped", None, None), ("canceled", 9, False)],
        "order_status STRING, delivery_days INT, is_late BOOLEAN",
    )
    assert rows(metrics.late_rate(timed)) == [(1, 4, 0.25)]
    assert rows(metrics.avg_delivery_days(timed)) == [(2.5, 2)]
    assert rows(metrics.delivery_histogram(timed)) == [(2, 1), (3, 1), (9, 1)]


def test_customers_without_orders_are_counted(spark):
    people = spark.createDataFrame([("c1", "SP"), ("c2", "SP")], "customer_id STRING, customer_state STRING")
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "c1")], "order_id STRING, customer_id STRING")
    assert rows(metrics.customers_by_state(people, orders)) == [("SP", 2, 2)]


def test_unified_orders_have_both_sources(spark):
    events = spark.createDataFrame(
        [("o1", "2024-01-01T10:00:00Z", money("1"), money("2"))],
        "order_id STRING, created_at STRING, price DECIMAL(10,2), freight_value DECIMAL(10,2)",
    )
    fact = spark.createDataFrame(
        [("o2", date(2024, 1, 2), money("3"), money("4"))],
        "order_id STRING, order_date_id DATE, price DECIMAL(10,2), freight_value DECIMAL(10,2)",
    )
    found = [(s, o, str(t), str(a)) for s, o, t, a in rows(gold.unified_orders(events, fact))]
    assert found == [
        ("Batch", "o2", "2024-01-02 00:00:00", "7.00"), ("Streaming", "o1", "2024-01-01 10:00:00", "3.00")
    ]


def test_latest_event_is_by_real_time(spark):
    events = spark.createDataFrame(
        [
            ("f", "early", "2024-01-01T10:00:00Z"), ("f", "late", "2024-01-01T10:00:00.500Z"),
            ("o", "early", "2024-01-01T10:00:00+02:00"), ("o", "late", "2024-01-01T09:00:00Z"),
            ("n", "known", "2024-01-01T10:00:00Z"), ("n", "zz", "someday"), ("n", "zzz", None),
        ],
        "order_id STRING, order_status STRING, created_at STRING",
    )
    latest = gold.latest_event_per_order(events)
    assert latest.columns == events.columns
    assert rows(latest, "order_id", "order_status") == [("f", "late"), ("n", "known"), ("o", "late")]
