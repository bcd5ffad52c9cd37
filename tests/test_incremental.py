from __future__ import annotations

import os
import threading
from datetime import date

import pytest
from helpers import at, money, raw_rows, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ordermill.operators import incremental, staging
from ordermill.plans import marts, pipeline
from ordermill.sources import catalog, versions

KEYS = ["order_id", "order_item_id"]


def _orders(spark, *pairs):
    return staging.stg_orders(
        raw_rows(
            spark, "orders",
            *({"order_id": o, "customer_id": "c", "order_purchase_timestamp": t and at(t)} for o, t in pairs),
        )
    )


def _items(spark, *triples):
    return staging.stg_order_items(
        raw_rows(
            spark, "order_items",
            *(
                {"order_id": o, "order_item_id": n, "price": money(p), "freight_value": money("1")}
                for o, n, p in triples
            ),
        )
    )


def _refresh(spark, table, orders, items):
    pipeline.refresh_fact(spark, table, orders, lambda o: marts.fact_order_items(items, o), KEYS)


def _prices(spark, table):
    return [(o, n, str(p)) for o, n, p in rows(spark.table(table), "order_id", "order_item_id", "price")]


def test_newest_day_is_replaced_older_skipped_later_added(spark, layer):
    table = f"{layer}.fact_order_items"
    orders = _orders(spark, ("a", "2020-01-01T10:00"), ("b", "2020-02-02T10:00"))
    _refresh(spark, table, orders, _items(spark, ("a", 1, "1"), ("b", 1, "2")))
    again = _orders(
        spark, ("a", "2020-01-01T10:00"), ("late", "2020-01-15T00:00"),
        ("b", "2020-02-02T10:00"), ("c", "2020-03-01T00:00"),
    )
    items = _items(spark, ("a", 1, "9"), ("late", 1, "9"), ("b", 1, "9"), ("c", 1, "9"))
    _refresh(spark, table, again, items)
    assert _prices(spark, table) == [("a", 1, "1.00"), ("b", 1, "9.00"), ("c", 1, "9.00")]
    _refresh(spark, table, again, items)
    assert _prices(spark, table) == [("a", 1, "1.00"), ("b", 1, "9.00"), ("c", 1, "9.00")]


def test_duplicate_keys_in_one_batch_all_stay(spark, layer):
    table = f"{layer}.fact_order_items"
    orders = _orders(spark, ("a", "2020-01-01T10:00"))
    _refresh(spark, table, orders, _items(spark, ("a", 1, "1")))
    _refresh(spark, table, orders, _items(spark, ("a", 1, "2"), ("a", 1, "3")))
    assert _prices(spark, table) == [("a", 1, "2.00"), ("a", 1, "3.00")]


def test_order_without_a_day_enters_on_the_first_run_only(spark, layer):
    table = f"{layer}.fact_order_items"
    _refresh(spark, table, _orders(spark, ("n", None), ("a", "2020-01-01T10:00")), _items(spark, ("n", 1, "1"), ("a", 1, "1")))
    more = _orders(spark, ("n", None), ("n2", None), ("a", "2020-01-01T10:00"))
    _refresh(spark, table, more, _items(spark, ("n", 1, "5"), ("n2", 1, "5"), ("a", 1, "5")))
    assert _prices(spark, table) == [("a", 1, "5.00"), ("n", 1, "1.00")]


def test_a_key_that_moves_to_another_month_leaves_the_old_one(spark, layer):
    """The old month loses its only row and must not survive the swap."""
    table = f"{layer}.fact_order_items"
    first = _orders(spark, ("a", "2020-01-01T10:00"), ("n", None), ("b", "2020-02-01T00:00"))
    _refresh(spark, table, first, _items(spark, ("a", 1, "1"), ("n", 1, "1"), ("b", 1, "1")))
    moved = _orders(spark, ("a", "2020-03-05T10:00"), ("n", "2020-03-06T00:00"), ("b", "2020-02-01T00:00"))
    _refresh(spark, table, moved, _items(spark, ("a", 1, "7"), ("n", 1, "7"), ("b", 1, "7")))
    assert _prices(spark, table) == [("a", 1, "7.00"), ("b", 1, "7.00"), ("n", 1, "7.00")]


def test_months_that_the_batch_does_not_touch_keep_their_files(spark, layer):
    table = f"{layer}.fact_order_items"
    orders = _orders(spark, ("a", "2020-01-01T10:00"), ("b", "2020-02-02T10:00"))
    _refresh(spark, table, orders, _items(spark, ("a", 1, "1"), ("b", 1, "2")))
    before = {f for f in spark.table(table).inputFiles() if "2020-01" in f}
    _refresh(spark, table, orders, _items(spark, ("a", 1, "1"), ("b", 1, "3")))
    after = {f for f in spark.table(table).inputFiles() if "2020-01" in f}
    assert before and before == after


def test_watermark_of_an_empty_target(spark):
    empty = spark.createDataFrame([], "d DATE")
    assert incremental.watermark(empty, "d") == date(1900, 1, 1)


def test_bound_reaches_the_scan(spark, tmp_path):
    _orders(spark, ("a", "2020-01-01T10:00")).write.parquet(str(tmp_path / "o"))
    plan = incremental.not_before(spark.read.parquet(str(tmp_path / "o")), "purchased_at", date(2020, 1, 1))
    assert "GreaterThanOrEqual(purchased_at" in plan._jdf.queryExecution().executedPlan().toString()


def test_bound_does_not_depend_on_the_session_zone(spark):
    orders = _orders(spark, ("a", "2020-01-01T00:00"), ("b", "2019-12-31T23:59"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        found = rows(incremental.not_before(orders, "purchased_at", date(2020, 1, 1)), "order_id")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [("a",)]


def test_column_sync_follows_the_batch(spark, layer):
    table = f"{layer}.fact_order_items"
    orders = _orders(spark, ("a", "2020-01-01T10:00"), ("b", "2020-02-02T10:00"))
    items = _items(spark, ("a", 1, "1"), ("b", 1, "2"))
    _refresh(spark, table, orders, items)

    def changed(o):
        return marts.fact_order_items(items, o).drop("seller_id").selectExpr("*", "price * 2 AS doubled")

    pipeline.refresh_fact(spark, table, orders, changed, KEYS)
    stored = spark.table(table)
    assert "seller_id" not in stored.columns
    assert [(o, d and str(d)) for o, d in rows(stored, "order_id", "doubled")] == [("a", None), ("b", "4.00")]


def test_upsert_updates_named_columns_only(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k STRING, v INT, created STRING")
    batch = spark.createDataFrame([("a", 9, "new"), ("c", 3, "new"), (None, 4, "new")], "k STRING, v INT, created STRING")
    assert rows(incremental.upsert(target, batch, ["k"], ["v"])) == [
        ("a", 9, "old"), ("b", 2, "old"), ("c", 3, "new"), (None, 4, "new")
    ]


def test_upsert_can_set_null_and_rejects_repeated_keys(spark):
    target = spark.createDataFrame([("a", 1)], "k STRING, v INT")
    cleared = spark.createDataFrame([("a", None)], "k STRING, v INT")
    assert rows(incremental.upsert(target, cleared, ["k"], ["v"])) == [("a", None)]
    twice = spark.createDataFrame([("a", 2), ("a", 3)], "k STRING, v INT")
    with pytest.raises(PySparkException, match="twice"):
        incremental.upsert(target, twice, ["k"], ["v"]).collect()


def test_insert_if_absent_keeps_existing_rows(spark):
    target = spark.createDataFrame([("a", 1)], "k STRING, v INT")
    batch = spark.createDataFrame([("a", 9), ("b", 5), ("b", 4)], "k STRING, v INT")
    assert rows(incremental.insert_if_absent(target, batch, ["k"])) == [("a", 1), ("b", 4)]


class Crash(Exception):
    pass


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", ["following", "write_months", "take_over", "switch", "_let_go"])
def test_one_row_per_key_whatever_step_a_crash_follows(spark, layer, monkeypatch, step, after):
    """A run that breaks off changes all or nothing, and the next one, with a corrected order, leaves one row per key."""
    table = f"{layer}.fact_order_items"
    orders = _orders(spark, ("1", "2020-01-01T10:00"), ("2", "2020-02-05T10:00"))
    _refresh(spark, table, orders, _items(spark, ("1", 1, "1"), ("2", 1, "2")))
    for turn in range(2):  # write_months stores the rows at its first call and the index at its second
        with monkeypatch.context() as broken:
            real, calls = getattr(versions, step), []

            def fail(*args, **kwargs):
                calls.append(1)
                if len(calls) == 1 + (turn if step == "write_months" else 0):
                    if after:
                        real(*args, **kwargs)
                    raise Crash
                return real(*args, **kwargs)

            broken.setattr(versions, step, fail)
            with pytest.raises(Crash):
                _refresh(spark, table, orders, _items(spark, ("1", 1, "1"), ("2", 1, "9")))
        switched = step == "_let_go" or (step == "switch" and after)
        assert _prices(spark, table) == [("1", 1, "1.00"), ("2", 1, "9.00" if switched else "2.00")]
    moved = _orders(spark, ("1", "2020-01-01T10:00"), ("2", "2020-03-05T10:00"))
    _refresh(spark, table, moved, _items(spark, ("1", 1, "1"), ("2", 1, "2")))
    assert rows(spark.table(table), "order_id", "order_date_id", "part_month") == [
        ("1", date(2020, 1, 1), "2020-01"), ("2", date(2020, 3, 5), "2020-03")
    ]


def _index(spark, table):
    return spark.table(versions.keys_of(table, versions.current(spark, table)))


def test_the_index_has_every_key_and_month_once(spark, layer):
    table = f"{layer}.fact_order_items"
    for run in range(6):
        days = [("a", "2020-01-01T10:00"), ("b", "2020-02-02T10:00"), ("c", f"2020-0{2 + run % 3}-10T00:00"), ("n", None)]
        triples = [(o, n, str(run + 1)) for o, _ in days for n in (1, 2)]
        _refresh(spark, table, _orders(spark, *days), _items(spark, *triples))
        assert rows(_index(spark, table)) == rows(spark.table(table).select("order_id", "part_month").distinct())


def test_only_two_versions_stay(spark, layer):
    table = f"{layer}.fact_order_items"
    orders = _orders(spark, ("a", "2020-01-01T10:00"), ("b", "2020-02-02T10:00"))
    for price in ("1", "2", "3", "4"):
        _refresh(spark, table, orders, _items(spark, ("a", 1, "1"), ("b", 1, price)))
    names = {t.name for t in spark.catalog.listTables(layer)}
    assert names == {"fact_order_items", *(f"fact_order_items__{kind}v{n}" for kind in ("", "keys_") for n in (3, 4))}
    home = versions.home(spark, table).removeprefix("file:")
    stored = {(v, p) for v in os.listdir(home) for p in os.listdir(f"{home}/{v}/data") if "=" in p}
    assert stored == {("v1", "part_month=2020-01"), ("v3", "part_month=2020-02"), ("v4", "part_month=2020-02")}
    assert len(spark.table(table).inputFiles()) == 2
    assert rows(spark.table(versions.named(table, 3)), "price")[1] == (money("3"),)


def test_a_failed_replacement_leaves_the_old_rows(spark, layer):
    table = f"{layer}.numbers"
    catalog.publish_table(spark.range(5).toDF("n"), table)
    bad = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("other"))
    with pytest.raises(PySparkException):
        catalog.publish_table(bad, table)
    assert rows(spark.table(table), "n") == [(i,) for i in range(5)]
    catalog.publish_table(spark.table(table).selectExpr("n * 2 AS doubled"), table)
    assert rows(spark.table(table), "doubled") == [(2 * i,) for i in range(5)]


def test_a_reader_never_misses_the_table(spark, layer):
    table = f"{layer}.numbers"
    catalog.publish_table(spark.range(10).toDF("n"), table)
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(tuple(spark.table(table).selectExpr("count(*)", "min(n)", "max(n)").first()))
            except Exception as error:  # noqa: BLE001
                seen.append(repr(error)[:300])

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 6):
        catalog.publish_table(spark.range(10 * i, 10 * i + 10).toDF("n"), table)
    done.set()
    reader.join()
    assert len(seen) > 5 and set(seen) <= {(10, 10 * i, 10 * i + 9) for i in range(6)}


def test_a_table_made_by_other_means_is_taken_over(spark, layer):
    table = f"{layer}.numbers"
    spark.range(3).toDF("n").write.saveAsTable(table)
    catalog.publish_table(spark.table(table).selectExpr("n + 1 AS n"), table)
    assert rows(spark.table(table), "n") == [(1,), (2,), (3,)] and versions.current(spark, table) == 1


def test_keys_are_looked_up_without_a_shuffle_of_the_index(spark, layer):
    table = f"{layer}.fact_order_items"
    orders = _orders(spark, ("a", "2020-01-01T10:00"), ("b", "2020-02-02T10:00"))
    _refresh(spark, table, orders, _items(spark, ("a", 1, "1"), ("b", 1, "2")))
    keys = spark.createDataFrame([("b",), ("z",)], "order_id STRING")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = incremental.months_of(spark, table, keys, "order_id")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == [("2020-02",)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lookup = plan[plan.index("LeftSemi"):]
    scan = lookup.index("FileScan parquet")
    assert "Bucketed: true" in lookup and "Exchange" not in lookup[:scan]


def test_column_sync_follows_a_changed_type(spark, layer):
    table = f"{layer}.fact_order_items"
    orders = _orders(spark, ("a", "2020-01-01T10:00"), ("b", "2020-02-02T10:00"))
    items = _items(spark, ("a", 1, "1"), ("b", 1, "2"))
    _refresh(spark, table, orders, items)

    def wider(o):
        return marts.fact_order_items(items, o).withColumn("order_item_id", F.lit(5_000_000_000))

    pipeline.refresh_fact(spark, table, orders, wider, KEYS)
    stored = spark.table(table)
    assert dict(stored.dtypes)["order_item_id"] == "bigint"
    assert rows(stored, "order_id", "order_item_id") == [("a", 1), ("b", 1), ("b", 5_000_000_000)]


def test_watermark_reads_the_newest_month_only(spark, layer):
    table = f"{layer}.fact_order_items"
    orders = _orders(spark, ("a", "2020-01-31T10:00"), ("b", "2020-02-02T10:00"), ("n", None))
    _refresh(spark, table, orders, _items(spark, ("a", 1, "1"), ("b", 1, "2"), ("n", 1, "3")))
    assert incremental.stored_watermark(spark, table, "order_date_id") == date(2020, 2, 2)


def test_batches_of_keys_alone(spark):
    target = spark.createDataFrame([("a",)], "k STRING")
    batch = spark.createDataFrame([("a",), ("b",), (None,)], "k STRING")
    expected = [("a",), ("b",), (None,)]
    assert rows(incremental.upsert(target, batch, ["k"], [])) == expected
    assert rows(incremental.insert_if_absent(target, batch, ["k"])) == expected
