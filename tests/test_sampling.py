from __future__ import annotations

import hashlib
import json

import pytest
from helpers import raw_rows, rows

from ordermill.operators import sampling


def _smallest(keys, n):
    return sorted(keys, key=lambda k: hashlib.sha256(f"s{k}".encode()).hexdigest())[:n]


def test_sample_takes_the_smallest_digests_at_every_size(spark):
    keys = [str(i) for i in range(3000)]
    df = spark.createDataFrame([(k,) for k in keys], "k STRING")
    for n in (0, 1, 777, 2999, 3000, 9000):
        assert rows(sampling.sample_rows(df, "k", n, "s")) == sorted(((k,) for k in _smallest(keys, n)), key=repr)


def test_null_keys_are_sampled_last_and_never_lost(spark):
    df = spark.createDataFrame([(str(i) if i >= 500 else None, i) for i in range(3000)], "k STRING, i INT")
    for n, without_key in ((100, 0), (2500, 0), (2700, 200), (3000, 500), (4000, 500)):
        found = sampling.sample_rows(df, "k", n, "s").collect()
        assert len(found) == min(n, 3000) and sum(r.k is None for r in found) == without_key


def _place(key, i):
    row = hashlib.sha256(json.dumps({"k": key, "i": i}, separators=(",", ":")).encode()).hexdigest()
    return (hashlib.sha256(f"s{key}".encode()).hexdigest() if key is not None else "g") + row


@pytest.mark.parametrize("small", [1, 50, 10_000])
def test_repeated_and_missing_keys_do_not_depend_on_the_layout(spark, monkeypatch, small):
    """One key has a third of the rows, and there are more NULLs than the sample needs."""
    monkeypatch.setattr(sampling, "SORTED_AT_ONCE", small)
    pairs = [("hot", i) for i in range(400)] + [(str(i % 90), i) for i in range(400)] + [(None, i) for i in range(400)]
    expected = sorted(pairs, key=lambda p: _place(*p))
    schema = "k STRING, i INT"
    one = spark.createDataFrame(pairs, schema).coalesce(1)
    other = spark.createDataFrame(pairs[::-1], schema).repartition(7)
    for n in (0, 1, 210, 399, 500, 799, 800, 801, 1000, 1199, 1200):
        for df in (one, other):
            assert rows(sampling.sample_rows(df, "k", n, "s")) == sorted(expected[:n], key=repr)


def test_equal_rows_are_interchangeable(spark, monkeypatch):
    monkeypatch.setattr(sampling, "SORTED_AT_ONCE", 10)
    df = spark.createDataFrame([("a", 1)] * 300 + [(None, 2)] * 300, "k STRING, i INT")
    for n in (0, 7, 300, 450, 600, 700):
        found = sampling.sample_rows(df, "k", n, "s").groupBy("i").count().orderBy("i").collect()
        assert [tuple(r) for r in found] == [x for x in ((1, min(n, 300)), (2, min(max(n - 300, 0), 300))) if x[1]]


def test_related_rows_of_chosen_keys(spark):
    chosen = raw_rows(spark, "orders", {"order_id": "1"}, {"order_id": "1"}, {"order_id": "2"}, {"order_id": None})
    items = raw_rows(spark, "order_items", *({"order_id": o, "order_item_id": i} for i, o in enumerate(("1", "1", "2", "3", None))))
    assert rows(sampling.rows_of(items, chosen, "order_id"), "order_item_id") == [(0,), (1,), (2,)]
    names = sampling.key_map(chosen, "order_id", "s")
    assert names.count() == 2
    renamed = sampling.under_surrogates(items, names, "order_id")
    assert renamed.columns == items.columns and rows(renamed, "order_item_id") == [(0,), (1,), (2,)]
    digest = hashlib.sha256(b"s2").hexdigest()[:16]
    assert rows(renamed.where("order_item_id = 2"), "order_id") == [(digest,)]
