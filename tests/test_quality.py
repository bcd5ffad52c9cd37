from __future__ import annotations

import pytest
from helpers import money

from ordermill.operators import quality
from ordermill.plans.checks import MARTS_CHECKS, STAGING_CHECKS


@pytest.fixture()
def items(spark):
    return spark.createDataFrame(
        [("a", "x", money("0"), money("0")), ("a", None, money("1"), money("-1")), (None, "z", None, None)],
        "k STRING, s STRING, price DECIMAL(10,2), freight DECIMAL(10,2)",
    )


def test_number_of_declared_checks():
    assert (len(STAGING_CHECKS), len(MARTS_CHECKS)) == (23, 16)


def test_not_null(items):
    assert quality.not_null(items, "k").count() == 1


def test_unique_ignores_nulls(spark, items):
    assert [tuple(r) for r in quality.unique(items, "k").collect()] == [("a", 2)]
    assert quality.unique(spark.createDataFrame([(None,), (None,)], "k STRING"), "k").count() == 0


def test_accepted_values_pass_null(items):
    assert [r.s for r in quality.accepted_values(items, "s", ("x",)).collect()] == ["z"]


def test_relationships_pass_null_and_count_rows(spark, items):
    parents = spark.createDataFrame([("b",)], "id STRING")
    assert [tuple(r) for r in quality.relationships(items, "k", parents, "id").collect()] == [("a", 2)]
    assert quality.relationships(items, "k", spark.createDataFrame([("a",), ("a",)], "id STRING"), "id").count() == 0


def test_ranges(items):
    assert quality.accepted_range(items, "price", 0, inclusive=False).count() == 1
    assert quality.accepted_range(items, "price", 0).count() == 0
    assert quality.accepted_range(items, "freight", 0).count() == 1


def test_report_and_gate(spark, items):
    models = {"items": items, "parents": spark.createDataFrame([("b",)], "k STRING")}
    checks = [
        quality.Check("items", "k", "not_null"),
        quality.Check("items", "k", "unique"),
        quality.Check("items", "s", "accepted_values", values=("x", "z")),
        quality.Check("items", "price", "accepted_range", low=0, inclusive=False),
        quality.Check("items", "k", "relationships", parent="parents", parent_column="k"),
        quality.Check("parents", "k", "not_null"),
    ]
    report = quality.report(models, checks)
    assert {(r.model, r.check_name): r.failures for r in report.collect()} == {
        ("items", "not_null"): 1,
        ("items", "unique"): 1,
        ("items", "accepted_values"): 0,
        ("items", "accepted_range_above_0"): 1,
        ("items", "relationships_parents"): 2,
        ("parents", "not_null"): 0,
    }
    with pytest.raises(quality.QualityError, match="items.k unique: 1"):
        quality.gate(report)
    assert quality.gate(report.where("failures = 0"))


def test_report_counts_every_kind_of_failure_in_one_pass(spark):
    items = spark.createDataFrame(
        [("a", 1.0), ("a", -1.0), (None, 2.0), ("x", None), ("x", 0.0), ("b", 3.0)], "k STRING, price DOUBLE"
    )
    parents = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id STRING")
    checks = [
        quality.Check("items", "k", "not_null"), quality.Check("items", "k", "unique"),
        quality.Check("items", "k", "relationships", parent="parents", parent_column="id"),
        quality.Check("items", "price", "not_null"), quality.Check("items", "price", "accepted_range", low=0, inclusive=False),
        quality.Check("parents", "id", "unique"),
    ]
    report = quality.report({"items": items, "parents": parents}, checks)
    assert sorted(
        (r.model, r.column_name, r.check_name, r.failures) for r in report.collect()
    ) == [
        ("items", "k", "not_null", 1), ("items", "k", "relationships_parents", 2), ("items", "k", "unique", 2),
        ("items", "price", "accepted_range_above_0", 2), ("items", "price", "not_null", 1), ("parents", "id", "unique", 1),
    ]
