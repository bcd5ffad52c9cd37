"""Every registered query against its SQL twin on the smallest data set."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from ordermill.oracle import ORACLES
from ordermill.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_flagship_has_rows(spark):
    assert contract.entry(spark).count() > 0
