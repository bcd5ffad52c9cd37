"""Training-data queries against their SQL twins."""

from __future__ import annotations

import pytest
from compare import connect, difference

from ordermill.llm.oracle import ORACLES
from ordermill.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, size):
    folder = f"/root/testdata/{size}"
    assert difference(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None
