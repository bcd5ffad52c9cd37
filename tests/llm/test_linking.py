"""Components that take in more edges, against those of all edges at once."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from ordermill.llm import linking


def _labels(df):
    rows = [tuple(r) for r in df.select("node", "comp").collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_merged_components_are_those_of_all_edges(spark, monkeypatch):
    rng = random.Random(5)
    edges = [tuple(sorted(rng.sample(range(120), 2))) for _ in range(70)]
    made = lambda rows: spark.createDataFrame(rows, "a long, b long")
    labels, searched = linking.components(made(edges[:40])), []
    real = linking.components

    def counted(some):
        searched.append(some.count())
        return real(some)

    monkeypatch.setattr(linking, "components", counted)
    for begin in (40, 55):
        labels = linking.merged(labels, made(edges[begin : begin + 15]))
        assert _labels(labels) == _labels(real(made(edges[: begin + 15])))
    assert max(searched) <= 15  # the new edges only
    # Edges inside a component change nothing, and two large components join by one edge.
    joined = linking.merged(linking.components(made([(1, 2), (2, 3), (7, 8), (8, 9)])), made([(1, 3), (3, 9)]))
    assert _labels(joined) == {n: 1 for n in (1, 2, 3, 7, 8, 9)}


def test_shuffle_of_a_stored_step_is_let_go_at_once(spark):
    linking.release(spark)
    linking.release(spark)
    known = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses
    before = known().size()
    result = linking.stored(spark.range(1000).groupBy(F.xxhash64("id").alias("k")).agg(F.min("id").alias("low")), "step")
    for _ in range(50):
        if known().size() <= before:
            break
        time.sleep(0.1)
    assert known().size() <= before
    assert result.count() == 1000


def test_members_are_counted_in_one_move(spark, monkeypatch):
    plans, kept = [], linking.kept
    monkeypatch.setattr(linking, "kept", lambda df, label="step": plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df, label))
    rows = [(k, n) for k, size in ((1, 1), (2, 2), (3, 40)) for n in range(size)]
    found = linking.shared(spark.createDataFrame(rows, "key long, node long"))
    assert sorted((r.key, r.node, r["size"]) for r in found.collect()) == [(2, n, 2) for n in range(2)] + [(3, n, 40) for n in range(40)]
    assert sum("Exchange" in line for line in plans[0].split("\n")) == 1
