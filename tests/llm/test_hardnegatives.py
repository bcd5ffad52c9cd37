from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import hardnegatives

SCHEMA = "vec_id long, label int, embedding array<float>"
LIMIT = 2**63


def score(a, b):
    exact = sum(math.floor(256 * float(np.float32(x))) * math.floor(256 * float(np.float32(y))) for x, y in zip(a, b))
    return min(max(exact, -LIMIT), LIMIT - 1)


def brute(rows, every=5):
    """Straight from the definition."""
    valid = [
        (i, k, v) for i, k, v in rows
        if None not in (i, k) and v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)
    ]
    out = []
    for a, label, v in (r for r in valid if r[0] % every == 0):
        scored = [(-score(v, w), i, k) for i, k, w in valid if i != a]
        for s, p, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fits = sorted(x for x in scored if x[2] != label and -50 * s <= -100 * x[0] <= -95 * s)
            out += [(a, p, rank, i, -s, -n) for rank, (n, i, _) in enumerate(fits[:3], 1)]
    return sorted(out)


def found(spark, rows, every=5, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("label_text", F.lit("x"))
    return sorted(tuple(r) for r in hardnegatives.mine(df, F.col("vec_id") % every == 0, **more).collect())


def vectors(n, width=8, labels=3, seed=1):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 0.3) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        centre = draw.choice(centres)
        rows.append((i, draw.randrange(labels), [c + draw.gauss(0, 0.1) for c in centre]))
    return rows


def test_like_brute_force(spark):
    rows = vectors(150)
    assert found(spark, rows) == brute(rows) != []


def test_small_trees_and_blocks(spark, monkeypatch):
    for name, value in (("TREE", 4), ("BLOCK", 16), ("CELL_TREES", 2), ("CELL_BLOCKS", 2)):
        monkeypatch.setattr(hardnegatives, name, value)
    rows = vectors(120, seed=2)
    assert found(spark, rows) == brute(rows)


def test_nulls_ties_copies_and_repeated_rows(spark):
    rows = vectors(60, seed=3)
    same = rows[7][2]
    rows += [(100 + i, i % 2, same) for i in range(30)]  # a group of equal vectors
    rows += [(200, None, same), (201, 1, None), (202, 1, [0.1] * 7 + [None]), (203, 1, [float("nan")] * 8), (204, 1, [float("inf")] * 8)]
    rows += [(None, 1, same), (205, 1, []), (206, 1, same[:3])]
    assert found(spark, rows) == brute(rows)
    again = [*rows, rows[8]]
    assert found(spark, again) == brute(again)


def test_very_large_components(spark):
    rows = [(i, i % 2, [float(1e9 * (i + 1)), 1e30 if i % 7 == 0 else 0.5, -0.25]) for i in range(20)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, 1, [0.5])], [(0, 1, [0.5]), (5, 2, [0.5])]])
def test_nothing_to_return(spark, rows):
    assert found(spark, rows) == []


def test_spanning_tree_is_least():
    points = np.array([[0.0], [10], [1], [11], [3]])
    parents, edges = hardnegatives.spanning_tree(points)
    assert edges.sum() == 11 and parents[0] == -1 and sorted(edges) == [0, 1, 1, 2, 7]


def test_bounds_spare_scores(monkeypatch):
    """On clustered vectors most rows are never scored with most anchors, and the best are still found."""
    draw = np.random.default_rng(5)
    centres = draw.normal(0, 60, (6, 16))
    points = np.floor(centres[draw.integers(0, 6, 600)] + draw.normal(0, 1, (600, 16)))
    rows = hardnegatives._Rows(np.arange(600), points)
    parents, edges = hardnegatives.spanning_tree(points[:60])
    tree = {"ids": np.arange(60), "vectors": points[:60], "parents": parents, "edges": edges}
    exact, scored = points[:60] @ points.T, 0
    for place, wanted, scores in hardnegatives._searched(rows, tree, lambda p, low, high: high >= np.partition(low, -5)[-5]):
        scored += len(wanted)
        assert set(np.flatnonzero(exact[place] >= np.sort(exact[place])[-5])) <= set(wanted)
        assert (exact[place][wanted] == scores).all()
    assert scored < 0.6 * exact.size
