from __future__ import annotations

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from support import SF, docs, table

from ordermill.llm import packing
from ordermill.llm.queries import QUERIES


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


def test_boundaries_are_the_best():
    draw = np.random.default_rng(2)
    for _ in range(30):
        lengths = draw.choice(np.arange(1, 60), draw.integers(1, 9), replace=False)
        counts = draw.integers(1, 50, len(lengths))
        for k in (1, 2, 3, 12):
            found = packing.boundaries(lengths, counts, k)
            choices = (
                [*c, max(lengths)] for m in range(min(k, len(lengths))) for c in combinations(sorted(lengths)[:-1], m)
            )
            assert len(found) <= k and found[-1] == max(lengths)
            assert padding(lengths, counts, found) == min(padding(lengths, counts, c) for c in choices)
    assert packing.boundaries(np.array([]), np.array([]), 3) == []


def checked(rows, counts, max_length, budget):
    """Whole documents, the right bucket, full batches within the budget."""
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.first_token, r.length))
    assert Counter({d: sum(p[2] for p in ps) for d, ps in pieces.items()}) == Counter(counts)
    for ps in pieces.values():
        for i, (piece, first, length) in enumerate(sorted(ps)):
            assert (piece, first) == (i, i * max_length) and (length == max_length or i == len(ps) - 1)
    bounds = sorted({r.boundary for r in rows})
    batches = defaultdict(list)
    for r in rows:
        assert r.boundary == min(b for b in bounds if b >= r.length)
        batches[r.bucket, r.batch].append(r)
    for bucket in {b for b, _ in batches}:
        numbers = sorted(n for b, n in batches if b == bucket)
        assert numbers == list(range(len(numbers)))
        for n in numbers:
            held = batches[bucket, n]
            assert sorted(r.slot for r in held) == list(range(len(held)))
            size = budget // held[0].boundary
            assert len(held) == size or n == numbers[-1] and len(held) < size


def test_query(spark):
    counts = {r[0]: r[1] for r in packing.token_counts(table(spark, "documents")).collect()}
    rows = QUERIES["op5_length_buckets"](spark, SF).collect()
    checked(rows, counts, packing.MAX_LENGTH, packing.BUDGET)


def test_numbers_run_over_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_PART", 20)
    frame = table(spark, "documents")
    counts = {r[0]: r[1] for r in packing.token_counts(frame).collect()}
    checked(packing.pack(frame, 300, 5, 900).collect(), counts, 300, 900)


def test_edge_cases(spark):
    frame = docs(spark, None, "", "a b", "word " * 50_000, "a b", "a b", ids=[0, 1, None, 3, 4, 4]).selectExpr("*", "1 as part", "2 as bucket")
    rows = packing.pack(frame).collect()
    assert Counter(r.doc_id for r in rows if r.doc_id != 3) == Counter({0: 1, 1: 1, None: 1, 4: 2})
    assert {r.length for r in rows if r.doc_id in (0, 1)} == {1}
    assert packing.pack(docs(spark)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(frame, 100, 3, 50)
