from __future__ import annotations

import random

import numpy as np
from support import SF, UPPER, docs, prose, roots, shared, table, white_words

from ordermill.llm import batches, linking, minhash
from ordermill.llm.queries import QUERIES


def shingles(text):
    w = white_words((text or "").translate(UPPER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    links = [p for p, n in shared(sets).items() if 100 * n >= 85 * len(sets[p[0]] | sets[p[1]])]
    return {i: (i, len(sets[i]), r, r == i) for i, r in roots(sets, links).items()}


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, "documents").select("doc_id", "text").collect()]
    found = {r[0]: tuple(r) for r in QUERIES["op1_hyperminhash"](spark, SF).collect()}
    assert found == brute(rows)


def test_family_of_variants(spark):
    """Members that are linked through others only, among look-alikes below the threshold."""
    draw = random.Random(3)
    base = prose(1, 160)
    texts = []
    for i in range(120):
        w = list(base)
        for _ in range(draw.randrange(9)):
            w[draw.randrange(len(w))] = f"x{i}{draw.randrange(1000)}"
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    assert {r[0]: tuple(r) for r in minhash.classes(docs(spark, *texts)).collect()} == brute(rows)


def test_pairs_compared_in_growing_families(spark, monkeypatch):
    """Look-alikes with up to eight changed words each: what is compared grows with the family, not with its square."""
    counted = []
    made = minhash._verifier

    def counting(narrow, percent):
        verify = made(narrow, percent)

        def test(pairs):
            counted.append(pairs.count())
            return verify(pairs)

        return test

    monkeypatch.setattr(minhash, "_verifier", counting)
    base = prose(1, 160)
    totals = {}
    for size in (100, 400):
        draw = random.Random(size)
        texts = []
        for i in range(size):
            w = list(base)
            for _ in range(draw.randrange(9)):
                w[draw.randrange(len(w))] = f"x{i}{draw.randrange(1000)}"
            texts.append(" ".join(w))
        counted.clear()
        assert {r[0]: tuple(r) for r in minhash.classes(docs(spark, *texts)).collect()} == brute(list(enumerate(texts)))
        totals[size] = sum(counted)
    print(totals)
    assert totals[400] <= 6 * totals[100], totals


def test_short_templates_against_brute_force(spark):
    """Templates with endings of their own, below the threshold, but for one pair at it that shares no more than the template."""
    texts, wanted = [], []
    for f in range(30):
        base = prose(100 + f, 21)
        texts += [" ".join(base + prose(5000 + 100 * f + i, 6)) for i in range(50)]
        texts += [" ".join(base), " ".join(base + prose(3000 + f, 3))]
        wanted.append((len(texts) - 2, len(texts) - 1))
    found = {r[0]: tuple(r) for r in minhash.classes(docs(spark, *texts)).collect()}
    assert sum(found[a][2] == found[b][2] for a, b in wanted) == len(wanted)
    assert found == brute(list(enumerate(texts)))


def test_edge_cases(spark):
    long = " ".join(prose(5, 60_000))
    texts = [None, "", " \n\t", "One two", "one TWO", "a b c d e", "a b c d e", long, long + " end", "É b c d e"]
    frame = docs(spark, *texts).selectExpr("*", "1 as n_shingles", "2 as component_id")
    found = {r[0]: tuple(r[1:]) for r in minhash.classes(frame).collect()}
    assert found[0] == found[1][:0] + (0, 0, True)
    assert [found[i] for i in (1, 2)] == [(0, 1, True), (0, 2, True)]
    assert [found[i] for i in (3, 4)] == [(1, 3, True), (1, 3, False)]
    assert found[6] == (1, 5, False) and found[9] == (1, 9, True)
    assert found[8][1:] == (7, False)
    kept = minhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r[0] for r in kept.collect()) == [0, 1, 2, 3, 5, 7, 9]


def test_missing_and_repeated_ids(spark):
    frame = docs(spark, "a b c d e f", "a b c d e f", "p q r s t", "k l m n o", "k l m n o", ids=[None, 4, None, 9, 9])
    found = sorted((tuple(r) for r in minhash.classes(frame).collect()), key=repr)
    assert found == sorted([(None, 2, 4, False), (4, 2, 4, True), (None, 1, None, True), (9, 1, 9, True), (9, 1, 9, True)], key=repr)


def test_empty_table(spark):
    assert minhash.classes(docs(spark)).collect() == []


def test_estimate_is_near_the_truth():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 2**64 - 1, 4000, dtype=np.uint64)
    a, b = np.sort(pool[:3600]), np.sort(pool[400:])
    regs = minhash.registers([a, b])
    value, used = minhash.estimate(regs[:1], regs[1:], np.array([3600]), np.array([3600]))
    assert used[0] == minhash.REGISTERS and abs(value[0] - 0.8) < 0.12
    assert regs.dtype == np.uint16


def test_slices_are_bounded():
    import pyarrow as pa

    batch = pa.record_batch({"text": ["x" * (batches.SLICE_BYTES // 2 + 1)] * 3 + [None] * 3000})
    parts = list(batches.slices(batch, "text"))
    assert sum(p.num_rows for p in parts) == 3003
    assert all(p.num_rows <= batches.SLICE_ROWS for p in parts) and parts[0].num_rows == 1


def test_texts_are_read_in_place(spark, monkeypatch):
    """Of many nodes a bit table finds the texts: no row of text is moved, and no asked node is missed, ids of all kinds."""
    ids = [*range(300), -1, -(2**63), 2**63 - 1, 2**24, 2**24 + 1, 5, None]
    frame = docs(spark, *(" ".join(prose(i, 12)) for i in range(len(ids))), ids=ids).select("doc_id", "text")
    nodes = spark.createDataFrame([(i,) for i in ids[2:306:3] + [5, -(2**63)]], "node long").distinct()
    schema = "node long, n long, shingles binary"
    few = minhash._made_of(frame, nodes, minhash._shingles_of, schema)
    monkeypatch.setattr(minhash, "FEW_NODES", 0)
    many = minhash._made_of(frame, nodes, minhash._shingles_of, schema)
    assert "Exchange" not in many._jdf.queryExecution().toString()
    rows = sorted(tuple(r) for r in few.collect())
    assert sorted(tuple(r) for r in many.join(nodes, "node", "left_semi").collect()) == rows and len(rows) > 100


def test_few_pairs_move_few_rows(spark):
    """Both ends of the pairs get their columns; rows of other nodes are cut before they are joined."""
    own = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "node long, text string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (7, 60)], "a long, b long")
    joined = linking.ends_joined(pairs, own, ("text",))
    assert sorted(map(tuple, joined.select("a", "b", "text_a", "text_b").collect())) == [(1, 2, "t1", "t2"), (1, 3, "t1", "t3")]
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 2
