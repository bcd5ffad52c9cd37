from __future__ import annotations

import math
import re
from collections import Counter

from support import SF, docs, prose, table

from ordermill.llm import decontaminate
from ordermill.llm.queries import QUERIES

ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(w, k):
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]


def brute(docs_, items):
    """Best similarity of every window of the item's size, for every document and item."""
    parts = {i: words(t) for i, t in items if words(t)}
    sets = {i: set(grams(w, min(5, len(w)))) for i, w in parts.items()}
    held = Counter(g for s in sets.values() for g in s)
    n = len(parts)
    weight = {g: math.log(1 + n / c) for g, c in held.items()}
    found = {}
    for d, text in docs_:
        w = words(text)
        for i, own in sets.items():
            size, k = len(parts[i]), min(5, len(parts[i]))
            gs = grams(w, k)
            if not own.intersection(gs):
                continue
            total = sum(weight[g] for g in own)
            for start in range(max(1, len(w) - size + 1)):
                window = set(gs[start : start + size - k + 1])
                both = sum(weight[g] for g in window & own)
                value = both / (total + len(window - own) * math.log(1 + n))
                if value >= 0.8:
                    found[d, i] = max(found.get((d, i), 0), value)
    return found


def compared(frame, items, expected):
    rows = decontaminate.contaminated(frame, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == set(expected)
    assert all(math.isclose(r.similarity, expected[r.doc_id, r.item_id], rel_tol=1e-9) for r in rows)


def test_query_equals_brute_force(spark):
    texts = [tuple(r) for r in table(spark, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, "benchmark").select("item_id", "text").collect()]
    expected = brute(texts, items)
    rows = QUERIES["op8_simhash_windows"](spark, SF).collect()
    assert expected and {(r.doc_id, r.item_id) for r in rows} == set(expected)


def test_changed_passages(spark):
    item = prose(1, 60)
    filler = prose(2, 300)
    texts = []
    for i in range(60):
        w = list(item)
        w[i] = "other"
        if i % 3 == 0:
            w[(i + 30) % 60] = "another"
        if i % 4 == 0:
            del w[10]
        texts.append(" ".join(filler[:i] + w + filler[i:]))
    rows = list(enumerate(texts))
    items = [(7, " ".join(item).upper() + "!"), (8, " ".join(prose(3, 40))), (9, " ".join(item[:30]))]
    expected = brute(rows, items)
    assert len({d for d, _ in expected}) > 25
    compared(docs(spark, *texts), spark.createDataFrame(items, ITEMS), expected)


def test_edge_cases(spark):
    long = " ".join(prose(4, 80_000))
    item = " ".join(prose(5, 20))
    texts = [None, "", "!!", item, item, f"{long} {item} {long}", " ".join(item.split()[:18]), "two words", "say two words now"]
    items = [(1, item), (1, item), (2, None), (3, ""), (4, "Two, words"), (None, item)]
    frame = docs(spark, *texts, ids=[0, 1, 2, 3, 3, 5, 6, 7, None]).selectExpr("*", "1 as item_id", "2 as n")
    rows = decontaminate.contaminated(frame, spark.createDataFrame(items, ITEMS)).collect()
    found = {(r.doc_id, r.item_id): r for r in rows}
    assert set(found) == {(3, 1), (5, 1), (6, 1), (7, 4), (None, 4), (3, None), (5, None), (6, None)}
    assert len(rows) == 8 and found[5, 1].first_word == 80_000 and found[6, 1].similarity < 1
    left = decontaminate.without_leaks(frame, spark.createDataFrame(items, ITEMS))
    assert left.columns == frame.columns and sorted(r.doc_id for r in left.collect()) == [0, 1, 2]


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.contaminated(docs(spark, "a b c d e"), none).collect() == []
    assert decontaminate.without_leaks(docs(spark, "a b c d e"), none).count() == 1
    assert decontaminate.contaminated(docs(spark), spark.createDataFrame([(1, "a b c")], ITEMS)).collect() == []
