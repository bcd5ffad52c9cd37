from __future__ import annotations

import re
from collections import defaultdict

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = {i: i + 32 for i in range(65, 91)}


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark, *texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def white_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def shared(sets):
    """Pairs of keys of ``sets`` with a common element, and how many they have."""
    holders, common = defaultdict(list), defaultdict(int)
    for k, s in sets.items():
        for x in s:
            holders[x].append(k)
    for held in holders.values():
        held.sort()
        for i, a in enumerate(held):
            for b in held[i + 1 :]:
                common[a, b] += 1
    return common


def prose(seed, n):
    import random

    draw = random.Random(seed)
    return [f"{draw.choice('bcdfgklm')}{draw.choice('aeiou')}{draw.choice('nrst')}{draw.randrange(400)}" for _ in range(n)]
