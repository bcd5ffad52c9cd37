from __future__ import annotations

import math
import re

from support import SF, UPPER, docs, prose, table

from ordermill.llm import licenses
from ordermill.llm.queries import QUERIES


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def base(text):
    w = words(text)
    places = {}
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places[i] = label
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(set(places.values())))


def blocks(text):
    """Every block of every template that reaches the threshold."""
    w = words(text)
    for label, template in licenses.TEMPLATES:
        own = words(template)
        need = math.ceil(licenses.CONTAINMENT * len(set(own)) - 1e-9)
        span = 1 << (len(own) - 1).bit_length()
        for block in range(max(1, math.ceil(len(w) / span))):
            common = len(set(own) & set(w[block * span : (block + 2) * span]))
            if common >= need:
                yield label, block * span, common / len(set(own))


def compared(rows, texts):
    for r in rows:
        text = texts[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text)
        found = list(blocks(text))
        assert r.labels == ",".join(sorted({x for x, *_ in found} | set(filter(None, r.base_labels.split(",")))))
        assert r.score == (1.0 if r.base_labels else max((x for *_, x in found), default=0.0))
        if "matches" in r.asDict():
            assert sorted((m.label, m.first_word, m.containment) for m in r.matches or []) == sorted(found)


def test_query_equals_brute_force(spark):
    texts = dict(table(spark, "documents").select("doc_id", "text").collect())
    rows = QUERIES["op9_license_blocks"](spark, SF).collect()
    assert len(rows) == len(texts) and any(r.base_labels for r in rows)
    compared(rows, texts)


def test_whole_and_changed_notices(spark):
    texts = {}
    for i, (_, template) in enumerate(licenses.TEMPLATES):
        w = template.split()
        filler = prose(i, 150)
        texts[4 * i] = " ".join(filler[:90] + w + filler[90:])
        texts[4 * i + 1] = " ".join(x for k, x in enumerate(w) if k % 9)
        texts[4 * i + 2] = " ".join(x for k, x in enumerate(w) if k % 3)
        texts[4 * i + 3] = template.upper().replace(" ", "\n * ")
    rows = licenses.scan(docs(spark, *texts.values())).collect()
    compared(rows, texts)
    assert all(r.labels for r in rows if r.doc_id % 4 == 0)


def test_edge_cases(spark):
    texts = [None, "", "The MIT  LICENSE, mit license; CC-BY and GNU\ngeneral-public license", "apache license " * 50_000, "mitlicense é cc é by", "a"]
    frame = docs(spark, *texts, ids=[0, 1, 2, 3, 4, 4]).selectExpr("*", "1 as row", "2 as word", "3 as template")
    rows = licenses.scan(frame.where("doc_id < 4")).collect()
    compared(rows, dict(enumerate(texts)))
    assert {r.doc_id: r.base_labels for r in rows} == {0: "", 1: "", 2: "cc-by,gpl,mit", 3: "apache"}
    assert len(licenses.scan(frame.where("doc_id = 4")).collect()) == 2
    assert licenses.scan(docs(spark)).collect() == []
    assert [r.n_words for r in licenses.scan(docs(spark, "x y", ids=[None])).collect()] == [2]
