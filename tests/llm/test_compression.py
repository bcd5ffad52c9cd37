from __future__ import annotations

import random
from collections import Counter

import zstandard
from support import SF, docs, prose, table, white_words

from ordermill.llm import compression
from ordermill.llm.queries import QUERIES


def counts(text):
    text = text or ""
    w = white_words(text)
    runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if white_words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside)


def test_query_equals_plain_counts(spark):
    texts = dict(table(spark, "documents").select("doc_id", "text").collect())
    rows = QUERIES["op6_compression_bands"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:6] == counts(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        press = zstandard.ZstdCompressor(level=compression.LEVEL).compress
        *_, failed = compression.ratios(texts[r.doc_id].encode(), press)
        assert r.kept == (not r.base_failed and not failed)


def test_bands_reject_both_ends(spark):
    draw = random.Random(1)
    noise = " ".join("".join(chr(draw.randrange(0x4E00, 0x9FFF)) for _ in range(7)) for _ in range(900))
    plain = " ".join(prose(2, 900))
    half = " ".join(prose(3, 900)) + " " + " ".join(f"{i % 10} again and again the same" for i in range(900))
    rows = compression.measure(docs(spark, plain, noise, "one two three four five six seven eight nine ten " * 300, half)).orderBy("doc_id").collect()
    assert [r.band_failed for r in rows] == [False, True, True, True]
    assert rows[3].chunk_low < 0.2 < rows[3].chunk_high


def test_edge_cases(spark):
    texts = [None, "", "a  b\tc", "é é", "x\nx\n\n \n ", "a b c d e a b c d e", "w " * 200_000]
    frame = docs(spark, *texts).selectExpr("*", "1 as ratio", "2 as kept")
    rows = compression.judge(frame).orderBy("doc_id").collect()
    assert [tuple(r)[1:6] for r in rows] == [counts(t) for t in texts]
    assert [r.kept for r in rows] == [False] * 7 and rows[0].ratio is None
    assert compression.judge(docs(spark)).collect() == []
    twice = compression.judge(docs(spark, "a b", "a b", ids=[None, None])).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
