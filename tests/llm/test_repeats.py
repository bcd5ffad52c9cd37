from __future__ import annotations

import random

import numpy as np
import pytest
from support import DOCS, docs, prose, table, white_words

from ordermill.llm import repeats


def brute(rows, least=20):
    """Straight from the definition; rows are (doc_id, text) with distinct ids."""
    first, removed = {}, {i: set() for i, _ in rows}
    for i, text in sorted(rows):
        words = white_words(text)
        for at in range(len(words) - least + 1):
            if first.setdefault(tuple(words[at : at + least]), (i, at)) != (i, at):
                removed[i].update(range(at, at + least))
    return sorted(
        (i, len(words), len(removed[i]), " ".join(w for k, w in enumerate(words) if k not in removed[i]))
        for i, words in ((i, white_words(t)) for i, t in rows)
    )


def found(df, least=20):
    return sorted(tuple(r) for r in repeats.dedup(df, least).collect())


def passages(seed):
    """Texts that share passages of many lengths, whole copies, near copies and inner repeats."""
    draw = random.Random(seed)
    shared = [prose(1000 + i, n) for i, n in enumerate((18, 19, 20, 21, 25, 39, 40, 41, 60, 130))]
    texts = []
    for i in range(60):
        words = []
        for _ in range(draw.randrange(1, 5)):
            words += prose(draw.random(), draw.randrange(3, 60))
            if draw.random() < 0.6:
                part = draw.choice(shared)
                cut = draw.randrange(0, 3)
                words += part[cut : len(part) - draw.randrange(0, 3)]
        texts.append(draw.choice([" ", "  ", "\n"]).join(words))
    for _ in range(10):
        words = draw.choice(texts).split()
        words[draw.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    return texts + texts[:5] * 3


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    texts = passages(seed)
    assert found(docs(spark, *texts)) == brute(list(enumerate(texts)))


@pytest.mark.parametrize("least", [1, 4, 7, 33])
def test_other_lengths(spark, least):
    texts = passages(3)[:40]
    assert found(docs(spark, *texts), least) == brute(list(enumerate(texts)), least)


def test_given_documents(spark):
    rows = table(spark, "documents")
    given = [tuple(r) for r in rows.select("doc_id", "text").collect()]
    assert found(rows) == brute(given)


def test_many_slices(spark, monkeypatch):
    """A passage in every document, each document a slice of its own: nothing is settled before the shuffle."""
    passage = prose(7, 50)
    texts = [" ".join([*prose(100 + i, 30), *passage, *prose(200 + i, 5)]) for i in range(40)]
    many = docs(spark, *texts).repartition(40)
    assert found(many) == brute(list(enumerate(texts)))


def test_nulls_empty_texts_and_short_cycles(spark):
    words = prose(9, 30)
    texts = [None, "", " \n\t ", "a " * 45, "a b " * 40, "a b c " * 30, " ".join(words * 3), "é ü " * 25, "x"]
    assert found(docs(spark, *texts)) == brute(list(enumerate(texts)))


def test_repeated_and_missing_ids(spark):
    text, other = " ".join(prose(11, 40)), " ".join(prose(12, 40))
    got = found(docs(spark, text, text, other, other, ids=[3, 3, 5, 4]))
    assert [(r[0], r[2]) for r in got] == [(3, 0), (3, 0), (4, 0), (5, 40)]
    rows = [(None, text, "", "", 0), (2, text, "", "", 0), (None, other, "", "", 0), (None, other, "", "", 0)]
    result = [(r["doc_id"], r["n_removed"]) for r in repeats.dedup(spark.createDataFrame(rows, DOCS)).collect()]
    assert sorted(result, key=str) == [(2, 0), (None, 0), (None, 0), (None, 40)]


def test_very_long_text(spark):
    words = prose(13, 60_000)
    words[50_000:50_100] = words[100:200]
    got = found(docs(spark, " ".join(words), " ".join(words[300:340])))
    assert [(r[1], r[2]) for r in got] == [(60_000, 100), (40, 40)]


def test_empty_table_and_extra_columns(spark):
    assert found(docs(spark)) == []
    wider = docs(spark, "x").selectExpr("*", "1 AS part", "2 AS doc", "3 AS ranges", "4 AS first", "5 AS key")
    assert found(wider) == [(0, 1, 0, "x")]


def test_lengths_at_most_double():
    for least in range(1, 200):
        steps = repeats.lengths(least)
        assert steps[-1] == least and all(a < b <= 2 * a for a, b in zip(steps, steps[1:])) and steps[0] <= max(5, least if least < 5 else 5)


def test_run_hashes_depend_on_content_alone():
    value = np.random.default_rng(1).integers(0, 2**63, 40, dtype=np.uint64)
    twice = np.concatenate([value, value])
    for base in repeats._BASES:
        sums = repeats._Sums(twice, base)
        at = np.arange(20)
        assert (sums.of(at, at + 20) == sums.of(at + 40, at + 60)).all()
        assert len(set(sums.of(np.zeros(40, np.int64), np.arange(1, 41)).tolist())) == 40
