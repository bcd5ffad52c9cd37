from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from support import SF, docs, table
from tokenizers import Tokenizer

from ordermill.llm import tokenbin, tokens
from ordermill.llm.queries import QUERIES


def plain_ids(texts):
    tokenizer = Tokenizer.from_file(tokens.public_path())
    return [x.ids for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_query_round_trip(spark):
    rows = table(spark, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_token_files"](spark, SF).collect()}
    start = 0
    for (doc_id, _), ids in zip(rows, plain_ids([r.text for r in rows])):
        ids = np.array([*ids, 0], "<u4")
        assert found.pop(doc_id) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not found


def test_parts_encode_as_the_whole():
    texts = [
        None, "", " ", "  two  blanks ", "it's we'll I'd", "a\n b\n\n c \t d", "x<|endoftext|> y <|endoftext|>z", "  a b  c",
        "\x1c a \x1c b\x85 c", "ß é ñ 12 34,5 !! ?", "e ́x", "\U0001f600 \U0001f600a", "word " * 2000, "y" * 5000,
    ]
    draw = random.Random(5)
    texts += ["".join(draw.choice(" \n\ta1'.é< \x1f") for _ in range(60)) for _ in range(300)]
    encoder = tokens.Encoder(tokens.public_path())
    for _ in range(2):
        ids, counts = encoder.encode(texts)
        assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == plain_ids(texts)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 4095, 30_000])
def test_index_is_minimal_and_perfect(n):
    draw = np.random.default_rng(n)
    keys = np.unique(draw.integers(0, 2**63, n, dtype=np.uint64))
    slots = np.zeros(len(keys), tokenbin._SLOT)
    slots["offset"] = np.arange(len(keys))
    index = tokenbin.build_index(keys, slots, 2)
    found, known = tokenbin.find(index, keys)
    assert known.all() and (found["offset"] == slots["offset"]).all()
    assert sorted(found["offset"]) == list(range(len(keys)))
    other = draw.integers(2**63, 2**64 - 1, 2000, dtype=np.uint64)
    assert tokenbin.find(index, other)[1].sum() <= 1


def test_edge_cases(spark, tmp_path):
    texts = [None, "", "b", "a", "word " * 100_000, "z", "b"]
    ids = [3, 1, 2, 2, 9, None, 2]
    frame = docs(spark, *texts, ids=ids).selectExpr("*", "1 as shard", "2 as ordinal")
    folder = tokenbin.write(frame, f"{tmp_path}/set")
    found = {(r.doc_id, r.ordinal): r for r in tokenbin.read(spark, folder, tokenbin.keys_of(spark, folder)).collect()}
    expected = [((None, 0), "z"), ((1, 0), ""), ((2, 0), "a"), ((2, 1), "b"), ((2, 2), "b"), ((3, 0), None), ((9, 0), texts[4])]
    start = 0
    for (key, text), own in zip(expected, plain_ids([t for _, t in expected])):
        assert list(found[key].ids) == [*own, 0] and found[key].start == start and found[key].n_tokens == len(own) + 1
        start += len(own) + 1
    assert len(found) == len(expected)
    asked = spark.createDataFrame([(2, 1), (2, 7), (555, 0)], "doc_id long, ordinal long")
    assert [(r.doc_id, r.ordinal) for r in tokenbin.lookup(spark, folder, asked).collect()] == [(2, 1)]


def test_empty_table(spark, tmp_path):
    folder = tokenbin.write(docs(spark), f"{tmp_path}/set")
    assert tokenbin.checksums(spark, folder, tokenbin.keys_of(spark, folder)).collect() == []


ODD = [
    "a  b", "x  y z", "  a b", "\u00e9 \u00e8 \u00fc a", " lead and trail ", "tab\t x y", "\x85 b c", "a\u00a0 b c", "a \u3000b c", "one", "", None,
    "<|endoftext|> a <|endoftext|>", "line\n next word", "\u65e5\u672c \u8a9e x", "\U0001f389 party \U0001f389 x", "a\x1c b\x1f c", "word " * 3000,
]


@pytest.mark.parametrize("remembered", [1, 400_000])
def test_ids_of_odd_texts_and_of_texts_seen_before(monkeypatch, remembered):
    monkeypatch.setattr(tokens, "REMEMBERED", remembered)
    encoder = tokens.Encoder(tokens.public_path())
    for texts in (ODD, ODD[::-1], [" ".join(x or "" for x in ODD)], [None, ""], []):
        ids, counts = encoder.encode(texts)
        plain = [encoder.tokenizer.encode(x or "", add_special_tokens=False).ids for x in texts]
        assert counts.tolist() == [len(p) for p in plain] and ids.tolist() == [i for p in plain for i in p]
