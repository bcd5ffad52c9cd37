from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from support import DOCS, UPPER, table

from ordermill.llm import phrases


def brute(rows, least=30, first=2000):
    """Straight from the definition; rows are (lang, text)."""
    out = []
    for lang in sorted({k or "und" for k, _ in rows}):
        counts = Counter()
        for k, text in rows:
            if (k or "und") == lang:
                for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
                    words = re.findall(r"[^\x20\x09]+", piece)
                    for n in range(1, 5):
                        counts.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        total = sum(c for p, c in counts.items() if len(p) == 1)
        kept = []
        for p, a in counts.items():
            if len(p) < 2 or a < least:
                continue
            longer = (
                f for q, f in counts.items()
                if len(q) > len(p) and f >= least and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            )
            if any(100 * f >= 80 * a for f in longer):
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total, -s))
    return sorted(out)


def found(spark, rows, **more):
    df = spark.createDataFrame([(i, t, k, "s", 0) for i, (k, t) in enumerate(rows)], DOCS)
    return sorted(tuple(r) for r in phrases.collocations(df, **more).collect())


def texts(seed, n, vocabulary=12):
    draw = random.Random(seed)
    names = [f"{a}{b}" for a in "bcdfk" for b in "aeiou"][:vocabulary]
    ends = [" ", " ", " ", " ", ". ", ", ", "\t", "\n", "! ", ". "]
    return ["".join(draw.choice(names).capitalize() + draw.choice(ends) for _ in range(draw.randrange(0, 60))) for _ in range(n)]


def test_like_brute_force(spark):
    rows = [(k, t) for i, k in enumerate(("en", "de", None)) for t in texts(i, 60)]
    assert found(spark, rows, least=8) == brute(rows, 8) != []


def test_small_shards_and_full_filter(spark):
    """Neither the cut into shards nor a bit table that lets everything through changes a result."""
    rows = [("en", t) for t in texts(4, 80)]
    expected = brute(rows, 10)
    assert found(spark, rows, least=10, shard_words=50) == expected
    assert found(spark, rows, least=10, shard_words=200, filter_bits=64) == expected


def test_first_few_and_ties(spark):
    rows = [("en", "a b. c d. e f. g h. i j. ü v. z w.")] * 30
    got = found(spark, rows, first=3)
    assert got == brute(rows, first=3) and [r[2] for r in sorted(got, key=lambda r: r[1])] == ["a b", "c d", "e f"]


def test_given_documents(spark):
    given = table(spark, "documents")
    rows = [tuple(r) for r in given.select("lang", "text").collect()]
    got = sorted(tuple(r) for r in phrases.collocations(given, least=12).collect())
    assert got == brute(rows, 12) != []


def test_nulls_empty_texts_long_words_and_cycles(spark):
    rows = [("en", None), ("en", ""), (None, " ,;\n"), ("fr", "!" * 50), ("en", "x " * 200), ("en", "y" * 100_000), (None, "q r " * 90)]
    assert found(spark, rows) == brute(rows) != []


def test_empty_table_and_extra_columns(spark):
    assert found(spark, []) == []
    wider = spark.createDataFrame([("en", "a b. " * 40)], "lang string, text string").selectExpr("*", "1 AS phrase", "2 AS size", "3 AS words")
    assert [r["phrase"] for r in phrases.collocations(wider).collect()] == ["a b"]


@pytest.mark.parametrize("seed", range(3))
def test_index_counts_every_extension(seed):
    """Both intervals of every phrase stay in step while words are added on either side."""
    shard = phrases._Shard("en")
    part = texts(seed, 20, 5)
    shard.add(pa.array(part))
    row = shard.index().to_pylist()[0]
    index = phrases.Index(pa.array(row["words"]), np.array(row["counts"]), row["left"], row["right"])
    counts = Counter()
    for text in part:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 5):
                counts.update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    values = {}
    for sides in ("left left left", "right right right", "left right left", "right left right"):
        at = index.single()
        got = dict(zip(index.texts(at).to_pylist(), at.size.tolist()))
        for side in sides.split():
            at = index.extended(at, side)
            got.update(zip(index.texts(at).to_pylist(), at.size.tolist()))
            values.setdefault(at.words.shape[1], {}).update(zip(index.texts(at).to_pylist(), at.value.tolist()))
            assert all(values[k][t] == v for k in values for t, v in zip(index.texts(at).to_pylist(), at.value.tolist()) if t in values[k])
        assert got == counts


def test_score_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("5000000000000L AS a", "5000000000001L AS l", "5000000000002L AS r")
    exact = "cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    assert row.selectExpr(exact).first()[0] == 2_000_000 * 5_000_000_000_000 // 10_000_000_000_003


def test_text_of_a_pair_is_told_by_one_shard(spark, monkeypatch):
    """However many shards hold a frequent pair or triple, one of them sends its text; the counts are those of all shards."""
    rows = [("en", t) for t in texts(4, 400, 5)]
    stored, kept = {}, phrases.kept

    def watched(df, label="step"):
        stored[label] = kept(df, label)
        return stored[label]

    monkeypatch.setattr(phrases, "kept", watched)
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, 16), "lang string, text string")
    frequent, _ = phrases.frequent_phrases(frame, 10, shard_words=50)
    expected = frequent.where("size in (2, 3)").count()
    shards = stored["told"].select("shard").distinct().count()
    assert shards > 10 and expected > 20
    # Another bit table says which shard is asked, so a few more may be sent.
    assert expected <= stored["told"].where("size < 4").count() <= 1.1 * expected


def test_counts_by_range_are_all_counts():
    shard = phrases._Shard("en")
    shard.add(pa.array(texts(7, 40)))
    row = shard.index().to_pylist()[0]
    index = phrases.Index(pa.array(row["words"]), np.array(row["counts"]), row["left"], row["right"])
    pairs = index.extended(index.single(), "right")
    sent = phrases._by_range("en", row["shard"], pairs).to_pylist()
    got = {k: (c, f) for r in sent for k, c, f in zip(r["keys"], r["checks"], r["counts"])}
    keys, checks = phrases._keys("en", pairs.value).tolist(), phrases._checks(pairs.check).tolist()
    assert got == {k: (c, f) for k, c, f in zip(keys, checks, pairs.size.tolist())} and len(got) == len(pairs.size) > 50
    assert all(r["bucket"] == (k % 2**64) >> (64 - phrases.BUCKET_BITS) for r in sent for k in r["keys"])
