from __future__ import annotations

import random
import zlib

from support import docs, table

from ordermill.llm import langmix
from ordermill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = {r.doc_id: r for r in QUERIES["op3_language_mixture"](spark, SF).collect()}
    rows = table(spark, "documents", SF).select("doc_id", "lang").collect()
    assert len(found) == len(rows)
    for r in found.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [(found[i].lang_pred, lang) for i, lang in rows if found[i].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.97


def test_mixture_of_two_languages(spark):
    rows = table(spark, "documents", SF).orderBy("doc_id").collect()
    model = langmix.fit_labelled(table(spark, "documents", SF))
    en, fr = (next(r.text for r in rows if r.lang == x and 900 < len(r.text) < 1500) for x in ("en", "fr"))
    found = langmix.identify(docs(spark, en + "\n" + fr, en), model).orderBy("doc_id").collect()
    assert {x.lang for x in found[0].languages} == {"en", "fr"} and all(0.2 < x.share < 0.8 for x in found[0].languages)
    assert [x.lang for x in found[1].languages] == ["en"]


def test_edge_cases(spark):
    training = docs(spark, "der hund und die katze", "the dog and the cat", None, "x").withColumn("lang", langmix.F.expr("element_at(array('de', 'en', 'en', null), int(doc_id) + 1)"))
    model = langmix.fit(training)
    assert model.languages == ["de", "en"]
    frame = docs(spark, None, "", "123 ... !", "the dog", "und die", "the dog", "a", "é" * 200_000, ids=[0, 1, 2, 3, None, 3, 6, 7])
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.lang_pred) for r in langmix.identify(frame.selectExpr("*", "'q' as score"), model).collect())
    assert [x for x in found if x[0] < 6] == [(-1, "de"), (0, "und"), (1, "und"), (2, "und"), (3, "en"), (3, "en")]
    assert [x[0] for x in found[-2:]] == [6, 7]
    assert langmix.identify(docs(spark), model).collect() == []


def test_without_training_rows(spark):
    model = langmix.fit(docs(spark).select("text", "lang"))
    assert [r.lang_pred for r in langmix.identify(docs(spark, "abc"), model).collect()] == ["und"]
    assert langmix.accepted(docs(spark, "abc").where("false")).collect() == []


def test_accepted_keeps_rows_whole(spark):
    frame = table(spark, "documents", SF).limit(200).selectExpr("*", "doc_id as score")
    kept = langmix.accepted(frame)
    assert kept.columns == frame.columns
    assert kept.count() >= 195


def test_accepted_looks_at_the_whole_set(spark):
    rows = table(spark, "documents", SF).orderBy("doc_id").collect()
    langs = sorted({r.lang for r in rows if r.lang})[:3]
    parts = [next(r.text for r in rows if r.lang == x and 900 < len(r.text) < 1500)[:900] for x in langs]
    draw = random.Random(1)
    noise = "".join(chr(draw.choice((0x1400, 0xA000)) + draw.randrange(500)) for _ in range(900))
    extra = docs(spark, "\n".join(parts), noise, "12 34", None, ids=[-1, -2, -3, -4]).withColumn("lang", langmix.F.lit(None).cast("string"))
    given = table(spark, "documents", SF).select("doc_id", "text", "lang")
    kept = langmix.accepted(given.union(extra.select("doc_id", "text", "lang"))).where("doc_id < 0").collect()
    assert [r.doc_id for r in kept] == [-1]


def test_against_plain_expectation_maximisation():
    """Shares of the best set, by a search over the same sets with plain loops."""
    import math

    import numpy as np

    draw = np.random.default_rng(3)
    likelihood = np.full((1 << langmix.GRAM_BITS, 3), 1.0, np.float32)
    likelihood[:30] = draw.choice([2.5, 0.4, 0.1], (30, 3)).astype(np.float32)
    model = langmix.Model(list("abc"), likelihood)
    for n in (5, 40, 200):
        text = draw.choice(30, n)

        def turn(mix):
            new = [0.0] * 3
            for g in text:
                parts = [m * float(p) for m, p in zip(mix, likelihood[g])]
                for k in range(3):
                    new[k] += parts[k] / sum(parts) / n
            return new

        mix = [1 / 3] * 3
        for _ in range(langmix.ROUNDS):
            mix = turn(mix)
        order = sorted(range(3), key=lambda k: -mix[k])
        best, chosen = -math.inf, None
        for size in (1, 2, 3):
            some = [max(mix[k], 1e-6) if k in order[:size] else 0.0 for k in range(3)]
            some = [x / sum(some) for x in some]
            for _ in range(2 if size > 1 else 0):
                some = turn(some)
            value = sum(math.log(sum(m * float(p) for m, p in zip(some, likelihood[g]))) for g in text)
            value -= math.log(n) / 2 * (size - 1)
            if value > best + 1e-6:
                best, chosen = value, some
        found = langmix.mixtures(model, np.zeros(n, np.int64), text, 1)[0]
        assert np.allclose(found, chosen, atol=1e-3)


def test_many_languages(spark):
    frame = spark.range(600).selectExpr("id as doc_id", "concat('w', id, ' text of its own ', char(97 + id % 26)) as text", "concat('l', id) as lang")
    assert len(langmix.fit(frame).languages) == 600


def test_set_does_not_depend_on_other_texts():
    import numpy as np

    for seed in (14, 107, 213, 407, 437):
        draw = np.random.default_rng(seed)
        likelihood = np.full((1 << langmix.GRAM_BITS, 4), 1e-3, np.float32)
        likelihood[:12] = draw.choice([1.0, 0.3, 0.05], (12, 4)).astype(np.float32)
        model = langmix.Model(list("abcd"), likelihood)
        texts = [draw.choice(12, n) for n in (6, 14, 25, 40)]
        together = langmix.mixtures(model, np.repeat(np.arange(4), [len(t) for t in texts]), np.concatenate(texts), 4)
        alone = [langmix.mixtures(model, np.zeros(len(t), np.int64), t, 1)[0] for t in texts]
        assert np.allclose(together, alone, atol=1e-5)


def test_every_letter_counts(spark):
    texts = ["a", "1 2 x", "b 3", "é"]
    row, gram, letters = langmix._grams([*texts, None, "", "12"])
    assert row.tolist() == [0, 1, 2, 3] and letters.tolist() == [1, 1, 1, 1, 0, 0, 0]
    model = langmix.fit(docs(spark, "der hund und die katze").selectExpr("text", "'de' as lang"))
    assert {r.lang_pred for r in langmix.identify(docs(spark, *texts), model).collect()} == {"de"}
