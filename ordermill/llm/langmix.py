"""Language identification by mixtures of character trigram models.

``fit`` counts the trigrams of all training texts per language on the executors. ``identify`` treats a
text as a mixture: expectation-maximisation estimates the share of every language from the
likelihoods of its trigrams, then the sets made of the first k languages by share are compared by
likelihood less a penalty per language (half the logarithm of the number of trigrams), and the best
set is the text's. The prediction is the largest share of that set and the score is that share.

Trigrams are taken over lower-cased letters, with every run of other characters as one blank and a blank at
both ends, so that each letter is the middle of one.
Null text and text without a letter give ``und`` with score 0 and no set. Rows without text or
language are left out of training. With no training row at all every text is ``und``. Repeated rows
are judged one by one, other columns are not read, ties go to the language first in
alphabetical order, and an empty table gives an empty result. The model takes 256 KB a language, however many there are.

``accepted`` keeps the texts that their languages explain: those whose trigrams are likelier, on average, under the
mixture than if drawn evenly from all trigrams. Texts in several languages stay, noise and texts without a letter go.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices
from .shipping import ready

GRAM_BITS = 16
SMOOTHING = 0.1
ROUNDS = 12
UNKNOWN = "und"

_A, _B, _C = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
_folded: np.ndarray | None = None


def _fold_table() -> np.ndarray:
    """Lower-cased letter of every code point, 0 where it is no letter."""
    global _folded
    if _folded is None:
        table = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            if unicodedata.category(chr(point))[0] == "L":
                table[point] = ord(chr(point).lower()[0])
        _folded = table
    return _folded


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and trigram of every place, and the number of letters of each text."""
    lengths = np.array([len(t or "") + 2 for t in texts])
    joined = "".join(f" {t or ''} " for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _fold_table()[points]
    row = np.repeat(np.arange(len(texts)), lengths)
    letters = np.bincount(row[letter > 0], minlength=len(texts))
    held = letter > 0
    held[1:] |= letter[:-1] > 0
    held[np.cumsum(lengths) - lengths] = True
    letter, row = letter[held], row[held]
    if len(letter) < 3:
        return row[:0], letter[:0], letters
    gram = letter[:-2] * _A + letter[1:-1] * _B + letter[2:] * _C
    gram = (gram ^ (gram >> np.uint32(15))) * _B >> np.uint32(32 - GRAM_BITS)
    inner = (row[:-2] == row[2:]) & (letter[1:-1] > 0)
    return row[:-2][inner], gram[inner].astype(np.int64), letters


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, "text"):
            langs = part.column("lang").to_pylist()
            row, gram, _ = _grams(part.column("text").to_pylist())
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])
            for k, name in enumerate(names):
                if name not in totals:
                    totals[name] = np.zeros(1 << GRAM_BITS, np.int64)
                totals[name] += np.bincount(gram[code[row] == k], minlength=1 << GRAM_BITS)
    for name, counts in totals.items():
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(seen)), pa.array(seen, pa.int32()), pa.array(counts[seen])],
            names=["lang", "gram", "n"],
        )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [
            pa.array([np.asarray(x.values, dtype).tobytes() for x in batch.column(c)], pa.binary())
            for c, dtype in (("grams", np.int32), ("counts", np.int64))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), *columns], names=["lang", "grams", "counts"])


@dataclass
class Model:
    """Likelihood of each trigram per language, relative to ``mean``, its mean over the languages."""

    languages: list[str]
    likelihood: np.ndarray
    mean: np.ndarray | None = None


def fit(training: DataFrame) -> Model:
    """Model of all rows of ``training`` (text, lang).

    Only one row a language reaches the driver, and one at a time: its trigrams and their counts.
    """
    ready(training.sparkSession)
    rows = training.select(F.col("text").cast("string"), F.col("lang").cast("string")).dropna()
    sums = (
        rows.mapInArrow(_counted, "lang string, gram int, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list("gram").alias("grams"), F.collect_list("n").alias("counts"))
        .mapInArrow(_packed, "lang string, grams binary, counts binary")
    )
    shares = {}
    for lang, grams, counts in sums.toLocalIterator():
        share = np.full(1 << GRAM_BITS, SMOOTHING)
        share[np.frombuffer(grams, np.int32)] += np.frombuffer(counts, np.int64)
        shares[lang] = (share / share.sum()).astype(np.float32)
    # Texts too short for a trigram have a language all the same.
    for (lang,) in rows.select("lang").distinct().toLocalIterator():
        shares.setdefault(lang, np.full(1 << GRAM_BITS, 2.0**-GRAM_BITS, np.float32))
    languages = sorted(shares)
    if not languages:
        return Model([], np.ones((1 << GRAM_BITS, 0), np.float32), np.ones(1 << GRAM_BITS, np.float32))
    likelihood = np.stack([shares.pop(x) for x in languages], axis=1)
    mean = likelihood.mean(axis=1, dtype=np.float64).astype(np.float32)
    likelihood /= mean[:, None]
    return Model(languages, likelihood, mean)


def _step(part: np.ndarray, mix: np.ndarray, row: np.ndarray, n: np.ndarray, first: np.ndarray, total: np.ndarray):
    """Shares after one round, and the log-likelihood of the shares before it."""
    weighted = part * mix[row]
    whole = weighted.sum(axis=1)
    weighted *= (n / whole)[:, None]
    new = np.add.reduceat(weighted, first, axis=0) / total[:, None]
    return new, whole


def mixtures(model: Model, row: np.ndarray, gram: np.ndarray, rows: int):
    """Shares (rows by languages) in the chosen set, zero elsewhere; rows without a trigram are zero."""
    result = np.zeros((rows, len(model.languages)), np.float64)
    if not len(row) or not model.languages:
        return result
    key, n = np.unique((row.astype(np.int64) << GRAM_BITS) | gram, return_counts=True)
    row, n = key >> GRAM_BITS, n.astype(np.float32)
    part = model.likelihood[key & ((1 << GRAM_BITS) - 1)]
    present, first = np.unique(row, return_index=True)
    row = np.repeat(np.arange(len(present)), np.diff(np.append(first, len(row))))
    total = np.add.reduceat(n, first)
    size = len(model.languages)
    mix = np.full((len(present), size), 1 / size, np.float32)
    for _ in range(ROUNDS):
        mix, _ = _step(part, mix, row, n, first, total)
    order = np.argsort(-mix, axis=1, kind="stable")
    penalty = np.log(np.maximum(total, 2)) / 2
    best = np.full(len(present), -np.inf)
    chosen = np.zeros_like(mix)
    # No set explains a trigram better than its best language does; a text for which that is too little for k is done.
    bound = np.add.reduceat(n * np.log(np.maximum(part.max(axis=1), 1e-30)), first) + 1e-3 * total
    for k in range(1, size + 1):
        if not (bound - penalty * (k - 1) > best).any():
            break
        some = np.zeros_like(mix)
        np.put_along_axis(some, order[:, :k], np.maximum(np.take_along_axis(mix, order[:, :k], 1), 1e-6), 1)
        some /= some.sum(axis=1, keepdims=True)
        if k > 1:
            for _ in range(2):
                some, _ = _step(part, some, row, n, first, total)
        _, whole = _step(part, some, row, n, first, total)
        value = np.add.reduceat(n * np.log(np.maximum(whole, 1e-30)), first) - penalty * (k - 1)
        better = (value > best) & (bound - penalty * (k - 1) > best)
        best = np.where(better, value, best)
        chosen[better] = some[better]
    result[present] = chosen
    return result


def evidence(model: Model, mix: np.ndarray, row: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Mean log-likelihood of a trigram of each text under its mixture, less that of an even draw; 0 without trigrams."""
    whole = (model.likelihood[gram] * mix[row]).sum(axis=1) * model.mean[gram] * float(1 << GRAM_BITS)
    total = np.bincount(row, np.log(np.maximum(whole, 1e-30)), minlength=len(mix))
    return total / np.maximum(np.bincount(row, minlength=len(mix)), 1)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, and ``languages``: the chosen set as an array of (lang, share), largest first."""
    ready(docs.sparkSession)
    languages, likelihood = model.languages, model.likelihood
    shared = docs.sparkSession.sparkContext.broadcast((languages, likelihood))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                row, gram, letters = _grams(part.column("text").to_pylist())
                mix = mixtures(own, row, gram, part.num_rows)
                names, scores, sets = [], [], []
                for shares, n in zip(mix, letters):
                    order = [k for k in np.argsort(-shares, kind="stable") if shares[k] > 0]
                    if not n or not order:
                        names.append(UNKNOWN), scores.append(0.0), sets.append([])
                        continue
                    names.append(own.languages[order[0]])
                    scores.append(min(1.0, float(shares[order[0]])))
                    sets.append([{"lang": own.languages[k], "share": float(shares[k])} for k in order])
                kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, kind)],
                    names=["doc_id", "lang_pred", "score", "languages"],
                )

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(
        judged, "doc_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    )


def held_out(doc_id: str = "doc_id"):
    """Rows kept from training: the checksum of the id as text is divisible by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string")) % 5 == 0, F.lit(False))


def fit_labelled(docs: DataFrame) -> Model:
    """Model of all rows with a language that are not held out."""
    return fit(docs.where(~held_out() & F.col("lang").isNotNull()).select("text", "lang"))


def accepted(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose set of languages explains the text better than an even draw of trigrams, columns unchanged.

    The text is judged beside the row it belongs to, so that repeated ids and null ids keep
    their own verdict.
    """
    model = fit_labelled(docs)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.likelihood, model.mean))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                row, gram, letters = _grams(part.column("text").to_pylist())
                mix = mixtures(own, row, gram, part.num_rows)
                yield part.filter(pa.array((letters > 0) & (evidence(own, mix, row, gram) > 0)))

    return docs.mapInArrow(passing, docs.schema)
