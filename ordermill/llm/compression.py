"""Quality rules: word, symbol and repetition counts, and bands of zstandard ratios.

``measure`` returns one row per input row. A ratio is compressed size over raw size in bytes. The whole
text and each of its chunks of ``CHUNK_BYTES`` are compressed; a last chunk under half that size is
judged with the one before it. The limits depend on the number of bytes judged, as short texts carry
the frame's cost: below the low limit a text is repetitive, above the high one it is incompressible.

Null text counts as empty: zero words, ratios null, base rule failed. Repeated rows are judged
one by one; other columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import SHINGLE, mixed, raw, slices, windows, words
from .shipping import ready

CHUNK_BYTES = 4096
LEVEL = 3
#: Upper size of a length class in bytes, lowest and highest ratio allowed in it.
BANDS = (
    (64, 0.0, 9.9),
    (256, 0.35, 1.25),
    (1024, 0.35, 0.90),
    (4096, 0.25, 0.80),
    (16384, 0.20, 0.75),
    (float("inf"), 0.15, 0.70),
)
FEWEST_WORDS = 10
REPEAT_PERCENT = 20

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bytes long, ratio double, chunk_low double, chunk_high double, band_failed boolean"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = " \t\n\v\f\r"


def _limits(size: int, bands) -> tuple[float, float]:
    return next((low, high) for most, low, high in bands if size <= most)


def _chunks(text: bytes) -> list[bytes]:
    cut = [text[i : i + CHUNK_BYTES] for i in range(0, len(text), CHUNK_BYTES)]
    if len(cut) > 1 and 2 * len(cut[-1]) < CHUNK_BYTES:
        cut[-2:] = [cut[-2] + cut[-1]]
    return cut


def ratios(text: bytes, press, bands=BANDS) -> tuple[float | None, float | None, float | None, bool]:
    """Ratio of the text, lowest and highest ratio of its chunks, and whether any is out of its band."""
    if not text:
        return None, None, None, False
    whole = len(press(text)) / len(text)
    parts = _chunks(text)
    each = [len(press(x)) / len(x) for x in parts] if len(parts) > 1 else [whole]
    low, high = _limits(len(text), bands)
    failed = not low <= whole <= high
    for part, ratio in zip(parts, each):
        low, high = _limits(len(part), bands)
        failed = failed or not low <= ratio <= high
    return whole, min(each), max(each), failed


def _repeated_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(_SPACE):
            seen.add(line)
    return n


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=LEVEL).compress
    for batch in batches:
        for part in slices(batch, "text"):
            texts = part.column("text")
            w = words(texts, lower=False)
            n = part.num_rows
            data, offsets = raw(texts)
            value, at = windows(w)
            salted = value ^ mixed(w.row[at].astype(np.uint64))
            _, which, times = np.unique(salted, return_inverse=True, return_counts=True)
            often = at[times[which] > 1]
            cover = np.zeros(len(w.row) + SHINGLE + 1, np.int64)
            np.add.at(cover, often, 1)
            np.add.at(cover, often + SHINGLE, -1)
            repeated = np.cumsum(cover)[: len(w.row)] > 0
            owner = np.repeat(np.arange(n), np.diff(offsets))
            rows = lambda mask: np.bincount(owner[mask], minlength=n)
            plain = [t or "" for t in texts.to_pylist()]
            pressed = [ratios(t.encode(), press) for t in plain]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(w.counts, pa.int64()),
                    pa.array(rows(w.inside & ((data & 0xC0) != 0x80)), pa.int64()),
                    pa.array(rows(_SYMBOL[data]), pa.int64()),
                    pa.array([_repeated_lines(t) for t in plain], pa.int64()),
                    pa.array(np.bincount(w.row[repeated], minlength=n), pa.int64()),
                    pa.array(np.diff(offsets), pa.int64()),
                    *(pa.array([p[i] for p in pressed], pa.float64()) for i in range(3)),
                    pa.array([p[3] for p in pressed], pa.bool_()),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )


def measure(docs: DataFrame) -> DataFrame:
    """Counts, ratios and the bands' verdict of every row's whole text."""
    ready(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(_measured, SCHEMA)


def base_failed() -> Column:
    return (F.col("n_words") < FEWEST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT
    )


def judge(docs: DataFrame) -> DataFrame:
    """Measured rows with ``base_failed`` and ``kept``."""
    return (
        measure(docs)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~F.col("band_failed"))
    )
