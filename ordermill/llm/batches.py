"""Words of Arrow string batches as numpy arrays.

Everything works on UTF-8 bytes: white space is ASCII only, so bytes of longer characters are never
mistaken for it. Batches are cut into slices of bounded size, one very long text being a slice alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 21
SLICE_ROWS = 1024
SHINGLE = 5

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Invertible 64-bit mix, so that all bits of the result depend on all bits of ``x``."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


def slices(batch: pa.RecordBatch, column: str, most: int | None = None, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``SLICE_BYTES`` of text and ``SLICE_ROWS`` rows unless told otherwise, or of one row."""
    most, rows = most or SLICE_BYTES, rows or SLICE_ROWS
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first = 0
    total = 0
    for i, size in enumerate(sizes):
        if i > first and (total + size > most or i - first >= rows):
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += size
    if first < batch.num_rows:
        yield batch.slice(first)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each text starts and the last ends; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of several texts: text each belongs to, byte range, 64-bit hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    value: np.ndarray
    counts: np.ndarray
    data: np.ndarray
    inside: np.ndarray


def words(texts: pa.Array, lower: bool) -> Words:
    data, offsets = raw(texts)
    n = len(offsets) - 1
    inside = ~_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    first = inside & (~before | edge[:-1])
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    last = inside & (~after | edge[1:])
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    counts = np.bincount(row, minlength=n)
    size = end - start
    if len(start):
        held = data[inside]
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        place = np.arange(len(held)) - np.repeat(begin, size)
        value = _BYTE[(_LOWER if lower else _SAME)[held]] * _powers(int(size.max()))[place]
        value = mixed(np.add.reduceat(value, begin) + size.astype(np.uint64))
    else:
        value = np.zeros(0, np.uint64)
    return Words(row, start, end, value, counts, data, inside)


def windows(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of five words of one text, and the index of its first word."""
    n = len(w.value) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = sum(w.value[k : n + k] * _PLACE[k] for k in range(SHINGLE))
    at = np.flatnonzero(w.row[:n] == w.row[SHINGLE - 1 :])
    return mixed(value[at]), at


def shingle_sets(w: Words) -> list[np.ndarray]:
    """Sorted distinct five-word shingles of each text; fewer words make one shingle, none an empty set."""
    value, at = windows(w)
    rows = w.row[at]
    bounds = np.searchsorted(rows, np.arange(len(w.counts) + 1))
    firsts = np.concatenate(([0], np.cumsum(w.counts)))
    sets = []
    for i, n in enumerate(w.counts):
        if n >= SHINGLE:
            sets.append(np.unique(value[bounds[i] : bounds[i + 1]]))
        elif n:
            short = w.value[firsts[i] : firsts[i + 1]] * _PLACE[:n]
            sets.append(mixed(short.sum(keepdims=True) + np.array([n], np.uint64) * _STEP))
        else:
            sets.append(value[:0])
    return sets


def bit_table(keys: DataFrame, bits: int) -> np.ndarray:
    """Bit table of the 64-bit numbers ``key``: a fixed size, whatever their number."""
    at = F.expr(f"shiftright(key & {bits - 1}L, 6)").alias("at")
    found = keys.groupBy(at).agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63L as int))")).alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table
