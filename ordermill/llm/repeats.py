"""Removal of passages that stand earlier in the corpus, by windows of doubling length.

Words are runs of characters other than ASCII white space, unchanged. A window is ``least`` consecutive words of one document;
the words of a window whose sequence also starts earlier (in a document before it, or at a smaller place of the same one) are removed. All
windows are judged on the input.

The search starts with short windows, of ``least`` halved until ``SHORTEST`` words at most, and doubles them. At each length a window of ``least``
words is stood for by its anchor, the inner window of that length with the smallest hash: equal windows have equal anchors at the
same place, so only a sixteenth to a fifth of all places has to be counted. Neighbouring windows with one anchor make a block. A block
whose whole content stands earlier is decided. One whose anchor stands nowhere else, or only with the same content, holds no other repeat.
The rest, first blocks whose anchor also stands in other surroundings, survives and is cut anew with anchors of twice the length,
until none survives; at full length each window is its own anchor. The first place of every sequence is never decided away, so
no repeat is lost.

Equal blocks of one slice of texts are settled before anything is shuffled, so that a passage in a large share of all documents sends one
row a slice. Anchors and contents are compared as two independent 64-bit hashes, 128 bits together.

Null texts and texts without words have no words and give an empty text. Documents come in order of doc_id, those without one last; rows that
share a doc_id or have none are ordered by a hash of their text, and equal ones among them count as one document, so that a repeated row
alone removes nothing. Ties cannot arise otherwise. Other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import Words, mixed, slices, words
from .linking import kept
from .shipping import ready

LEAST = 20
SHORTEST = 5
#: Windows whose anchors are sought at once.
AT_ONCE = 1 << 16

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LENGTH = np.uint64(0x165667B19E3779F9)
_NO_ID = (1 << 63) - 1
_BLOCK = pa.schema(
    [("key", pa.int64()), ("content", pa.int64()), ("doc", pa.int64()), ("part", pa.int64()),
     ("first", pa.int32()), ("last", pa.int32()), ("seen", pa.bool_())]
)
_BLOCKS = "key long, content long, doc long, part long, first int, last int, seen boolean"


def lengths(least: int) -> list[int]:
    """Window lengths from short to ``least``, each at most twice the one before."""
    found = [least]
    while found[0] > SHORTEST:
        found.insert(0, (found[0] + 1) // 2)
    return found


class _Sums:
    """Hashes of runs of words as differences of prefix sums of a polynomial."""

    def __init__(self, value: np.ndarray, base: int):
        n = len(value) + 1
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        back = np.full(n, pow(base, -1, 1 << 64), np.uint64)
        back[0] = 1
        self.back = np.multiply.accumulate(back)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(value * np.multiply.accumulate(powers)[:-1], out=self.sums[1:])

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[first]) * self.back[first] + (end - first).astype(np.uint64) * _LENGTH)


def _anchors(value: np.ndarray, starts: np.ndarray, inner: int) -> np.ndarray:
    """Place of the smallest of the ``inner`` values from each start on; the first of equal ones."""
    if inner == 1 or not len(starts):
        return starts
    view = sliding_window_view(value, inner)
    found = [view[part].argmin(axis=1) for part in np.array_split(starts, len(starts) // AT_ONCE + 1)]
    return starts + np.concatenate(found)


def _starts(w: Words, least: int, ranges: pa.Array | None) -> np.ndarray:
    """Words that a window starts with, within the ranges of each text if given."""
    n = len(w.value) - least + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    whole = w.row[:n] == w.row[least - 1 :]
    if ranges is not None:
        begin = np.repeat(np.concatenate(([0], np.cumsum(w.counts)[:-1])), ranges.value_lengths().to_numpy())
        pairs = ranges.flatten()
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, begin + pairs.field("first").to_numpy(), 1)
        np.add.at(change, begin + pairs.field("last").to_numpy() + 1, -1)
        whole &= np.cumsum(change)[:-1] > 0
    return np.flatnonzero(whole)


def _block_rows(part: pa.RecordBatch, length: int, least: int) -> pa.RecordBatch:
    w = words(part.column("text"), lower=False)
    ranges = part.column("ranges") if "ranges" in part.schema.names else None
    starts = _starts(w, least, ranges)
    if not len(starts):
        return pa.RecordBatch.from_pylist([], _BLOCK)
    one, two = (_Sums(w.value, b) for b in _BASES)
    inner = np.arange(len(w.value) - length + 1)
    short = one.of(inner, inner + length)
    at = _anchors(short, starts, least - length + 1)
    opens = np.ones(len(starts), bool)
    opens[1:] = (np.diff(starts) != 1) | (np.diff(at) != 0)
    first = starts[opens]
    last = starts[np.append(np.flatnonzero(opens)[1:] - 1, len(starts) - 1)]
    key, content = short[at[opens]], two.of(first, last + least)

    row = w.row[first]
    doc, copy = (part.column(c).to_numpy() for c in ("doc", "part"))
    order = np.lexsort((first, copy[row], doc[row], content, key))
    begin = np.concatenate(([0], np.cumsum(w.counts)[:-1]))
    doc, copy, first, last = doc[row], copy[row], first - begin[row], last - begin[row]
    group = np.ones(len(order), bool)
    group[1:] = (np.diff(key[order]) != 0) | (np.diff(content[order]) != 0)
    lead = order[np.flatnonzero(group)[np.cumsum(group) - 1]]
    seen = np.zeros(len(order), bool)
    seen[order] = (doc[order] != doc[lead]) | (copy[order] != copy[lead]) | (first[order] != first[lead])
    # What is decided here meets nothing more, and is spread evenly.
    key = np.where(seen, mixed(content ^ first.astype(np.uint64) ^ doc.view(np.uint64)), key)
    columns = [key.view(np.int64), content.view(np.int64), doc, copy, first.astype(np.int32), last.astype(np.int32)]
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(seen)], schema=_BLOCK)


def _blocked(length: int, least: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _block_rows(part, length, least)

    return made


def _judged(blocks: DataFrame) -> DataFrame:
    """Blocks that are decided (``seen``) or survive; one shuffle, by anchor."""
    new = ~F.col("seen")
    alike = Window.partitionBy("key")
    same = Window.partitionBy("key", "content")
    place = F.struct("doc", "part", "first")
    return (
        blocks.withColumn("least", F.min(F.when(new, F.col("content"))).over(alike))
        .withColumn("most", F.max(F.when(new, F.col("content"))).over(alike))
        .withColumn("lead", F.min(F.when(new, place)).over(same))
        .withColumn("seen", F.col("seen") | (place > F.col("lead")))
        .where(F.col("seen") | (F.col("least") != F.col("most")))
        .select("doc", "part", "first", "last", "seen")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with the number and the part that a document is known by."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    again = kept(narrow.groupBy("doc_id").count().where("doc_id IS NOT NULL AND count > 1").select("doc_id"), "repeated-ids")
    unclear = F.col("again") | F.col("doc_id").isNull() | (F.col("doc_id") == _NO_ID)
    return (
        narrow.join(again.withColumn("again", F.lit(True)), "doc_id", "left")
        .withColumn("doc", F.coalesce("doc_id", F.lit(_NO_ID)))
        .withColumn("part", F.when(unclear, F.xxhash64("text")).otherwise(F.lit(0)).cast("long"))
        .drop("again")
    )


def _by_document(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("doc", "part").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def spans(keyed: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc, part, first, last): windows from word ``first`` to ``last`` that stand earlier."""
    decided, open_ = [], None
    for length in lengths(least):
        texts = keyed if open_ is None else keyed.join(_by_document(open_), ["doc", "part"])
        judged = kept(_judged(texts.drop("doc_id").mapInArrow(_blocked(length, least), _BLOCKS)), f"blocks-{length}")
        decided.append(judged.where("seen"))
        open_ = judged.where("NOT seen")
        if open_.isEmpty():
            break
    found = decided[0]
    for more in decided[1:]:
        found = found.union(more)
    return found.drop("seen")


def _stripped(least: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column("text"), lower=False)
                n, total = part.num_rows, len(w.value)
                ranges = part.column("ranges")
                sizes = ranges.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                begin = np.repeat(np.concatenate(([0], np.cumsum(w.counts)[:-1])).astype(np.int64), sizes)
                pairs, change = ranges.flatten(), np.zeros(total + 1, np.int64)
                np.add.at(change, begin + pairs.field("first").to_numpy(), 1)
                np.add.at(change, begin + pairs.field("last").to_numpy() + least, -1)
                stays = np.flatnonzero(np.cumsum(change)[:-1] == 0)
                left = np.bincount(w.row[stays], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(w.counts), pa.array(w.counts - left), _joined(w, stays, left)],
                    names=["doc_id", "n_words", "n_removed", "text"],
                )

    return made


def _joined(w: Words, stays: np.ndarray, left: np.ndarray) -> pa.Array:
    """Chosen words of each text, joined by one blank."""
    size = w.end[stays] - w.start[stays] + 1  # with a blank after each
    ends = np.cumsum(size)
    source = np.repeat(w.start[stays] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    out = np.append(w.data, np.uint8(32))[source]
    out[ends - 1] = 32
    text_end = np.concatenate(([0], ends))[np.cumsum(left)]
    full = text_end[left > 0] - 1  # the blank after a text's last word goes
    out = np.delete(out, full)
    offsets = np.concatenate(([0], text_end - np.cumsum(left > 0)))
    return pa.LargeStringArray.from_buffers(len(left), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def dedup(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, n_removed and text, the words that stay joined by one blank, for every row of ``docs`` (doc_id, text)."""
    if least < 1:
        raise ValueError("a window has one word at least")
    ready(docs.sparkSession)
    keyed = _keyed(docs)
    texts = keyed.join(_by_document(spans(keyed, least)), ["doc", "part"], "left").select("doc_id", "text", "ranges")
    return texts.mapInArrow(_stripped(least), "doc_id long, n_words long, n_removed long, text string")
