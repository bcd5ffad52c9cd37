"""Phrase collocations counted by FM-indexes.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?]`` and line breaks, and pieces into words at blanks and tabs. Texts of one
language that a task reads are put together into shards of about ``SHARD_WORDS`` words. A shard numbers its words, puts a separator
after every piece and keeps the Burrows-Wheeler transform of that sequence and of its reverse, sorted to ``DEPTH`` words. There a phrase is an
interval in each; a backward step in one adds a word on the left and in the other one on the right, and keeps both in step. So
every phrase of up to ``DEPTH`` words comes with its count in the shard, and shard counts are summed.

Only phrases found ``least`` times in all can matter, and a phrase is never more frequent than its parts. Shards therefore extend
only words, then pairs, then triples that passed that limit. They are told by a bit table of fixed size for each length (``FILTER_BITS``): it may let
others through, which then fail the limit themselves, but never holds one back. Its size bounds what is broadcast, not what is counted; where
it fills up, more phrases are shuffled and the result is the same. Pairs and triples are summed by 80 bits of hashes, which a shard sends as
arrays, one for each of ``BUCKETS`` ranges of keys. A frequent phrase stands in most shards, so its text is told by one of them only, the one with the
smallest number that holds it; another bit table tells the shards what they are asked for. Phrases of ``DEPTH`` words, which few
shards share, are summed by their texts.

A candidate is a phrase of two words or more found ``least`` times. Each cut into two parts found l and r times gives
``scale * a // (l + r)``, exact beyond 64 bits, and the lowest is its score (ties: the shortest first part). It is dropped if some longer candidate that holds
it has ``COVERED`` percent of its count; the longer ones extend it by one word on the left or right at a time, so those decide.

Null texts count as empty and a null language as ``und``; a language without words is absent. Equal scores come by count, then by
phrase in byte order. Repeated rows count each. Other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .batches import _BYTE, _LOWER, _powers, bit_table, mixed, raw, slices
from .linking import kept
from .shipping import ready

DEPTH = 4
LEAST = 30
COVERED = 80
SCALE = 2_000_000
FIRST = 2000
SHARD_WORDS = 1 << 19
#: Bits of the table of the frequent phrases of one length; a power of two. 2 MB.
FILTER_BITS = 1 << 24
#: Shards of a Parquet row group.
GROUP = 2
#: Words that are hashed at once.
AT_ONCE = 1 << 15
#: Ranges of keys that a shard's counts are sent by.
BUCKET_BITS = 11
BUCKETS = 1 << BUCKET_BITS
#: Parts that a language's ranking is spread over.
SPREAD = 64

_NEXT = np.uint64(0x9E3779B97F4A7C15)
_LANG = np.uint64(0xD6E8FEB86659FD93)
_CHECK, _CHECK_NEXT = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?"]] = True
_BREAKS[0x0A:0x0E] = True
_BETWEEN = _BREAKS.copy()
_BETWEEN[[0x20, 0x09]] = True

_INDEX = pa.schema(
    [
        ("lang", pa.string()), ("shard", pa.int64()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())),
        ("left", pa.binary()), ("right", pa.binary()),
    ]
)
_COUNTED = pa.schema(
    [("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64()), ("key", pa.int64()), ("check", pa.int16()), ("shard", pa.int64())]
)


def pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word, whether a piece starts with it, and the lower-cased bytes with begin and end of each word."""
    data, offsets = raw(texts)
    data = _LOWER[data]
    inside = np.concatenate(([False], ~_BETWEEN[data], [False]))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, bool), data, start, end
    size = end - start
    held = data[inside[1:-1]]
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(len(held)) - np.repeat(begin, size)
    value = mixed(np.add.reduceat(_BYTE[held] * _powers(int(size.max()))[place], begin) + size.astype(np.uint64))
    breaks = np.concatenate(([0], np.cumsum(_BREAKS[data])))
    opens = np.ones(len(start), bool)
    opens[1:] = breaks[start[1:]] > breaks[end[:-1]]
    opens[np.searchsorted(start, offsets[:-1][offsets[:-1] <= start[-1]])] = True
    return value, opens, data, start, end


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    offsets = np.concatenate(([0], np.cumsum(size)))
    source = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data[source])).cast(pa.string())


def transform(sequence: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """What stands before each suffix, in the order of the suffixes' first ``depth`` numbers; the sequence is taken as a ring."""
    rank, reach = sequence.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while reach < depth:
        both = rank * (int(rank.max()) + 1) + np.roll(rank, -reach)
        order = np.argsort(both, kind="stable")
        new = np.concatenate(([0], np.cumsum(np.diff(both[order]) != 0)))
        rank[order] = new
        reach *= 2
    return np.roll(sequence, 1)[order].astype(np.int32)


class _Shard:
    """Texts of one language that are put together until there are enough words."""

    def __init__(self, lang: str | None):
        self.lang, self.n, self.values, self.opens, self.known = lang, 0, [], [], {}

    def add(self, texts: pa.Array) -> None:
        value, opens, data, start, end = pieces(texts)
        different, at = np.unique(value, return_index=True)
        new = np.array([v not in self.known for v in different.tolist()], bool)
        strings = _strings(data, start[at[new]], end[at[new]]).to_pylist()
        self.known.update(zip(different[new].tolist(), strings))
        self.values.append(value)
        self.opens.append(opens)
        self.n += len(value)

    def index(self) -> pa.RecordBatch:
        different, number, counts = np.unique(np.concatenate(self.values), return_inverse=True, return_counts=True)
        opens = np.flatnonzero(np.concatenate(self.opens))
        sequence = np.append(np.insert(number + 1, opens, 0), 0)  # separators are 0
        row = {
            "lang": self.lang, "shard": uuid.uuid4().int >> 65, "words": [self.known[v] for v in different.tolist()], "counts": counts.astype(np.int32),
            "left": transform(sequence).tobytes(), "right": transform(sequence[::-1]).tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], _INDEX)


def _indexed(shard_words: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, _Shard] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                langs = part.column("lang")
                for lang in pc.unique(langs).to_pylist():
                    shard = shards.setdefault(lang, _Shard(lang))
                    shard.add(part.filter(pc.equal(langs, lang)).column("text"))
                    if shard.n >= shard_words:
                        yield shards.pop(lang).index()
                    del shard
        for shard in shards.values():
            if shard.n:
                yield shard.index()

    return made


@dataclass
class Phrases:
    """Phrases of one length in a shard: their interval in both transforms, the numbers of their words, and two hashes of these words."""

    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    words: np.ndarray  # one row per phrase
    value: np.ndarray
    check: np.ndarray

    def where(self, chosen: np.ndarray) -> Phrases:
        return Phrases(*(x[chosen] for x in (self.left, self.right, self.size, self.words, self.value, self.check)))


class Index:
    """Bidirectional search over one shard."""

    def __init__(self, words: pa.Array, counts: np.ndarray, left: bytes, right: bytes):
        self.words, self.hashes = words, word_hashes(words)
        self.checks = mixed(self.hashes ^ _CHECK)
        self.before = {"left": np.frombuffer(left, np.int32), "right": np.frombuffer(right, np.int32)}
        self.counts = counts.astype(np.int64)
        self.step: dict[str, np.ndarray] = {}

    def single(self) -> Phrases:
        """All words: their intervals follow the one of the separator in both transforms."""
        separators = len(self.before["left"]) - int(self.counts.sum())
        begin = separators + np.concatenate(([0], np.cumsum(self.counts)[:-1])).astype(np.int64)
        return Phrases(begin, begin, self.counts, np.arange(len(self.counts), dtype=np.int32)[:, None], self.hashes, self.checks)

    def _rows(self, side: str) -> np.ndarray:
        """Row that a backward step leads to from each row."""
        if side not in self.step:
            order = np.argsort(self.before[side], kind="stable")
            self.step[side] = np.empty(len(order), np.int64)
            self.step[side][order] = np.arange(len(order))
        return self.step[side]

    def extended(self, phrases: Phrases, side: str) -> Phrases:
        """Phrases with one more word on the ``side`` whose other words on that side are among ``phrases`` too."""
        mine, other = (phrases.left, phrases.right) if side == "left" else (phrases.right, phrases.left)
        step, before = self._rows(side), self.before[side]
        owner = np.repeat(np.arange(len(mine)), phrases.size)
        ends = np.cumsum(phrases.size)
        rows = np.repeat(mine - (ends - phrases.size), phrases.size) + np.arange(len(owner))
        order = np.lexsort((before[rows], owner))
        owner, rows = owner[order], rows[order]
        added, to = before[rows], step[rows]
        opens = np.ones(len(rows), bool)
        opens[1:] = (np.diff(owner) != 0) | (np.diff(added) != 0)
        first = np.flatnonzero(opens)
        size = np.diff(np.append(first, len(rows)))
        owner, added, to = owner[first], added[first], to[first]
        # In the other transform an extension stands after those by smaller words.
        there = other[owner] + first - (ends - phrases.size)[owner]
        alive = np.zeros(len(before) + 1, np.int64)
        np.add.at(alive, mine, 1)
        np.add.at(alive, mine + phrases.size, -1)
        alive = np.cumsum(alive) > 0
        good = (added > 0) & alive[to]
        owner, added, to, there, size = (x[good] for x in (owner, added, to, there, size))
        one, words, value, check = added - 1, phrases.words[owner], phrases.value[owner], phrases.check[owner]
        if side == "left":
            value, check = self.hashes[one] + _NEXT * value, self.checks[one] + _CHECK_NEXT * check
            return Phrases(to, there, size, np.column_stack([one, words]), value, check)
        power, other_power = (np.uint64(pow(int(x), words.shape[1], 1 << 64)) for x in (_NEXT, _CHECK_NEXT))
        value, check = value + power * self.hashes[one], check + other_power * self.checks[one]
        return Phrases(there, to, size, np.column_stack([words, one]), value, check)

    def texts(self, phrases: Phrases) -> pa.Array:
        """The words of every phrase, joined by a blank."""
        parts = [self.words.take(pa.array(column)) for column in phrases.words.T]
        return pc.binary_join_element_wise(*parts, " ")


def word_hashes(words: pa.Array) -> np.ndarray:
    """64 bits of every word, the same in every task."""
    found = [np.zeros(0, np.uint64)]
    for begin in range(0, len(words), AT_ONCE):
        data, offsets = raw(words.slice(begin, AT_ONCE))
        size = np.diff(offsets)
        place = np.arange(len(data)) - np.repeat(offsets[:-1], size)
        value = _BYTE[data] * _powers(int(size.max()))[place]
        found.append(mixed(np.add.reduceat(value, offsets[:-1]) + size.astype(np.uint64)))
    return np.concatenate(found)


def _keys(lang: str, value: np.ndarray) -> np.ndarray:
    """Key that a phrase of a language is counted by before its text is known to matter."""
    return mixed(value + _LANG * word_hashes(pa.array([lang + " "]))).view(np.int64)


def _checks(check: np.ndarray) -> np.ndarray:
    """16 bits more, for phrases that have a key in common."""
    return (mixed(check) >> np.uint64(48)).astype(np.uint16).view(np.int16)


def _word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang")
        for lang in pc.unique(langs).to_pylist():
            some = batch.filter(pc.equal(langs, lang)).column("phrase")
            yield pa.RecordBatch.from_arrays([pa.array(_keys(lang, word_hashes(some)))], names=["key"])


def _inside(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    bit = keys & (64 * len(table) - 1)
    return (table[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)) == 1


def _passing(lang: str, phrases: Phrases, table: np.ndarray) -> Phrases:
    return phrases.where(_inside(_keys(lang, phrases.value), table))


def _levels(batch: pa.RecordBatch, tables: list) -> Iterator[tuple[Index, str, int, int, Phrases]]:
    """Phrases of 2 words up to one more than there are tables, made of phrases that pass theirs, for every shard of a batch."""
    for i in range(batch.num_rows):
        lang, shard = (batch.column(c)[i].as_py() for c in ("lang", "shard"))
        words, counts = (batch.column(c)[i].values for c in ("words", "counts"))
        index = Index(words, counts.to_numpy(), *(batch.column(c)[i].as_buffer() for c in ("left", "right")))
        found = index.single()
        for size, table in enumerate(tables, 2):
            found = index.extended(_passing(lang, found, table.value), "right" if size % 2 else "left")
            yield index, lang, shard, size, found


def _by_range(lang: str, shard: int, found: Phrases) -> pa.RecordBatch:
    """A shard's counts, one row per range of keys: the arrays of keys, checks and counts."""
    keys = _keys(lang, found.value).view(np.uint64)
    order = np.argsort(keys)
    keys = keys[order]
    bucket = (keys >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    offsets = pa.array(np.append(first, len(keys)).astype(np.int32))
    lists = (keys.view(np.int64), _checks(found.check[order]), found.size[order].astype(np.int32))
    columns = [pa.array(bucket[first]), pa.array(np.full(len(first), shard, np.int64)), *(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in lists)]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "shard", "keys", "checks", "counts"])


def _counted_keys(tables: list):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lang, shard, size, found in _levels(batch, tables):
                if size == len(tables) + 1:
                    yield _by_range(lang, shard, found)

    return made


def _told_phrases(tables: list, asked: list):
    """Texts: of phrases shorter than ``DEPTH``, those that the shard is asked for; of the others all, with their counts."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index, lang, shard, size, found in _levels(batch, tables):
                if size <= len(tables):
                    found = _passing(lang, found, tables[size - 1].value)
                    found = found.where(_inside(_keys(lang, found.value) ^ np.int64(shard), asked[size - 2].value))
                n = len(found.size)
                columns = [
                    pa.array([lang] * n, pa.string()), index.texts(found).cast(pa.string()), pa.array(np.full(n, size, np.int32)), pa.array(found.size),
                    pa.array(_keys(lang, found.value)), pa.array(_checks(found.check)), pa.array(np.full(n, shard, np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_COUNTED)

    return made


def _indexes(narrow: DataFrame, shard_words: int) -> DataFrame:
    """One row per shard, stored in row groups of few shards, so that a task reads no more of them than a file split has room for."""
    spark = narrow.sparkSession
    schema = "lang string, shard long, words array<string>, counts array<int>, left binary, right binary"
    path = fresh_path(spark, "index")
    narrow.mapInArrow(_indexed(shard_words), schema).write.option("parquet.block.row.count.limit", GROUP).parquet(path)
    return spark.read.schema(schema).parquet(path)


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, shard_words: int = SHARD_WORDS, filter_bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of up to ``DEPTH`` words found ``least`` times, and (lang, n), the words of each language."""
    spark = docs.sparkSession
    ready(spark)
    narrow = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string"))
    index = _indexes(narrow, shard_words)

    def summed(counted: DataFrame, size: Column) -> DataFrame:
        total = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), F.min(size).alias("size"))
        return total.where(F.col("f") >= least).select("lang", "phrase", "size", "f")

    single = index.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select(
        "lang", F.col("w.words").alias("phrase"), F.col("w.counts").cast("long").alias("f")
    )
    totals = single.groupBy("lang").agg(F.sum("f").alias("n"))
    words = kept(summed(single, F.lit(1)), "words")
    keys, tables, asked, sums = words.select("lang", "phrase").mapInArrow(_word_keys, "key long"), [], [], []
    while True:
        tables.append(spark.sparkContext.broadcast(bit_table(keys, filter_bits)))
        if len(tables) == DEPTH - 1:
            break
        counted = index.mapInArrow(_counted_keys(list(tables)), "bucket int, shard long, keys array<long>, checks array<short>, counts array<int>")
        each = counted.repartition("bucket").select("bucket", "shard", "checks", "counts", F.posexplode("keys").alias("i", "key")).select(
            "bucket", "shard", "key", F.get("checks", F.col("i")).alias("check"), F.get("counts", F.col("i")).cast("long").alias("f")
        )
        total = each.groupBy("bucket", "key", "check").agg(F.sum("f").alias("f"), F.min("shard").alias("shard"))
        keys = kept(total.where(F.col("f") >= least).select("key", "check", "shard", "f"), "keys")
        sums.append(keys.withColumn("size", F.lit(len(tables) + 1)))
        asked.append(spark.sparkContext.broadcast(bit_table(keys.select(F.expr("key ^ shard").alias("key")), filter_bits)))
    schema = "lang string, phrase string, size int, f long, key long, check short, shard long"
    told = kept(index.mapInArrow(_told_phrases(tables, asked), schema), "told")
    short = told.where(F.col("size") < DEPTH).drop("f").join(reduce(DataFrame.union, sums), ["size", "key", "check", "shard"])
    longest = summed(told.where(F.col("size") == DEPTH), F.col("size"))
    return reduce(DataFrame.union, [words, kept(short.select("lang", "phrase", "size", "f"), "longer"), kept(longest, "longest")]), totals


def _whole(name: str) -> Column:
    """A count as a decimal, so that products do not overflow."""
    return F.col(name).cast("decimal(20,0)")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    first: int = FIRST,
    scale: int = SCALE,
    covered: int = COVERED,
    shard_words: int = SHARD_WORDS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's ``first`` best phrases of ``docs`` (lang, text)."""
    frequent, totals = frequent_phrases(docs, least, shard_words, filter_bits)
    candidates = frequent.where("size > 1").withColumn("w", F.split("phrase", " "))
    cut = candidates.select("lang", "phrase", "w", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))

    def joined(begin: Column, n: Column) -> Column:
        return F.concat_ws(" ", F.slice("w", begin, n))

    cut = cut.withColumn("head", joined(F.lit(1), F.col("k"))).withColumn("tail", joined(F.col("k") + 1, F.size("w") - F.col("k")))
    left, right = (frequent.select("lang", F.col("phrase").alias(e), F.col("f").alias(c)) for e, c in (("head", "l"), ("tail", "r")))
    exact = f"cast(a as decimal(20,0)) * {scale} div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    valued = cut.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).withColumn("score", F.expr(exact))
    scored = valued.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = [joined(F.lit(1), F.size("w") - 1), joined(F.lit(2), F.size("w") - 1)]
    longer = (
        candidates.where("size > 2").select("lang", F.explode(F.array(*inner)).alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    )
    stays = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (_whole("longest") * 100 < _whole("a") * covered)
    )
    best = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))).orderBy(*best)
    ranked = stays.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= first)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )
