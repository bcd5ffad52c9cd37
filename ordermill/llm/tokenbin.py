"""Binary token files with a minimal perfect hash index.

A dataset is a folder:

- ``payload/``: raw ids, little-endian, two bytes each if the vocabulary fits and four otherwise, documents one after the
  other in ascending doc_id order, each closed by the end id; one file per range of ids.
- ``index/``: one file per hash class of keys. It has a header (magic, number of keys, number of buckets), the
  end of every bucket, the two displacements of every group and one slot per key: fingerprint, payload
  shard, offset, number of ids. A key's bucket, group and slot follow from its hash and the displacements (hash,
  displace, and no slot is empty), so a lookup reads one slot; the stored fingerprint tells unknown keys.
- ``documents/``: Parquet, the keys with their shards as written; ``shards/``: Parquet, the file, size and first
  position of every shard.

Payload files are named by task attempt, and ``documents`` names those of the attempts that were committed, so lost
executors and repeated tasks leave at most unused files. Workers write with Arrow's file systems to the folder's URI.

A key is a doc_id and the ordinal among the rows with that id (ties by text, so repeated rows have
ordinals 0, 1, ...). Rows without doc_id come first. Null and empty texts are the end id alone. Other columns
are not read; an empty table gives a dataset without files.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .batches import mixed, slices
from .shipping import ready
from .tokens import LIST_BYTES, LIST_ROWS, encoder, public_path

END = 0
MAGIC = b"TBX1"
KEYS_PER_FILE = 1 << 17
KEYS_PER_BUCKET = 2048
KEYS_PER_GROUP = 4

_HEADER = np.dtype([("magic", "S4"), ("width", "<u4"), ("keys", "<u8"), ("buckets", "<u8")])
_SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("count", "<u8")])
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _open(uri: str, write: bool):
    system, path = fs.FileSystem.from_uri(uri)
    if write:
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(path)
    return system.open_input_file(path)


def key_hash(doc_id: Column, ordinal: Column) -> Column:
    return F.xxhash64(doc_id, doc_id.isNull(), ordinal)


# The index of one file.

def _parts(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return tuple(mixed(hashes ^ s) for s in _SALTS)


def _groups(n: int) -> int:
    return max(1, n // KEYS_PER_GROUP)


def displace(first: np.ndarray, second: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Displacements (groups by 2) that send n keys to n different slots.

    A key of a group with displacements (a, b) goes to slot (first + a * second + b) mod n.
    """
    n = len(first)
    groups = _groups(n)
    result = np.zeros((groups, 2), np.uint32)
    taken = np.zeros(2 * n, bool)  # twice over, so that no slot needs a remainder
    sizes = np.bincount(group, minlength=groups)
    members = np.split(np.argsort(group, kind="stable"), np.cumsum(sizes)[:-1])
    free_at = 0
    for g in np.argsort(-sizes, kind="stable"):
        own = members[g]
        if len(own) == 0:
            break
        for a in range(1 << 20):
            at = (first[own] + np.uint64(a) * second[own]) % np.uint64(n)
            at = at.astype(np.int64)
            if len(own) == 1:
                while taken[free_at]:
                    free_at += 1
                b = (free_at - at[0]) % n
                break
            if len(np.unique(at)) < len(at):
                continue
            clash = taken[at[0] : at[0] + n].copy()
            for x in at[1:]:
                clash |= taken[x : x + n]
            b = int(np.argmin(clash))
            if not clash[b]:
                break
        else:
            raise RuntimeError("equal keys in one index")
        place = (at + b) % n
        taken[place] = True
        taken[place + n] = True
        result[g] = a, b
    return result


def build_index(hashes: np.ndarray, slots: np.ndarray, width: int) -> bytes:
    """Index file of distinct key hashes and their slots (shard, offset, count)."""
    where, first, second, stamp = _parts(hashes)
    buckets = max(1, len(hashes) // KEYS_PER_BUCKET)
    bucket = (where % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets)).astype("<u8")
    table = np.zeros(len(hashes), _SLOT)
    moves = []
    for begin, end in zip(np.concatenate(([0], ends[:-1])).astype(int), ends.astype(int)):
        own = order[begin:end]
        if not len(own):
            continue
        group = ((where[own] >> np.uint64(32)) % np.uint64(_groups(len(own)))).astype(np.int64)
        move = displace(first[own], second[own], group)
        moves.append(move)
        a, b = move[group].astype(np.uint64).T
        at = ((first[own] + a * second[own]) % np.uint64(len(own)) + b) % np.uint64(len(own))
        slot = begin + at.astype(np.int64)
        table["print"][slot] = stamp[own] & np.uint64(0xFFFFFFFF)
        for name in ("shard", "offset", "count"):
            table[name][slot] = slots[name][own]
    header = np.array([(MAGIC, width, len(hashes), buckets)], _HEADER)
    moves = np.concatenate(moves) if moves else np.zeros((0, 2), np.uint32)
    return header.tobytes() + ends.tobytes() + moves.astype("<u4").tobytes() + table.tobytes()


def find(index: bytes, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the keys, and which of them the index knows."""
    header = np.frombuffer(index, _HEADER, 1)[0]
    if header["magic"] != MAGIC:
        raise ValueError("not an index file")
    at = _HEADER.itemsize
    ends = np.frombuffer(index, "<u8", int(header["buckets"]), at).astype(np.int64)
    at += ends.nbytes
    begins = np.concatenate(([0], ends[:-1]))
    sizes = ends - begins
    groups = np.where(sizes > 0, np.maximum(1, sizes // KEYS_PER_GROUP), 0)
    moves = np.frombuffer(index, "<u4", int(2 * groups.sum()), at).reshape(-1, 2)
    table = np.frombuffer(index, _SLOT, int(header["keys"]), at + moves.nbytes)
    where, first, second, stamp = _parts(hashes)
    bucket = (where % np.uint64(len(ends))).astype(np.int64)
    known = sizes[bucket] > 0
    n = np.maximum(sizes[bucket], 1).astype(np.uint64)
    group = (np.cumsum(groups) - groups)[bucket] + ((where >> np.uint64(32)) % np.maximum(groups[bucket], 1).astype(np.uint64)).astype(np.int64)
    group = np.where(known, group, 0)
    a, b = moves[group].astype(np.uint64).T if len(moves) else np.zeros((2, len(hashes)), np.uint64)
    slot = begins[bucket] + ((first + a * second) % n + b) % n
    slot = np.where(known, slot, 0).astype(np.int64)
    found = table[slot] if len(table) else np.zeros(len(hashes), _SLOT)
    return found, known & (found["print"] == (stamp & np.uint64(0xFFFFFFFF)))


# Writing.

def _payload_writer(folder: str, tokenizer: str):
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = encoder(tokenizer)
        kind = np.dtype(f"<u{texts.width}")
        shard = TaskContext.get().partitionId()
        name = f"{folder}/payload/ids-{shard:06d}-{uuid.uuid4().hex}"
        out, offset, last, ordinal = None, 0, None, -1
        for batch in batches:
            for part in slices(batch, "text", LIST_BYTES, LIST_ROWS):
                ids, counts = texts.encode(part.column("text"))
                whole = np.insert(ids, np.cumsum(counts), END)
                counts = counts + 1
                out = out or _open(name, write=True)
                out.write(whole.astype(kind).tobytes())
                ordinals = []
                for key in part.column("doc_id").to_pylist():
                    ordinal = ordinal + 1 if ordinal >= 0 and key == last else 0
                    last = key
                    ordinals.append(ordinal)
                offsets = offset + np.cumsum(counts) - counts
                offset += int(counts.sum())
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(ordinals, pa.int64()), pa.array([shard] * n, pa.int32()),
                        pa.array([name] * n), pa.array(offsets), pa.array(counts), pa.array([kind.itemsize] * n, pa.int32()),
                    ],
                    names=["doc_id", "ordinal", "shard", "file", "offset", "n_tokens", "width"],
                )
        if out:
            out.close()

    return written


def write(docs: DataFrame, folder: str, tokenizer: str | None = None) -> str:
    """Encodes all rows of ``docs`` (doc_id, text) into a new dataset at ``folder``, a URI every executor reaches."""
    spark = docs.sparkSession
    ready(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(
        _payload_writer(folder, tokenizer or public_path()),
        "doc_id long, ordinal long, shard int, file string, offset long, n_tokens long, width int",
    ).write.parquet(f"{folder}/documents")
    entries = spark.read.parquet(f"{folder}/documents")
    # One row per shard; their running sum is the only step that is not spread.
    shards = entries.groupBy("shard").agg(
        F.first("file").alias("file"), F.first("width").alias("width"), F.sum("n_tokens").alias("n_ids"),
        F.count("*").alias("n_docs"),
    )
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.withColumn("base", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0))).write.parquet(f"{folder}/shards")
    files = 1 + spark.read.parquet(f"{folder}/shards").agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0] // KEYS_PER_FILE

    def index(table: pa.Table) -> pa.Table:
        slots = np.zeros(table.num_rows, _SLOT)
        for name, column in (("shard", "shard"), ("offset", "offset"), ("count", "n_tokens")):
            slots[name] = table.column(column).to_numpy()
        hashes = table.column("hash").to_numpy().astype(np.int64).view(np.uint64)
        number = table.column("number")[0].as_py()
        name = f"{folder}/index/keys-{number:06d}-{uuid.uuid4().hex}"
        with _open(name, write=True) as out:
            out.write(build_index(hashes, slots, table.column("width")[0].as_py()))
        return pa.table({"number": pa.array([number], pa.int64()), "file": [name], "n_keys": pa.array([table.num_rows], pa.int64())})

    hashed = key_hash(F.col("doc_id"), F.col("ordinal"))
    (
        entries.select(hashed.alias("hash"), "shard", "offset", "n_tokens", "width")
        .withColumn("number", F.pmod("hash", F.lit(files)).cast("long"))
        .groupBy("number").applyInArrow(index, "number long, file string, n_keys long")
        .write.parquet(f"{folder}/indexes")
    )
    return folder


# Reading.

def lookup(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Places of the keys (doc_id, ordinal) by the index: with shard, offset and n_tokens; unknown keys are left out."""
    ready(spark)
    indexes = spark.read.parquet(f"{folder}/indexes").select("number", "file")
    total = spark.read.parquet(f"{folder}/shards").agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    number = F.pmod("hash", F.lit(1 + total // KEYS_PER_FILE)).cast("long")
    asked = keys.select("doc_id", "ordinal", key_hash(F.col("doc_id"), F.col("ordinal")).alias("hash"))
    asked = asked.withColumn("number", number).join(indexes, "number")

    def placed(table: pa.Table) -> pa.Table:
        with _open(table.column("file")[0].as_py(), write=False) as source:
            content = source.read()
        slots, known = find(content, table.column("hash").to_numpy().astype(np.int64).view(np.uint64))
        columns = {c: table.column(c) for c in ("doc_id", "ordinal")}
        columns |= {n: pa.array(slots[c].astype(np.int64)) for n, c in (("shard", "shard"), ("offset", "offset"), ("n_tokens", "count"))}
        return pa.table(columns).filter(pa.array(known))

    return asked.groupBy("number").applyInArrow(
        placed, "doc_id long, ordinal long, shard long, offset long, n_tokens long"
    )


def _read_shards(spark: SparkSession, folder: str, keys: DataFrame, schema: str, make) -> DataFrame:
    shards = spark.read.parquet(f"{folder}/shards").select("shard", "file", "width", "base")
    places = lookup(spark, folder, keys).join(shards, "shard")

    def reading(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        width = table.column("width")[0].as_py()
        results = []
        with _open(table.column("file")[0].as_py(), write=False) as source:
            for offset, n in zip(table.column("offset").to_pylist(), table.column("n_tokens").to_pylist()):
                results.append(make(np.frombuffer(source.read_at(n * width, offset * width), f"<u{width}")))
        start = np.add(table.column("base").to_numpy(), table.column("offset").to_numpy())
        return pa.table({
            "doc_id": table.column("doc_id"), "ordinal": table.column("ordinal"), "start": pa.array(start),
            "n_tokens": table.column("n_tokens"), "found": pa.array(results, pa.list_(pa.int32()) if "array" in schema else pa.int64()),
        })

    return places.groupBy("shard", F.floor(F.col("offset") / (1 << 22))).applyInArrow(
        reading, f"doc_id long, ordinal long, start long, n_tokens long, found {schema}"
    )


def read(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """doc_id, ordinal, start, n_tokens and ids of the given keys, read from the payload files."""
    return _read_shards(spark, folder, keys, "array<int>", lambda ids: ids.astype(np.int32)).withColumnRenamed("found", "ids")


def checksums(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """As ``read``, with the checksum of the ids as four-byte numbers in their place."""
    return _read_shards(spark, folder, keys, "long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes())).withColumnRenamed("found", "ids_crc32")


def keys_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents").select("doc_id", "ordinal")
