"""Near-duplicate documents by HyperMinHash.

Words are runs of non-white bytes with A-Z lower-cased; a document is the set of its distinct five-word
shingles. The shingles are dealt over ``REGISTERS`` buckets by hash, and a bucket keeps the smallest
second hash in 16 bits: the number of leading zeros (6 bits) and the 10 bits after the leading one.
Empty buckets are filled from the next full one, the registers are cut into ``BANDS`` bands, and documents
that share a band are candidates. Their Jaccard estimate is the share of equal registers less the number
expected to be equal by chance; candidates whose estimate is six standard errors below the threshold are
left, all others are verified on the full sets.

Families of look-alikes below the threshold, whose members share bands without being linked, are searched again by
an exact prefix filter: shingles are ordered by how many of these documents hold them, and a document of n shingles is
listed under the rarest n less the least overlap plus one, each with the number of shingles from it on. Two sets at the threshold share
one of those, and from the first that they share on both have as many shingles as their overlap must have; pairs for which that does not
hold at any common shingle are not compared. So this step loses no pair, and members that each differ from all others in more than the
threshold allows are not compared with each other, whatever they have in common.

The number of bands follows the threshold (40 at 0.85, 70 at 0.80), so that a pair of large documents
at it shares no band with probability ``MISS``, and less above it. In a document of
fewer shingles than registers a band rests on fewer shingles, down to one.

Results per row of the input: a null or blank text has no shingle and is linked with nothing; a text of one
to four words has one shingle, its word sequence. Rows that share a doc_id are judged each
by its own text, and ``one_of_each`` removes them only if none is kept. A row without doc_id that equals no
other text has a null component and is kept; otherwise it follows the equal text. Ties cannot arise, as the
smallest id is kept. Other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import bit_table, mixed, shingle_sets, slices, words
from .linking import Gathered, Verify, connect, ends_joined, kept, stored
from .shipping import ready

BANDS, BAND_SIZE = 40, 8  # at the default threshold; the estimate always rests on this many registers
MISS = 3e-6
REGISTERS = BANDS * BAND_SIZE
MANTISSA = 10
#: Nodes whose ids are sent to the tasks that read their texts; of more, a bit table of 2 MB.
FEW_NODES, NODE_BITS = 1 << 15, 24
PERCENT = 85
SIGMAS = 6.0
#: Constant of the published approximation of accidental register collisions.
COLLISION = 0.169919487159739

_SECOND = np.uint64(0x2545F4914F6CDD1D)
_rng = np.random.default_rng(7)
_BAND = _rng.integers(1, 2**63, BAND_SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHOICE = np.arange(REGISTERS).reshape(BANDS, BAND_SIZE)


def bands_for(percent: int) -> int:
    """Bands by which a pair at the threshold is missed with probability ``MISS`` at most."""
    if percent >= 100:
        return 1
    if percent <= 0:
        raise ValueError("the threshold must be above 0 percent")
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** BAND_SIZE)))


def registers(shingles: list[np.ndarray], size: int = REGISTERS) -> np.ndarray:
    """Compressed registers of each set, 0 where the bucket is empty."""
    n = len(shingles)
    sizes = np.array([len(s) for s in shingles], np.int64)
    value = np.concatenate(shingles) if n else np.zeros(0, np.uint64)
    bucket = ((value >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
    least = np.full(n * size, np.iinfo(np.uint64).max, np.uint64)
    second = mixed(value ^ _SECOND) >> np.uint64(11)  # 53 bits, exact as a float
    np.minimum.at(least, np.repeat(np.arange(n), sizes) * size + bucket, second)
    full = least != np.iinfo(np.uint64).max
    kept = least[full]
    width = np.frexp(kept.astype(np.float64))[1].astype(np.uint64)  # position of the leading one
    zeros = np.uint64(53) - width
    lead = (kept << zeros) >> np.uint64(52 - MANTISSA)
    result = np.zeros(n * size, np.uint16)
    result[full] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA) | (lead & np.uint64((1 << MANTISSA) - 1))).astype(np.uint16)
    return result.reshape(n, size)


def band_keys(regs: np.ndarray, choice: np.ndarray = _CHOICE) -> np.ndarray:
    """One 64-bit key per band, a choice of registers; all rows without a full register get the same keys."""
    size = regs.shape[1]
    place = np.where(regs > 0, np.arange(size), 2 * size)
    after = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1]
    source = np.where(after < 2 * size, after, after[:, :1]) % size
    filled = mixed(np.take_along_axis(regs, source, axis=1).astype(np.uint64) + np.uint64(1))
    keys = np.zeros((len(regs), len(choice)), np.uint64)
    for k in range(choice.shape[1]):
        keys += mixed(filled[:, choice[:, k]] * _BAND[k])
    return mixed(keys + np.arange(len(choice), dtype=np.uint64) * _SECOND).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of register rows, and the number of registers it rests on."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    equal = ((a == b) & (a > 0)).sum(axis=1)
    ratio = np.minimum(n_a, n_b) / np.maximum(np.maximum(n_a, n_b), 1)
    chance = COLLISION * REGISTERS * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return np.clip((equal - chance) / np.maximum(used, 1), 0, 1), used


def _fingerprint(s: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    both = np.array([mixed(s ^ np.uint64(c)).sum(dtype=np.uint64) for c in (1, 3)], np.uint64)
    return (both + np.array([len(s)], np.uint64)).tobytes()


def _sketched(percent: int):
    count = bands_for(percent)
    choice = np.arange(count * BAND_SIZE).reshape(count, BAND_SIZE)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(words(part.column("text"), lower=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_fingerprint(s) for s in sets], pa.binary()),
                        _listed(band_keys(registers(sets, choice.size), choice)),
                    ],
                    names=["doc_id", "n_shingles", "set_id", "bands"],
                )

    return made


def _listed(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, (len(rows) + 1) * rows.shape[1], rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def _per_node(column: str, make):
    """Batches of (node, n, column) from batches of (doc_id, text); if a bit table of ids is given, for rows inside only."""
    def reading(table=None):
        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if table is not None:
                    ids = batch.column("doc_id")
                    known = pc.is_valid(ids)
                    asked = _inside(pc.fill_null(ids, 0).to_numpy(), table.value)
                    batch = batch.filter(pc.and_(known, pa.array(asked)))
                for part in slices(batch, "text"):
                    sets = shingle_sets(words(part.column("text"), lower=True))
                    sizes = pa.array([len(s) for s in sets], pa.int64())
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, make(sets)], names=["node", "n", column])

        return made

    return reading


_registers_of = _per_node("regs", lambda sets: pa.array([r.tobytes() for r in registers(sets)], pa.binary()))
_shingles_of = _per_node("shingles", lambda sets: pa.array([s.tobytes() for s in sets], pa.binary()))
_shingle_lists_of = _per_node(
    "shingles", lambda sets: pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
)


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(key, node, mark): the rarest shingles of each set (node, n, shingles), of which any two at the threshold share one.

    The overlap of such sets is at least ``percent`` of the larger one. Shingles of one set only come first in
    the order and are never shared, so they are counted and not listed. The mark has the size of the set and ``rest``, the number of
    its shingles from the key on; where several sets go by one node it has the least and the largest size.
    """
    sets = stored(sets.withColumn("set", F.xxhash64("node", "n", "shingles")).dropDuplicates(["set"]), "sets")
    single = stored(sets.select("set", F.explode("shingles").alias("shingle")), "shingles")
    held = single.groupBy("shingle").agg(F.count("*").alias("holders")).where(F.col("holders") > 1)
    common = (
        single.join(held, "shingle").groupBy("set")
        .agg(F.array_sort(F.collect_list(F.struct("holders", "shingle"))).alias("common"))
    )
    listed = f"size(common) - cast((n * {percent} + 99) div 100 as int) + 1"
    return (
        common.join(sets.select("set", "node", "n"), "set")
        .select("node", "n", F.size("common").alias("shared"), F.expr(f"slice(common, 1, greatest(0, {listed}))").alias("rarest"))
        .select("node", "n", "shared", F.posexplode("rarest.shingle").alias("pos", "key"))
        .groupBy("key", "node")
        .agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("shared") - F.col("pos")).alias("rest"))
        .select("key", "node", F.struct("low", "high", "rest").alias("mark"))
    )


def reachable(percent: int):
    """Whether two marks of a key allow the threshold: by the sizes, and by the overlap that is possible from the key on."""
    def near(a: Column, b: Column) -> Column:
        sizes = (a["high"] * 100 >= b["low"] * percent) & (b["high"] * 100 >= a["low"] * percent)
        return sizes & (F.least(a["rest"], b["rest"]) * (100 + percent) >= (a["low"] + b["low"]) * percent)

    return near


def _likely(percent: int):
    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                for c in ("regs_a", "regs_b")
            )
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            found, used = estimate(a, b, n_a, n_b)
            limit = percent / 100
            least = limit - SIGMAS * np.sqrt(limit * (1 - limit) / np.maximum(used, 1)) - 1 / np.maximum(used, 1)
            yield batch.filter(pa.array(found >= least)).select(["a", "b"])

    return passing


def _confirmed(percent: int):
    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return passing


def _verifier(narrow: DataFrame, percent: int) -> Verify:
    """Test of pairs: estimate from the registers, then the full sets of those that are left."""
    sketches = Gathered(lambda nodes: _made_of(narrow, nodes, _registers_of, "node long, n long, regs binary"), "registers")
    sets = Gathered(lambda nodes: _made_of(narrow, nodes, _shingles_of, "node long, n long, shingles binary"), "sets")

    def verify(pairs: DataFrame) -> DataFrame:
        regs = sketches.of(pairs)
        near = ends_joined(pairs, regs, ("n", "regs"))
        likely = kept(near.mapInArrow(_likely(percent), "a long, b long").distinct())
        full = sets.of(likely)
        both = ends_joined(likely, full, ("shingles",))
        return both.mapInArrow(_confirmed(percent), "a long, b long").distinct()

    return verify


def _slot(node: str) -> str:
    """Bit of a node: neighbouring ids have different ones."""
    return f"({node} ^ shiftrightunsigned({node}, {NODE_BITS}))"


def _inside(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    bit = (ids ^ (ids.view(np.uint64) >> np.uint64(NODE_BITS)).view(np.int64)) & ((1 << NODE_BITS) - 1)
    return (table[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)) == 1


def _made_of(narrow: DataFrame, nodes: DataFrame, make, schema: str) -> DataFrame:
    """Rows (node, ...) that ``make`` gives for the texts of at least all ``nodes``.

    The texts are read in place: of few nodes the ids go to the tasks, of more a bit table of fixed size, by which a few
    other texts may be read too. So no text is moved.
    """
    if nodes.count() <= FEW_NODES:
        return _of(narrow, F.broadcast(nodes)).mapInArrow(make(), schema)
    table = narrow.sparkSession.sparkContext.broadcast(bit_table(nodes.select(F.expr(_slot("node")).alias("key")), 1 << NODE_BITS))
    return narrow.mapInArrow(make(table), schema)


def _of(narrow: DataFrame, nodes: DataFrame) -> DataFrame:
    return narrow.join(nodes.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")


def classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text)."""
    ready(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketches = stored(
        narrow.mapInArrow(_sketched(percent), "doc_id long, n_shingles long, set_id binary, bands array<long>"), "sketches"
    )
    full = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # Equal sets are one node, named by their smallest id; copies go no further.
    named = stored(full.groupBy("set_id").agg(F.min("doc_id").alias("node")), "nodes")
    shown = (
        full.join(named.select(F.col("node").alias("doc_id"), "set_id"), ["doc_id", "set_id"], "left_semi")
        .select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
    )
    # Rows that share a doc_id may differ in size; the pair is then judged by the larger one.
    marks = full.groupBy(F.col("doc_id").alias("node")).agg(F.max("n_shingles").alias("mark"))

    def similar_size(n: Column, m: Column) -> Column:
        return F.least(n, m) * 100 >= F.greatest(n, m) * percent

    def fine(nodes: DataFrame) -> DataFrame:
        sets = _made_of(narrow, nodes, _shingle_lists_of, "node long, n long, shingles array<long>")
        return prefixes(sets.join(nodes, "node", "left_semi"), percent)

    labels = connect(shown, marks, _verifier(narrow, percent), similar_size, fine, reachable(percent))
    found = named.join(labels, "node", "left").select("set_id", F.coalesce("comp", "node").alias("component_id"))
    return (
        sketches.drop("bands").join(found, "set_id", "left")
        .withColumn("component_id", F.coalesce("component_id", F.col("doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` without the documents that another one of their group stands for; columns unchanged."""
    judged = classes(docs, percent).where(F.col("doc_id").isNotNull())
    gone = judged.groupBy("doc_id").agg(F.max("kept").alias("kept")).where(~F.col("kept"))
    key = F.col("doc_id").cast("long")
    return docs.join(gone.select(F.col("doc_id").alias("_gone")), key == F.col("_gone"), "left_anti")
