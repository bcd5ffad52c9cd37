"""Hard negatives of anchor rows by bounds along a spanning tree of the anchors.

A component ``x`` becomes ``floor(scale * x)``, so a score, the inner product with the anchor, is a whole number and exact.
The anchors of one label are dealt over groups of about ``TREE``; a minimum spanning tree joins the anchors of a group.
Where the score of a candidate ``v`` with the parent ``p`` is known within ``[low, high]``, that with a child ``c`` lies
within ``[low - r, high + r]``, ``r = |p - c| * |v|`` (Cauchy-Schwarz). Only candidates whose bounds meet what the child looks for are scored
again: first the range of its best positives, then the windows of scores that its positives ask for.

All rows are cut into blocks of ``BLOCK``. Blocks and trees are dealt over a grid of cells, each of which
holds a few of both, so a task has bounded memory whatever the number of rows, labels or copies. A cell gives the best few
rows of each anchor and positive, and those of all cells are ranked.

Rows with a null id, label, vector or component, or a component that is not finite, take no part. Of vectors of different
lengths the shorter one counts as padded with zeros; an empty one scores 0. Rows that share an id are different rows, but none of them is a
positive or negative of an anchor with that id; equal rows give equal result rows. Ties go to the smaller id. A score beyond 64 bits counts
as the nearest 64-bit number. Other columns are left alone; without anchors or positives the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .linking import kept
from .shipping import ready

TREE, BLOCK = 1024, 4096
#: Trees and blocks of a cell.
CELL_TREES, CELL_BLOCKS = 8, 4
POSITIVES, NEGATIVES = 5, 3
#: A negative's score in percent of the positive's.
LOWEST, HIGHEST = 50, 95
SCALE = 256

_LONG = np.iinfo(np.int64)
_TREE_KEY = ["label", "part"]
_ANCHOR_KEY = [*_TREE_KEY, "place"]
_PACKED = "ids binary, labels binary, vectors binary, width int"
_TREES = "label long, part long, ids binary, vectors binary, width int, parents binary, edges binary"


def taking_part(rows: DataFrame, vector: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part; all columns as longs and doubles."""
    values = F.transform(vector, lambda x: x.cast("double"))
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    found = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), values.alias("vector"))
    return found.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)


def _matrix(vectors: pa.Array, scale: int) -> np.ndarray:
    """Whole-number components, one row each, shorter vectors padded with zeros."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    full = np.zeros((len(sizes), width))
    full[np.arange(width) < sizes[:, None]] = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False))
    return full


def _packed(scale: int, size: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, size):
                some = batch.slice(begin, size)
                full = _matrix(some.column("vector"), scale)
                ids, labels = (some.column(c).to_numpy() for c in ("vec_id", "label"))
                yield pa.RecordBatch.from_pylist(
                    [{"ids": ids.tobytes(), "labels": labels.tobytes(), "vectors": full.tobytes(), "width": full.shape[1]}],
                    pa.schema([("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("width", pa.int32())]),
                )

    return made


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent of every point, -1 for the first, and the length of the edge to it; parents come by Prim's order."""
    n = len(points)
    parents, edges = np.full(n, -1, np.int64), np.zeros(n)
    nearest, reach, open_ = np.zeros(n, np.int64), np.full(n, np.inf), np.ones(n, bool)
    at = 0
    for _ in range(n):
        open_[at] = False
        apart = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        closer = open_ & (apart < reach)
        reach[closer], nearest[closer] = apart[closer], at
        if not open_.any():
            break
        at = int(np.flatnonzero(open_)[reach[open_].argmin()])
        parents[at], edges[at] = nearest[at], reach[at]
    return parents, edges


def _grown(scale: int):
    def made(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending")]).combine_chunks()
        full = _matrix(table.column("vector").combine_chunks(), scale)
        parents, edges = spanning_tree(full)
        return pa.table(
            {
                "label": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([key[1].as_py()], pa.int64()),
                "ids": [table.column("vec_id").to_numpy().tobytes()], "vectors": [full.tobytes()],
                "width": pa.array([full.shape[1]], pa.int32()), "parents": [parents.tobytes()], "edges": [edges.tobytes()],
            }
        )

    return made


class _Rows:
    """Rows of a block that a tree looks at, with exact inner products."""

    def __init__(self, ids: np.ndarray, full: np.ndarray):
        self.ids, self.full = ids, full
        self.norms = np.sqrt((full**2).sum(axis=1))
        self.largest = float(np.abs(full).max(initial=0))

    def scores(self, anchor: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        width = min(self.full.shape[1], len(anchor))
        mine, other = self.full[:, :width], anchor[:width]
        most = width * self.largest * float(np.abs(other).max(initial=0))
        if most >= 2.0**53:  # beyond what doubles hold exactly
            whole = [int(x) for x in other]
            exact = (sum(int(x) * y for x, y in zip(row, whole)) for row in mine[wanted])
            return np.array([min(max(s, _LONG.min), _LONG.max) for s in exact], np.int64)
        if len(wanted) * 2 < len(mine):
            mine = mine[wanted]
            return (mine @ other).astype(np.int64)
        return (mine @ other).astype(np.int64)[wanted]


def _searched(rows: _Rows, tree: dict, asks) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, indexes, scores) of the rows that ``asks(place, low, high)`` marks by their bounds, for every anchor of the tree."""
    n = len(tree["ids"])
    children: list[list[int]] = [[] for _ in range(n)]
    for child, parent in enumerate(tree["parents"]):
        if parent >= 0:
            children[parent].append(child)
    waiting: list[tuple[int, np.ndarray | None, np.ndarray | None]] = [(0, None, None)]
    while waiting:
        place, low, high = waiting.pop()
        if low is None:
            wanted = np.arange(len(rows.ids))
            low, high = np.empty(len(wanted)), np.empty(len(wanted))
        else:
            # A little wider than the bound, for the rounding of lengths and sums.
            slack = tree["edges"][place] * rows.norms * (1 + 1e-9) + 1e-6 + 1e-9 * np.maximum(np.abs(low), np.abs(high))
            low, high = low - slack, high + slack
            wanted = np.flatnonzero(asks(place, low, high))
        scores = rows.scores(tree["vectors"][place], wanted)
        low[wanted] = high[wanted] = scores.astype(np.float64)
        yield place, wanted, scores
        waiting.extend((child, low, high) for child in children[place])


def _best(ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Indexes of the highest scores, ties by the smaller id."""
    if len(scores) > 8 * most:
        edge = np.partition(scores, len(scores) - most)[len(scores) - most]
        near = np.flatnonzero(scores >= edge)
        return near[np.lexsort((ids[near], ~scores[near]))[:most]]
    return np.array(sorted(range(len(ids)), key=lambda i: (-int(scores[i]), ids[i]))[:most], np.int64)


def _unpacked(found: pa.Table) -> list[dict]:
    rows = []
    for row in found.to_pylist():
        row["ids"] = np.frombuffer(row["ids"], np.int64)
        row["vectors"] = np.frombuffer(row["vectors"], np.float64).reshape(len(row["ids"]), row["width"])
        for name, kind in (("labels", np.int64), ("parents", np.int64), ("edges", np.float64)):
            if name in row:
                row[name] = np.frombuffer(row[name], kind)
        rows.append(row)
    return rows


def _within(scores: np.ndarray, low: int, high: int) -> np.ndarray:
    """Indexes of the scores of which ``low <= 100 * score <= high``, with whole numbers of any size."""
    least, most = -(-low // 100), high // 100
    if least > _LONG.max or most < _LONG.min:
        return np.zeros(0, np.int64)
    return np.flatnonzero((scores >= max(least, _LONG.min)) & (scores <= min(most, _LONG.max)))


_POSITIVE = pa.schema(
    [("label", pa.int64()), ("part", pa.int64()), ("place", pa.int64()), ("anchor_id", pa.int64()),
     ("positive_id", pa.int64()), ("positive_score", pa.int64())]
)
_NEGATIVE = pa.schema([*_POSITIVE, ("slot", pa.int32()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def _positives(most: int):
    def made(blocks: pa.Table, trees: pa.Table) -> pa.Table:
        grown, out = _unpacked(trees), []
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for block in _unpacked(blocks):
            for t, tree in enumerate(grown):
                same = block["labels"] == tree["label"]
                if not same.any():
                    continue
                rows = _Rows(block["ids"][same], block["vectors"][same])

                def asks(place: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                    others = rows.ids != tree["ids"][place]
                    known = best.get((t, place))
                    least = -np.inf if known is None or len(known[1]) < most else float(known[1][-1])
                    if others.sum() >= most:
                        least = max(least, np.partition(low[others], others.sum() - most)[others.sum() - most])
                    # Large scores lose digits as doubles.
                    return others & (high >= least - 1e-9 * abs(least))

                for place, wanted, scores in _searched(rows, tree, asks):
                    other = rows.ids[wanted] != tree["ids"][place]
                    ids, scores = rows.ids[wanted][other], scores[other]
                    if (t, place) in best:
                        ids, scores = (np.concatenate(x) for x in zip(best[t, place], (ids, scores)))
                    top = _best(ids, scores, most)
                    best[t, place] = ids[top], scores[top]
        for (t, place), (ids, scores) in best.items():
            tree = grown[t]
            for i, s in zip(ids, scores):
                out.append({"label": tree["label"], "part": tree["part"], "place": place, "anchor_id": int(tree["ids"][place]),
                            "positive_id": int(i), "positive_score": int(s)})
        return pa.Table.from_pylist(out, _POSITIVE)

    return made


def _negatives(most: int, lowest: int, highest: int):
    def made(blocks: pa.Table, trees: pa.Table) -> pa.Table:
        grown, out = _unpacked(trees), []
        best: dict[tuple[int, int, int], list[tuple]] = {}
        for tree in grown:
            tree["at"] = {}
            for x in tree["targets"]:
                tree["at"].setdefault(x["place"], []).append((x["slot"], x["positive_score"], x["positive_id"]))
        for block in _unpacked(blocks):
            for t, tree in enumerate(grown):
                differ = block["labels"] != tree["label"]
                if not differ.any() or not tree["at"]:
                    continue
                rows = _Rows(block["ids"][differ], block["vectors"][differ])

                def asks(place: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                    met = np.zeros(len(low), bool)
                    for _, score, _ in tree["at"].get(place, ()):
                        if score >= 0:
                            met |= (high * 100 >= lowest * float(score) * (1 - 1e-9)) & (low * 100 <= highest * float(score) * (1 + 1e-9))
                    return met

                for place, wanted, scores in _searched(rows, tree, asks):
                    other = rows.ids[wanted] != tree["ids"][place]
                    ids, scores = rows.ids[wanted][other], scores[other]
                    for slot, score, _ in tree["at"].get(place, ()):
                        fits = _within(scores, lowest * score, highest * score)
                        if len(fits):
                            top = fits[_best(ids[fits], scores[fits], most)]
                            have = best.setdefault((t, place, slot), [])
                            have.extend((-int(scores[i]), int(ids[i])) for i in top)
                            have.sort()
                            del have[most:]
        for (t, place, slot), have in best.items():
            tree = grown[t]
            score, positive = next((s, p) for k, s, p in tree["at"][place] if k == slot)
            for s, i in have:
                out.append({"label": tree["label"], "part": tree["part"], "place": place, "anchor_id": int(tree["ids"][place]),
                            "positive_id": positive, "positive_score": score, "slot": slot, "negative_id": i, "negative_score": -s})
        return pa.Table.from_pylist(out, _NEGATIVE)

    return made


def _fields(schema: pa.Schema) -> str:
    names = {"int64": "long", "int32": "int"}
    return ", ".join(f"{f.name} {names.get(str(f.type), str(f.type))}" for f in schema)


def _ranked(found: DataFrame, per: list[str], score: str, by: str, most: int) -> DataFrame:
    """The first rows of each group, whose cells gave no more than ``most`` each."""
    order = Window.partitionBy(*per).orderBy(F.desc(score), by)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` has vec_id, label (a whole number) and the vector; ``is_anchor`` is a condition on vec_id and label. An anchor's positives
    are its ``positives`` best other rows of its label; of each, the first ``negatives`` rows of other labels are returned whose
    score is ``lowest`` to ``highest`` percent of the positive's.
    """
    spark = rows.sparkSession
    ready(spark)
    valid = taking_part(rows, vector)
    anchors = valid.where(is_anchor)
    parts = anchors.groupBy("label").agg(F.ceil(F.count("*") / TREE).alias("parts"))
    dealt = anchors.join(parts, "label").withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts"))
    trees = kept(dealt.drop("parts").groupBy(*_TREE_KEY).applyInArrow(_grown(scale), _TREES), "trees")
    blocks = kept(valid.mapInArrow(_packed(scale, BLOCK), _PACKED), "blocks")

    columns = max(1, math.ceil(trees.count() / CELL_TREES))
    lines = max(1, math.ceil(blocks.count() / CELL_BLOCKS))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    def cells(grown: DataFrame):
        mine_ = blocks.withColumn("line", F.pmod(F.xxhash64("ids"), F.lit(lines))).withColumn("column", every(columns))
        theirs = grown.withColumn("column", F.pmod(F.xxhash64(*_TREE_KEY), F.lit(columns))).withColumn("line", every(lines))
        return mine_.groupBy("line", "column").cogroup(theirs.groupBy("line", "column"))

    near = cells(trees).applyInArrow(_positives(positives), _fields(_POSITIVE))
    near = kept(_ranked(near, _ANCHOR_KEY, "positive_score", "positive_id", positives).withColumn("slot", F.col("rank") - 1), "positives")
    asked = near.groupBy(*_TREE_KEY).agg(F.collect_list(F.struct("place", "slot", "positive_score", "positive_id")).alias("targets"))
    found = cells(trees.join(asked, _TREE_KEY)).applyInArrow(_negatives(negatives, lowest, highest), _fields(_NEGATIVE))
    best = _ranked(found, [*_ANCHOR_KEY, "slot"], "negative_score", "negative_id", negatives)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
