"""Groups of nodes that share keys: candidate search without all pairs, and connected components.

A key that many nodes share is worked off by hubs. In the first round every node is compared with
the smallest node of its key. Nodes that are then connected need no further comparison. In a key of up to ``LARGE``
nodes, those that lie in different components are compared at once. In a larger one, more and more hubs (1, 4,
16, ... of its nodes) are compared with the nodes in other components, until all are connected or every node
has been a hub. So each pair of nodes with a common key is either compared or already connected: the
components are those of all pairs, and a group of copies costs one comparison per member.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_path, shared_folder

Verify = Callable[[DataFrame], DataFrame]

Near = Callable[[Column, Column], Column]

GROWTH = 4
LARGE = 16
#: Pairs that are broadcast; 16 bytes each.
FEW_PAIRS = 1 << 14


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files and checkpoints of finished steps.

    Its cleaner acts when their owners are collected as garbage in the driver, which in a job of many
    small steps may be long after the job.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def kept(df: DataFrame, label: str = "step") -> DataFrame:
    """``df`` written once to the shared folder, so that later uses read it by column and survive lost executors.

    A file also has a known size, by which small results of a step are broadcast in the next one.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """As ``kept``, for large steps: what was shuffled for them is let go.

    The plan of the step just done is garbage only after a first collection, its shuffle files after a second.
    """
    result = kept(df, label)
    for _ in range(2):
        release(df.sparkSession)
    return result


def let_go(*frames: DataFrame) -> None:
    """Removes the files of frames that ``kept`` wrote and that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        files = spark.sparkContext._jvm.org.apache.hadoop.fs
        below = files.Path(shared_folder(spark))
        below = below.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(below)
        for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
            path = files.Path(spark.sparkContext._jvm.java.net.URI(folder))
            store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            if store.makeQualified(path).getParent().equals(below):
                store.delete(path, True)


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of the edges (a, b): comp is the smallest node it is connected with.

    Each round moves every node to its smallest neighbour, then to that one's, and goes on
    with the edges between the nodes that are left, so the rounds grow with the logarithm of the longest path.
    """
    edges = kept(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    labels = None
    while labels is None or not edges.isEmpty():
        ends = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("comp")
        )
        onward = step.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        step = kept(step.join(onward, "comp").select("node", F.col("next").alias("comp")))
        if labels is None:
            labels = step
        else:
            moved = step.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
            labels = kept(
                labels.join(moved, "comp", "left").select("node", F.coalesce("next", "comp").alias("comp"))
            )
        for end in ("a", "b"):
            named = step.select(F.col("node").alias(end), F.col("comp").alias("root"))
            edges = edges.join(named, end).withColumn(end, F.col("root")).select("a", "b")
        edges = kept(edges.where(F.col("a") != F.col("b")).distinct())
    release(edges.sparkSession)
    return labels


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``components`` of the edges that gave the labels and of more edges (a, b).

    Only the components that the new edges join are searched again, so the steps follow the new edges and not all that were found before.
    """
    for end in ("a", "b"):
        named = labels.select(F.col("node").alias(end), F.col("comp").alias("root"))
        edges = edges.join(named, end, "left").withColumn(end, F.coalesce("root", end)).select("a", "b")
    moved = components(edges)
    onward = moved.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
    known = labels.join(onward, "comp", "left").select("node", F.coalesce("next", "comp").alias("comp"))
    return kept(known.union(moved.join(labels.select("node"), "node", "left_anti").select("node", "comp")))


def ends_joined(pairs: DataFrame, own: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Pairs (a, b), read from files, with each of the ``columns`` of both nodes, as ``c_a`` and ``c_b``.

    Few pairs are broadcast to cut the rows of either side to their nodes before these move, so that a round of
    few pairs moves few rows.
    """
    few = pairs.count() <= FEW_PAIRS

    def side(end: str) -> DataFrame:
        asked = own.join(F.broadcast(pairs.select(F.col(end).alias("node"))), "node", "left_semi") if few else own
        return asked.select(F.col("node").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns))

    return pairs.join(side("a"), "a").join(side("b"), "b")


class Gathered:
    """Rows about nodes, made for the nodes of a pair when it first asks for them and stored for later ones."""

    def __init__(self, make: Callable[[DataFrame], DataFrame], label: str):
        self.make, self.label = make, label
        self.parts: list[DataFrame] = []

    def of(self, pairs: DataFrame) -> DataFrame:
        """At least the rows of all nodes in the pairs (a, b)."""
        asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        for part in self.parts:
            asked = asked.join(part.select("node"), "node", "left_anti")
        asked = kept(asked)
        if not self.parts or not asked.isEmpty():
            self.parts.append(stored(self.make(asked), self.label))
        return reduce(DataFrame.union, self.parts)


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component, of the keys that have nodes of several components."""
    placed = members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    split = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    return placed.join(split.where(F.col("low") != F.col("high")).select("key"), "key", "left_semi")


def shared(members: DataFrame) -> DataFrame:
    """Members (key, node) of keys with two nodes or more, with the number of nodes.

    The members move once: they are counted where those of a key lie together.
    """
    sizes = members.withColumn("size", F.count("*").over(Window.partitionBy("key")))
    return stored(sizes.where(F.col("size") > 1), "members")


def _with_hubs(together: DataFrame) -> DataFrame:
    hubs = together.groupBy("key").agg(F.min("node").alias("hub"), F.min_by("mark", "node").alias("hub_mark"))
    return together.join(hubs, "key").where(F.col("node") != F.col("hub"))


class _Links:
    """The components of the edges found so far."""

    def __init__(self, verify: Verify, edges: DataFrame):
        self.verify = verify
        self.labels = components(edges)

    def test(self, pairs: DataFrame) -> None:
        pairs = kept(pairs)
        if pairs.isEmpty():
            return
        found = kept(self.verify(pairs))
        if not found.isEmpty():
            self.labels = merged(self.labels, found)
        release(pairs.sparkSession)

    def at_once(self, left: DataFrame, near: Near) -> None:
        """Compares all nodes of a key (key, node, mark) that are in different components; for keys of bounded size."""
        left = kept(_mixed(left.select("key", "node", "mark"), self.labels))
        other = left.select("key", F.col("node").alias("b"), F.col("mark").alias("b_mark"), F.col("comp").alias("b_comp"))
        self.test(
            left.join(other, "key")
            .where((F.col("node") < F.col("b")) & (F.col("comp") != F.col("b_comp")) & near(F.col("mark"), F.col("b_mark")))
            .select(F.col("node").alias("a"), "b").distinct()
        )

    def by_hubs(self, left: DataFrame, near: Near) -> None:
        """Compares the nodes of every key (key, node, mark, size) until they are connected or all were hubs."""
        left = left.select("key", "node", "mark", "size")
        # A node's place does not depend on the key, so that keys with the same nodes choose the same hubs and ask for the same pairs.
        place = F.shiftrightunsigned(F.xxhash64("node"), 33)
        left = left.withColumn("slot", F.shiftrightunsigned(place * F.col("size"), 31))
        done, reach = 0, 1
        while True:
            left = kept(_mixed(left.where(F.col("size") > done), self.labels))
            if left.isEmpty():
                return
            hubs = left.where((F.col("slot") >= done) & (F.col("slot") < reach)).select(
                "key", F.col("node").alias("hub"), F.col("mark").alias("hub_mark"), F.col("comp").alias("hub_comp")
            )
            self.test(
                left.where(F.col("slot") >= done)
                .join(hubs, "key")
                .where((F.col("comp") != F.col("hub_comp")) & near(F.col("mark"), F.col("hub_mark")))
                .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
                .distinct()
            )
            left = left.drop("comp")
            done, reach = reach, reach * GROWTH

    def work_off(self, left: DataFrame, near: Near) -> None:
        self.at_once(left.where(F.col("size").between(3, LARGE)), near)
        self.by_hubs(left.where(F.col("size") > LARGE), near)


def connect(
    members: DataFrame,
    marks: DataFrame,
    verify: Verify,
    near: Near,
    refine: Callable[[DataFrame], DataFrame] | None = None,
    near_refined: Near | None = None,
    sized: bool = False,
) -> DataFrame:
    """(node, comp) of all nodes linked with another one.

    ``members`` has distinct rows (key, node) and ``marks`` one row (node, mark) per node; only pairs
    whose marks are ``near`` are candidates. ``verify`` is the test of pairs: distinct (a, b) with a < b in, those
    that hold out. If ``sized``, the members are those that ``shared`` gave, and only their nodes need marks.

    A key of more than ``LARGE`` nodes that its smallest node does not connect holds many look-alikes, nearly all of whose pairs
    fail the test. ``refine``, if given, gets the nodes of such keys and returns members (key, node, mark) under narrower keys; every true
    link shares one at which the two marks are ``near_refined``. Those keys are worked off in place of the large ones.
    """
    together = kept((members if sized else shared(members)).join(marks, "node"))
    first = kept(
        _with_hubs(together).where(near(F.col("mark"), F.col("hub_mark")))
        .select(F.col("hub").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    later = together.where(F.col("size") > 2)
    links = _Links(verify, kept(verify(first)))
    if refine is None:
        links.work_off(later, near)
        return links.labels
    links.at_once(later.where(F.col("size") <= LARGE), near)
    crowded = _mixed(later.where(F.col("size") > LARGE).select("key", "node", "mark"), links.labels)
    crowded = kept(crowded.select("node").distinct())
    if not crowded.isEmpty():
        narrow = shared(kept(refine(crowded)))
        comp = links.labels.select("node", "comp")
        hub_comp = comp.select(F.col("node").alias("hub"), F.col("comp").alias("hub_comp"))
        apart = _with_hubs(narrow).join(comp, "node", "left").join(hub_comp, "hub", "left").where(
            F.coalesce("comp", "node") != F.coalesce("hub_comp", "hub")
        )
        links.test(
            apart.where(near_refined(F.col("mark"), F.col("hub_mark")))
            .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
        )
        links.work_off(narrow, near_refined)
    return links.labels
