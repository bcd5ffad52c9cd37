"""Benchmark decontamination by SimHash of item-sized windows.

Words are runs of letters and digits, lower-cased. An item of n words is compared with windows of n words
of a document. Only windows that share a shingle (five words; fewer in an item of fewer words) with an item of
their size can be similar to one, so the windows are laid where a shared shingle puts the item's start.
The 64-bit SimHash of a window's shingles is joined with those of the items on size and fingerprint block:
with ``RADIUS + 1`` blocks, fingerprints within ``RADIUS`` bits agree on one at least. Pairs within the
radius are verified exactly: the weight of the shingles that window and item share over the weight of all
their shingles. A shingle weighs ln(1 + N / d), with d of the N items having it; one that the item lacks
weighs ln(1 + N). At a similarity of 0.8 the fingerprints lie about 10 bits apart with a deviation of 3, so
the radius of 19 loses one pair in a thousand at the threshold and fewer above it; equal passages have distance 0.

Null and empty texts and items without a word match nothing. A document with fewer words than an item is compared
as one window. Rows with equal doc_id and text count as one; repeated items are reported each under its id.
Among equally similar windows the first counts. Other columns are not read; an empty table on either side
gives an empty result. All is done with DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linking import stored
from .simhash import block_keys, blocks, distance, normalised, with_fingerprint

SHINGLE = 5
RADIUS = 19
SIMILARITY = 0.8
#: Rows of an item table up to which it is broadcast; some 60 bytes each.
BROADCAST_ROWS = 500_000

_ROW = ("doc_id", "sum")


def _word_hashes(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(normalised(text), " "), ""), lambda w: F.xxhash64(w))


def _shingles(words: str, size: int) -> Column:
    """Hash of every run of ``size`` words."""
    word = F.col(words)
    run = F.transform(
        F.sequence(F.lit(0), F.size(word) - size),
        lambda i: F.xxhash64(*(F.get(word, i + k) for k in range(size)), F.lit(size)),
    )
    return F.when(F.size(word) >= size, run).otherwise(F.array().cast("array<bigint>"))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def items_of(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """Items with their number of words, shingle size, shingles, weights and fingerprint; the shingle sizes in use."""
    rows = benchmark.select(
        F.col("item_id").cast("long"), _word_hashes(F.col("text").cast("string")).alias("words")
    ).where(F.size("words") > 0)
    rows = rows.withColumn("n", F.size("words")).withColumn("k", F.least(F.col("n"), F.lit(SHINGLE)))
    sizes = F.lit(None).cast("array<bigint>")
    for k in range(1, SHINGLE + 1):
        sizes = F.when(F.col("k") == k, _shingles("words", k)).otherwise(sizes)
    rows = rows.withColumn("run", sizes).withColumn("shingles", F.array_distinct("run")).drop("words")
    # Stands for the row in joins, as an item id may be absent or occur twice.
    rows = rows.withColumn("row", F.xxhash64("item_id", F.col("item_id").isNull(), "run"))
    items = stored(rows, "items")
    used = sorted(r[0] for r in items.select("k").distinct().collect())  # five values at most
    total = items.count()
    held = items.select("item_id", F.explode("shingles").alias("s"))
    weight = held.groupBy("s").agg(F.log(1 + F.lit(total) / F.count("*")).alias("w"))
    weighed = (
        items.select("row", F.explode("shingles").alias("s")).join(weight, "s")
        .groupBy("row").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("s", "w")))).alias("weights"))
    )
    items = items.dropDuplicates(["row"]).join(weighed, "row").drop("row")
    items = items.withColumn("unseen", F.log(F.lit(1.0 + total)))
    return stored(with_fingerprint(items, "run"), "items"), used


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, sum, item_id, similarity, first_word, n_words): the best window of every document and item that match."""
    items, sizes = items_of(benchmark)
    n_items = items.count()
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(F.col("text").isNotNull())
    texts = texts.select("doc_id", F.xxhash64("text").alias("sum"), _word_hashes(F.col("text")).alias("words"))
    places = items.select("n", "k", F.posexplode("run").alias("at", "s")).distinct()
    places = _bounded(places, places.count())
    hits = None
    for k in sizes:
        seen = texts.select(*_ROW, F.size("words").alias("size"), F.posexplode(_shingles("words", k)).alias("pos", "s"))
        found = seen.join(places.where(F.col("k") == k), "s")
        # A window lies within the text as far as the text is long enough.
        start = F.greatest(F.least(F.col("pos") - F.col("at"), F.col("size") - F.col("n")), F.lit(0))
        found = found.select(*_ROW, "n", "k", start.alias("start")).distinct()
        hits = found if hits is None else hits.union(found)
    if hits is None:
        return _none(docs)
    hits = stored(hits, "windows")
    per_row = hits.groupBy(*_ROW).agg(F.collect_list(F.struct("n", "k", "start")).alias("windows"))
    held = texts.join(per_row.withColumnsRenamed({"doc_id": "_d", "sum": "_s"}),
                      F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("sum") == F.col("_s"))).drop("_d", "_s")
    windows = held.select(*_ROW, F.explode("windows").alias("win"), "words").select(
        *_ROW, "win.*", F.slice("words", F.col("win.start") + 1, F.col("win.n")).alias("part")
    )
    run = F.lit(None).cast("array<bigint>")
    for k in sizes:
        run = F.when(F.col("k") == k, _shingles("part", k)).otherwise(run)
    windows = windows.select(*_ROW, "n", "start", run.alias("run")).where(F.size("run") > 0).distinct()
    windows = with_fingerprint(windows, "run")
    masks = blocks(radius + 1)
    keyed = items.select(
        "n", F.col("fp").alias("item_fp"), F.col("item_id"), "weights", "unseen",
        F.explode(block_keys(F.col("fp"), masks)).alias("key"),
    )
    pairs = (
        windows.withColumn("key", F.explode(block_keys(F.col("fp"), masks)))
        .join(_bounded(keyed, n_items * len(masks)), ["n", "key"])
        .where(distance(F.col("fp"), F.col("item_fp")) <= radius)
    )
    own = F.array_distinct("run")
    both = F.aggregate(
        F.array_intersect(own, F.map_keys("weights")), F.lit(0.0), lambda a, s: a + F.element_at("weights", s)
    )
    whole = F.aggregate(F.map_values("weights"), F.lit(0.0), lambda a, w: a + w)
    more = F.size(F.array_except(own, F.map_keys("weights"))) * F.col("unseen")
    pairs = pairs.withColumn("similarity", both / (whole + more)).where(F.col("similarity") >= similarity)
    best = F.max_by(F.struct(F.col("start"), F.col("n")), F.struct("similarity", -F.col("start")))
    return pairs.groupBy(*_ROW, "item_id").agg(F.max("similarity").alias("similarity"), best.alias("best")).select(
        *_ROW, "item_id", "similarity", F.col("best.start").cast("long").alias("first_word"),
        F.col("best.n").cast("long").alias("n_words"),
    )


def _none(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame(
        [], "doc_id long, sum long, item_id long, similarity double, first_word long, n_words long"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no benchmark item stands; columns unchanged."""
    gone = contaminated(docs, benchmark).select(F.col("doc_id").alias("_d"), F.col("sum").alias("_s")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_s"))
    return docs.join(gone, same, "left_anti")
