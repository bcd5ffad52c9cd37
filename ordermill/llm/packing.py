"""Length buckets with least padding, and token-budget batches inside each bucket.

A document is its token ids and one end id; one longer than ``MAX_LENGTH`` is cut into pieces of that length,
so the histogram of lengths has ``MAX_LENGTH`` entries at most, whatever the input. From the histogram of
all pieces, dynamic programming chooses the ``BUCKETS`` boundaries for which padding every piece to the next boundary
adds the fewest tokens. A batch of a bucket takes as many padded pieces as fit ``BUDGET`` tokens. Pieces are
numbered inside a bucket by hashed parts of bounded size, whose counts give each part its first number, so
only the last batch of a bucket can be short.

Null and empty texts have the end id alone. Repeated rows are packed each. Rows without doc_id are packed too. Other columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import slices
from .linking import stored
from .shipping import ready
from .tokens import LIST_BYTES, LIST_ROWS, encoder, public_path

MAX_LENGTH = 2048
BUCKETS = 12
BUDGET = 1 << 16
ROWS_PER_PART = 100_000


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and n_tokens, the end id included."""
    ready(docs.sparkSession)
    path = tokenizer or public_path()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = encoder(path)
        for batch in batches:
            for part in slices(batch, "text", LIST_BYTES, LIST_ROWS):
                _, counts = texts.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts + 1)], names=["doc_id", "n_tokens"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(counted, "doc_id long, n_tokens long")


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Boundaries, the largest length last, with the least padding in ``buckets`` buckets or fewer.

    cost(i, j) of a bucket of the sorted lengths i to j - 1 is its count times its largest length, as the sum of the lengths
    themselves does not depend on the choice.
    """
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths)[order], np.asarray(counts, np.float64)[order]
    n = len(lengths)
    if not n:
        return []
    before = np.concatenate(([0.0], np.cumsum(counts)))
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    cuts = []
    for _ in range(min(buckets, n)):
        new = np.full(n + 1, np.inf)
        new[0] = 0.0
        cut = np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            options = best[:j] + (before[j] - before[:j]) * lengths[j - 1]
            cut[j] = int(np.argmin(options))
            new[j] = options[cut[j]]
        best = new
        cuts.append(cut)
    chosen, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        chosen.append(int(lengths[j - 1]))
        j = cut[j]
    return sorted(chosen)


def _by_boundary(length: Column, bounds: list[int], values: list[int]) -> Column:
    found = F.lit(None).cast("int")
    for bound, value in sorted(zip(bounds, values), reverse=True):
        found = F.when(length <= bound, F.lit(value)).otherwise(found)
    return found


def pack(
    docs: DataFrame,
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    tokenizer: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, piece, first_token, length, bucket, boundary, batch, slot.

    ``batch`` counts from 0 in every bucket, ``slot`` from 0 in every batch.
    """
    if budget < max_length:
        raise ValueError("a batch must hold one piece of the largest length")
    counts = token_counts(docs, tokenizer)
    each = F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / max_length).cast("int")))
    pieces = counts.withColumn("piece", each).select(
        "doc_id", "piece", (F.col("piece").cast("long") * max_length).alias("first_token"),
        F.least(F.col("n_tokens") - F.col("piece").cast("long") * max_length, F.lit(max_length)).cast("int").alias("length"),
    )
    pieces = stored(pieces, "pieces")
    histogram = pieces.groupBy("length").count().collect()  # max_length rows at most
    bounds = boundaries(np.array([r[0] for r in histogram]), np.array([r[1] for r in histogram]), buckets)
    parts = 1 + sum(r[1] for r in histogram) // ROWS_PER_PART
    length = F.col("length")
    placed = pieces.withColumns({
        "bucket": _by_boundary(length, bounds, list(range(len(bounds)))),
        "boundary": _by_boundary(length, bounds, bounds),
        "part": F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)),
    })
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("bucket", "part").count().select(
        "bucket", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
    )
    own = Window.partitionBy("bucket", "part").orderBy("doc_id", "piece")
    number = F.col("first") + F.row_number().over(own) - 1
    size = F.floor(F.lit(budget) / F.col("boundary"))
    return (
        placed.join(firsts, ["bucket", "part"])
        .withColumn("number", number)
        .select(
            "doc_id", "piece", "first_token", "length", "bucket", "boundary",
            F.floor(F.col("number") / size).alias("batch"), (F.col("number") % size).alias("slot"),
        )
    )
