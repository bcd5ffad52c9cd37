"""Exact-size samples by key, and the rows of other tables that belong to them."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.text import seeded_digest


# Hex digits of a digest by which one more step divides a range, and the most rows that one task sorts.
DIGITS = 4
SORTED_AT_ONCE = 10_000


def _row_digest(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def sample_rows(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``n`` rows without replacement: those with the smallest seeded digests of the key; NULL keys come last.

    Rows with the same key come in the order of a digest of the whole row, so the sample is the same however the rows are laid out; only
    rows that are equal throughout are interchangeable.

    Digests are spread evenly, so their first four digits cut the rows into 65,536 similar ranges. Whole ranges are taken until
    the next one would exceed ``n``. That one is divided by further digits, of the key's digest and then of the row's, until it
    has few rows, of which the smallest are taken: a frequent key or many NULLs end in no large range.
    """
    columns = df.columns
    ranged = df.withColumn("_place", F.coalesce(seeded_digest(seed, F.col(key)), F.lit("g")))
    low, wanted = _cut(ranged, "", n)
    if low is None:
        return df
    place = F.concat("_place", _row_digest(columns))
    whole, edge = ranged.where(F.col("_place") < low.prefix), ranged.where(F.col("_place").startswith(low.prefix))
    taken, edge = [whole], edge.withColumn("_place", place)
    while low.rows > SORTED_AT_ONCE and wanted:
        ends = edge.agg(F.min("_place").alias("first"), F.max("_place").alias("last")).first()
        if ends.first == ends.last:
            # Equal rows: any of them.
            edge = edge.withColumn("_place", F.lit(""))
            break
        shared = os.path.commonprefix([ends.first, ends.last])
        low, wanted = _cut(edge, shared, wanted)
        taken.append(edge.where(F.col("_place") < low.prefix))
        edge = edge.where(F.col("_place").startswith(low.prefix))
    taken.append(edge.orderBy("_place").limit(wanted) if low.rows <= SORTED_AT_ONCE else edge.limit(wanted))
    return reduce(DataFrame.union, taken).select(*columns)


def _cut(ranged: DataFrame, shared: str, n: int) -> tuple[Row | None, int]:
    """The range in which the ``n``-th row lies, and how many of its rows are wanted; none if there are no more than ``n`` rows."""
    prefix = F.substring("_place", 1, len(shared) + DIGITS).alias("prefix")
    # One count per range: 65,537 rows at most.
    for row in ranged.groupBy(prefix).agg(F.count(F.lit(1)).alias("rows")).orderBy("prefix").collect():
        if row["rows"] > n:
            return row, n
        n -= row["rows"]
    return None, n


def key_map(chosen: DataFrame, key: str, seed: str) -> DataFrame:
    """Each key once, with a repeatable surrogate for it."""
    keys = chosen.where(F.col(key).isNotNull()).select(key).distinct()
    return keys.withColumn("surrogate", F.substring(seeded_digest(seed, F.col(key)), 1, 16))


def rows_of(df: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the chosen ones; a key that is chosen twice does not repeat them."""
    return df.join(chosen.select(key), key, "left_semi")


def under_surrogates(df: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Rows with the key looked up in a map in which it is unique; rows without an entry are left out."""
    return df.join(names, key).withColumn(key, F.col("surrogate")).select(*df.columns)
