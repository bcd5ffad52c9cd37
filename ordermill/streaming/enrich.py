"""Events of new batches joined with the stored gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.gold import enrich_with_events
from ..sources import folders, versions
from .ingest import batches, stream_table

#: In a run's output, the batch that a row without other values says to be done.
COVERED = "covered_batch"


def store_gold(df: DataFrame, table: str, buckets: int) -> DataFrame:
    """Replace the stored gold table, bucketed by order, so that a join by order need not move it."""
    return versions.publish(df.repartition(buckets, "order_id"), table, bucket_by=(buckets, "order_id"))


def _runs(spark: SparkSession, target: str) -> list[str]:
    return [mark.rpartition("/")[0] for mark in folders.matching(spark, f"{target}/run=*/_SUCCESS")]


def _output(spark: SparkSession, target: str) -> DataFrame | None:
    runs = _runs(spark, target)
    return spark.read.option("basePath", target).parquet(*runs) if runs else None


def joined(gold: DataFrame, events: DataFrame) -> DataFrame:
    """Gold rows with their events; the side that is moved is the one of the events."""
    return enrich_with_events(gold, events, "event_date")


def enrich_new(spark: SparkSession, events: str, gold: DataFrame, target: str) -> int:
    """Joins the gold rows with the good events of all batches not enriched before; returns the number of batches.

    One join per run, however many batches have come in. The result is stored by event day together with the names of the
    batches it covers, in one write, so that it counts as a whole or not at all; an unfinished run is written over by the next one.
    """
    output = _output(spark, target)
    covered = set()
    if output is not None:
        covered = {r[0] for r in output.where(F.col(COVERED).isNotNull()).select(COVERED).collect()}
    new = [b for b in batches(spark, events) if b not in covered]
    if not new:
        return 0
    rows = joined(gold, stream_table(spark, events, new).drop("batch_id")).withColumn(COVERED, F.lit(None).cast("string"))
    done = spark.createDataFrame([(b,) for b in new], f"{COVERED} STRING")
    (
        rows.unionByName(done, allowMissingColumns=True)
        .hint("rebalance", "event_date")
        .write.mode("overwrite").partitionBy("event_date")
        .parquet(f"{target}/run={len(_runs(spark, target)):09d}")
    )
    return len(new)


def enriched(spark: SparkSession, target: str, gold: DataFrame) -> DataFrame:
    """All rows enriched so far; before the first run none, with the columns that ``gold`` leads to."""
    output = _output(spark, target)
    if output is None:
        return joined(gold, stream_table(spark, target, [])).drop("event_date")
    return output.where(F.col(COVERED).isNull()).drop("run", "event_date", COVERED)
