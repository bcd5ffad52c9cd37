"""Order events from JSON-Lines files to Parquet, exactly once per file.

A file stream finds the files that no earlier run has taken in, whatever their age; its checkpoint is the ledger. Every batch is
written to a folder of its own that is named by the batch's number, so a batch that is repeated after a failure replaces its first
attempt. Readers see the folders whose write was completed, which its ``_SUCCESS`` mark says: that mark is the only
commit there is, for the events, the quarantined lines and the reports on files alike.

A zipped file that cannot be read to its end costs itself only: the batch has its error in place of its lines, and every later run tries
it again until it can be read. Anything else that goes wrong, such as a full disk, ends the run, and the next one goes on from there.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.dates import event_moment
from ..schemas import ORDER_EVENT
from ..sources import folders
from .unzip import ROWS, lines_or_error

# File names that count as event files.
PLAIN_FILES, ZIPPED_FILES = "*.json", "*.gz"

CORRUPT = "_corrupt_record"
# States of a stored row: an event, a line that is none, a file that could not be read, a file read at a later attempt.
GOOD, QUARANTINED, FAILED, REPAIRED = "good", "quarantined", "failed", "repaired"
# Default bound of one batch; a long backlog is taken in several.
MAX_BYTES_PER_BATCH = 64 * 1024**3

# Times are read as text, so that one that does not parse costs its row and not the run.
_AS_SENT = [T.StructField(f.name, T.StringType()) if f.name == "event_timestamp" else f for f in ORDER_EVENT.fields]
_SCHEMA = T.StructType([*_AS_SENT, T.StructField(CORRUPT, T.StringType())])
_PARSED = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
_BINARY = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
# What a stored row has besides the event.
_ABOUT = [
    T.StructField(CORRUPT, T.StringType()), T.StructField("source_file", T.StringType()), T.StructField("error", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()), T.StructField("batch_id", T.StringType()),
    T.StructField("record_state", T.StringType()), T.StructField("event_date", T.DateType()),
]


def _lines(reader, source: str, **options) -> DataFrame:
    """(file, line, error) of all event files below ``source``."""
    below = {**options, "recursiveFileLookup": "true"}
    plain = reader.format("text").options(**below, pathGlobFilter=PLAIN_FILES).load(source)
    zipped = reader.format("binaryFile").schema(_BINARY).options(**below, pathGlobFilter=ZIPPED_FILES).load(source)
    return plain.select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), F.lit(None).cast("string").alias("error")
    ).unionByName(zipped.select("path", "content").mapInArrow(lines_or_error, ROWS))


def labelled(lines: DataFrame) -> DataFrame:
    """Events of (file, line, error) with their state, event time and day, and load time; blank lines vanish.

    A line that is no JSON object, has a field of the wrong type or a time that does not parse
    is quarantined with its text; the other lines of its file are not affected.
    """
    text, sent, made = F.col("line"), F.col("event_timestamp"), F.col("created_at")
    unread = (sent.isNotNull() & event_moment(sent).isNull()) | (made.isNotNull() & event_moment(made).isNull())
    line = F.when(unread, F.to_json(F.struct(*ORDER_EVENT.names)))
    parsed = lines.where(text.isNull() | F.rlike(text, F.lit(r"\S"))).withColumn("event", F.from_json(text, _SCHEMA, _PARSED))
    no_object = text.isNotNull() & ~F.rlike(text, F.lit(r"^\s*\{"))
    state = (
        F.when(F.col("error").isNotNull(), FAILED).when(text.isNull(), REPAIRED)
        .when(F.col(CORRUPT).isNull(), GOOD).otherwise(QUARANTINED)
    )
    return (
        parsed.select("file", "line", "error", "event.*")
        .withColumn(CORRUPT, F.when(no_object, text).otherwise(F.coalesce(CORRUPT, line)))
        .withColumns(
            {
                "record_state": state,
                "event_timestamp": F.when(F.col(CORRUPT).isNull(), F.coalesce(event_moment(sent), event_moment(made))),
                "loaded_at": F.current_timestamp(),
            }
        )
        .withColumn("event_date", F.to_date("event_timestamp"))
        .select(*ORDER_EVENT.names, CORRUPT, F.col("file").alias("source_file"), "error", "loaded_at", "record_state", "event_date")
    )


def _store(rows: DataFrame, path: str) -> None:
    """A few files per state and day: the hint splits a large day over tasks and joins small ones."""
    (
        rows.hint("rebalance", "record_state", "event_date")
        .write.mode("overwrite").partitionBy("record_state", "event_date")
        .parquet(path)
    )


def follow(
    spark: SparkSession, source: str, target: str, checkpoint: str, max_bytes: int = MAX_BYTES_PER_BATCH, **trigger
) -> StreamingQuery:
    """Start the stream of new files into the sink; by default it ends when all files there are have been taken in."""
    lines = _lines(spark.readStream, source, maxBytesPerTrigger=max_bytes, maxFileAge="36500d")

    def store(batch: DataFrame, number: int) -> None:
        first_time = labelled(batch).where(F.col("record_state") != REPAIRED)
        _store(first_time, f"{target}/batch_id=stream-{number:09d}")

    query = lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"availableNow": True})).start()


def ingest(
    spark: SparkSession, source: str, target: str, checkpoint: str, max_bytes: int = MAX_BYTES_PER_BATCH
) -> list[tuple[str, str]]:
    """Take in all files not seen before and those that could not be read before; returns the ones that still cannot, with their errors."""
    earlier = [r.source_file for r in outstanding(spark, target).collect()]
    if folders.exists(spark, source):
        follow(spark, source, target, checkpoint, max_bytes).awaitTermination()
    _try_again(spark, earlier, target)
    return sorted((r.source_file, r.error) for r in outstanding(spark, target).collect())


def _try_again(spark: SparkSession, files: list[str], target: str) -> None:
    """One more batch of the files that failed, which also says which of them have been read now."""
    there = [f for f in files if folders.exists(spark, f)]
    if not there:
        return
    number = sum("/batch_id=again-" in path for path in _completed(spark, target))
    # Paths are read as patterns.
    exact = [re.sub(r"([][{}*?\\])", r"\\\1", f) for f in there]
    zipped = spark.read.format("binaryFile").load(exact)
    _store(labelled(zipped.select("path", "content").mapInArrow(lines_or_error, ROWS)), f"{target}/batch_id=again-{number:09d}")


def _completed(spark: SparkSession, target: str) -> list[str]:
    return [mark.rpartition("/")[0] for mark in folders.matching(spark, f"{target}/batch_id=*/_SUCCESS")]


def batches(spark: SparkSession, target: str) -> list[str]:
    """Batches that count."""
    return [path.rpartition("=")[2] for path in _completed(spark, target)]


def stored(spark: SparkSession, target: str, chosen: list[str] | None = None) -> DataFrame:
    """All rows of the batches that count, or of some of them, with their state."""
    schema = T.StructType([*ORDER_EVENT.fields, *_ABOUT])
    chosen = batches(spark, target) if chosen is None else chosen
    if not chosen:
        return spark.createDataFrame([], schema)
    paths = [f"{target}/batch_id={b}" for b in chosen]
    return spark.read.schema(schema).option("basePath", target).parquet(*paths)


def _in_state(state: str) -> Column:
    return F.col("record_state") == state


def stream_table(spark: SparkSession, target: str, only: list[str] | None = None) -> DataFrame:
    """Good events taken in so far, or those of some batches; only their partitions are read."""
    good = stored(spark, target, only).where(_in_state(GOOD))
    return good.select(*ORDER_EVENT.names, "loaded_at", "event_date", "batch_id")


def quarantine(spark: SparkSession, target: str) -> DataFrame:
    """Text of the lines that could not be taken in."""
    return stored(spark, target).where(_in_state(QUARANTINED)).select(F.col(CORRUPT).alias("line"), "source_file", "loaded_at")


def failures(spark: SparkSession, target: str) -> DataFrame:
    """Every failed attempt to read a file."""
    failed = stored(spark, target).where(_in_state(FAILED))
    return failed.select("source_file", "error", F.col("loaded_at").alias("failed_at"), "batch_id")


def outstanding(spark: SparkSession, target: str) -> DataFrame:
    """Files that have not been read yet, with the newest error and the number of attempts."""
    repaired = stored(spark, target).where(_in_state(REPAIRED)).select("source_file").distinct()
    return (
        failures(spark, target).join(repaired, "source_file", "left_anti")
        .groupBy("source_file")
        .agg(F.max_by("error", "failed_at").alias("error"), F.count(F.lit(1)).alias("attempts"))
    )
