"""CSV files to raw tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW
from . import versions
from .catalog import RAW_LAYER, table_in
from .errors import cause

# File of each raw table below one root; a name may also be a folder of files.
FILES = {table: f"{table}.csv" for table in RAW}
# Tables whose text may hold line breaks. Files read with line breaks inside quotes cannot be
# split, so large files of the others stay parallel; the set is an argument of every reader.
FREE_TEXT_TABLES = frozenset({"reviews"})
PARALLEL_LOADS = 4

# Header line, quotes doubled inside quotes, and the form of timestamps.
_FORMAT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}

LOADED = "loaded"
SKIPPED = "skipped"
FAILED = "failed"


def read_csv(
    spark: SparkSession, path: str, table: str, free_text: frozenset[str] = FREE_TEXT_TABLES
) -> DataFrame:
    """One raw table in its declared schema, from any path Spark can reach; bad values fail.

    The scheme of the path (local or object store) picks the file system. Columns are found by
    their names in the header line, in any order and with others between them; every file must have
    the same header as the first one, and a missing column is an error.
    """
    options = {**_FORMAT, "multiLine": str(table in free_text).lower()}
    header = spark.read.options(**options).csv(path).columns
    missing = [name for name in RAW[table].names if name not in header]
    if missing:
        raise ValueError(f"{table}: no column {', '.join(missing)} in the header of {path}")
    declared = {f.name: f for f in RAW[table].fields}
    found = T.StructType([declared.get(name, T.StructField(name, T.StringType())) for name in header])
    read = spark.read.schema(found).options(**options, mode="FAILFAST", enforceSchema="false").csv(path)
    return read.select(*RAW[table].names)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**_FORMAT).csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    write_csv(df, path, "append")


def load_table(
    spark: SparkSession, path: str, table: str, layer: str = RAW_LAYER, free_text: frozenset[str] = FREE_TEXT_TABLES
) -> int:
    """Replace a raw table with a CSV source and return the rows written.

    The count is observed while writing, so the source is read once. The old rows stay readable until the new
    ones are complete, and for good if the load fails.
    """
    written = Observation()
    loaded = read_csv(spark, path, table, free_text).withColumn("loaded_at", F.current_timestamp())
    versions.publish(loaded.observe(written, F.count(F.lit(1)).alias("rows")), table_in(layer, table))
    return written.get["rows"]


def paths_below(root: str, files: dict[str, str] = FILES) -> dict[str, str]:
    """Path of every raw table's source below one root."""
    return {table: f"{root.rstrip('/')}/{name}" for table, name in files.items()}


def load_tables(
    spark: SparkSession,
    paths: dict[str, str],
    layer: str = RAW_LAYER,
    free_text: frozenset[str] = FREE_TEXT_TABLES,
) -> DataFrame:
    """Load the tables side by side; skip missing sources and go on past failures.

    Returns table, rows, outcome and the cause of a failure. Failed tasks are retried by Spark itself.
    """

    def outcome(table: str) -> tuple:
        try:
            return table, load_table(spark, paths[table], table, layer, free_text), LOADED, None
        except Exception as error:  # a bad source must not stop the others
            if isinstance(error, PySparkException) and error.getCondition() == "PATH_NOT_FOUND":
                return table, None, SKIPPED, None
            return table, None, FAILED, cause(error)

    with ThreadPoolExecutor(PARALLEL_LOADS) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(outcome), table) for table in paths]
        results = [done.result() for done in started]
    return spark.createDataFrame(
        results, "table_name STRING, rows BIGINT, outcome STRING, error STRING"
    )
