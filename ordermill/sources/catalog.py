"""Layer names, table registration and table-level writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import RAW
from . import versions

# The layers, and the tables that must exist before the staging models run.
RAW_LAYER, STAGING_LAYER, MARTS_LAYER = "raw", "staging", "marts"
REQUIRED_RAW_TABLES = (*RAW, "streaming_orders")


def layer_for(custom: str | None, default: str) -> str:
    """A custom layer name is used as it is, only trimmed; otherwise the default."""
    return custom.strip() if custom is not None else default


def table_in(layer: str, name: str) -> str:
    return f"{layer}.{name}"


def create_layers(spark: SparkSession, *layers: str, location: str | None = None) -> None:
    for layer in layers:
        place = f" LOCATION '{location}/{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{place}")


def source(spark: SparkSession, name: str, layer: str = RAW_LAYER) -> DataFrame:
    """A declared raw table by name."""
    if name not in RAW:
        raise KeyError(f"{name} is not a declared source")
    return spark.table(table_in(layer, name))


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def publish_sql_view(spark: SparkSession, name: str, statement: str) -> None:
    """A view in the catalog; one that is there is redefined in a single step."""
    there = spark.catalog.tableExists(name)
    spark.sql(f"ALTER VIEW {name} AS {statement}" if there else f"CREATE VIEW {name} AS {statement}")


def publish_table(df: DataFrame, table: str, sort_by: list[str] | None = None) -> DataFrame:
    """Replace a table's contents in one step and refresh its statistics."""
    if sort_by:
        df = df.hint("rebalance").sortWithinPartitions(*sort_by)
    return versions.publish(df, table, statistics=True)


def store_raw(df: DataFrame, name: str, layer: str = RAW_LAYER) -> None:
    """Replace a raw table in one step.

    Rows are written by the tasks that read them: a table is not moved just to be stored, and rows that came together, as those
    of one order, stay together for the sums and joins that follow.
    """
    versions.publish(df, table_in(layer, name))


def column_statistics(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """Statistics of a stored table's columns, gathered in one pass and read back from the catalog, where the planner finds them too.

    One row per column: smallest and largest value as text (none for text columns), number of NULLs, and an estimate of
    the number of different values.
    """
    name = versions.named(table, versions.current(spark, table))
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    rows = []
    for column in columns:
        told = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} {column}").collect()}
        known = {k: None if told[k] == "NULL" else told[k] for k in ("min", "max", "num_nulls", "distinct_count")}
        rows.append((column, known["min"], known["max"], int(known["num_nulls"]), int(known["distinct_count"])))
    return spark.createDataFrame(rows, "column_name STRING, min STRING, max STRING, nulls BIGINT, distinct_estimate BIGINT")


def _columns_sql(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_if_absent(spark: SparkSession, table: str, schema: T.StructType, partition: str | None = None) -> None:
    by = f" PARTITIONED BY ({partition})" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_columns_sql(schema)}) USING parquet{by}")


def recreate(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Replace a table, whatever its columns, by an empty one with the given columns."""
    versions.publish(empty_like(spark, schema), table)


def recreate_raw_tables(spark: SparkSession, layer: str = RAW_LAYER) -> None:
    for name, schema in RAW.items():
        recreate(spark, table_in(layer, name), schema)


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def table_presence(
    spark: SparkSession, names: tuple[str, ...] = REQUIRED_RAW_TABLES, layer: str = RAW_LAYER
) -> DataFrame:
    rows = [(name, spark.catalog.tableExists(table_in(layer, name))) for name in names]
    return spark.createDataFrame(rows, "table_name STRING, present BOOLEAN")


def require_tables(
    spark: SparkSession, names: tuple[str, ...] = REQUIRED_RAW_TABLES, layer: str = RAW_LAYER
) -> None:
    missing = [n for n in names if not spark.catalog.tableExists(table_in(layer, n))]
    if missing:
        raise LookupError(f"missing tables in {layer}: {', '.join(missing)}")
