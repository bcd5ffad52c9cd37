"""Partitioned Parquet lake and reads from several stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_by_day(df: DataFrame, moment: Column, path: str, mode: str = "append") -> None:
    """Write below ``year=/month=/day=`` folders.

    The rebalance hint sizes the files: a day with far more rows than others is spread
    over several tasks, small days share one.
    """
    (
        df.withColumns(
            {"year": F.year(moment), "month": F.month(moment), "day": F.dayofmonth(moment)}
        )
        .hint("rebalance", "year", "month", "day")
        .write.mode(mode)
        .partitionBy("year", "month", "day")
        .parquet(path)
    )


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def jdbc_options(
    url: str, table: str, split_column: str, low: object, high: object, splits: int
) -> dict[str, str]:
    """Options for a parallel database read: ranges of ``split_column`` become partitions."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": split_column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(splits),
        "fetchsize": "10000",
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
    }


def read_warehouse(spark: SparkSession, source: str | dict[str, str]) -> DataFrame:
    """A warehouse table: Parquet path, catalog name, or JDBC options.

    Whatever the store, the result joins with lake tables in one plan, and filters and
    column lists are pushed to it.
    """
    if isinstance(source, dict):
        return spark.read.format("jdbc").options(**source).load()
    if "/" in source:
        return spark.read.parquet(source)
    return spark.table(source)
