"""Stored tables whose contents are replaced by one change of the catalog.

The name that readers use is a view over the newest version, a table of its own in a folder of its own. A write builds
the next version beside it and then points the view at it, which is a single step: readers see all old or all new
rows, columns included, and a run that fails before it leaves the old table as it was. What such a run left behind has the number that the
next run takes, and is overwritten by it. The version before the newest one stays for readers that are still at it; older ones go.

A version that is partitioned by month may take over months from the one before. Its properties name, for every
month, the version in whose folder the rows are; the index of keys, if there is one, lies beside them, so rows, months and
index change in the same step.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from . import folders

PARTITION = "part_month"
_MONTH = "month."
_ABSENT = "__HIVE_DEFAULT_PARTITION__"


def home(spark: SparkSession, table: str) -> str:
    """Folder of a table's versions."""
    layer, _, name = table.rpartition(".")
    return f"{spark.catalog.getDatabase(layer or 'default').locationUri.rstrip('/')}/{name}_versions"


def named(table: str, number: int) -> str:
    """Catalog name of one version."""
    return f"{table}__v{number}"


def keys_of(table: str, number: int) -> str:
    """Catalog name of the index of keys of one version."""
    return f"{table}__keys_v{number}"


def current(spark: SparkSession, table: str) -> int | None:
    """Number of the version that readers see; none if the table has not been stored by this module."""
    if not spark.catalog.tableExists(table):
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'View Text'").first()
    found = text and re.search(r"__v(\d+)`?$", text.data_type.strip())
    return int(found.group(1)) if found else None


def following(spark: SparkSession, table: str) -> int:
    """Number of the next version; what a failed run left under it is cleared."""
    number = (current(spark, table) or 0) + 1
    for name in (named(table, number), keys_of(table, number)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    folders.remove(spark, f"{home(spark, table)}/v{number}")
    return number


def switch(spark: SparkSession, table: str, number: int) -> None:
    """Show readers a version, complete by now, in one step; then let go of those nobody should be reading."""
    chosen = f"SELECT * FROM {named(table, number)}"
    if current(spark, table) is not None:
        spark.sql(f"ALTER VIEW {table} AS {chosen}")
    else:
        if spark.catalog.tableExists(table):
            # A table made by other means keeps its rows as version 0; only this first time is the name absent for a moment.
            spark.sql(f"ALTER TABLE {table} RENAME TO {named(table, 0)}")
        spark.sql(f"CREATE VIEW {table} AS {chosen}")
    _let_go(spark, table, number)


def publish(df: DataFrame, table: str, statistics: bool = False, bucket_by: tuple[int, str] | None = None) -> DataFrame:
    """Replace a table by the rows of ``df``, which may have been read from it."""
    spark = df.sparkSession
    number = following(spark, table)
    writer = df.write.format("parquet").option("path", f"{home(spark, table)}/v{number}/data").mode("overwrite")
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(named(table, number))
    if statistics:
        spark.sql(f"ANALYZE TABLE {named(table, number)} COMPUTE STATISTICS")
    switch(spark, table, number)
    return spark.table(table)


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def months(spark: SparkSession, table: str, number: int) -> dict[str | None, int]:
    """For every month of a version, the version in whose folder it is stored."""
    found = properties(spark, named(table, number))
    return {_unnamed(k.removeprefix(_MONTH)): int(v) for k, v in found.items() if k.startswith(_MONTH)}


def _unnamed(folder: str) -> str | None:
    return None if folder == _ABSENT else folder


def folder_of(month: str | None) -> str:
    return f"{PARTITION}={_ABSENT if month is None else month}"


def write_months(df: DataFrame, table: str, number: int, kind: str, name: str, bucket_by: tuple[int, str] | None = None) -> None:
    """Store rows by month as one of the tables of a version."""
    writer = df.write.format("parquet").partitionBy(PARTITION)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.option("path", f"{home(df.sparkSession, table)}/v{number}/{kind}").mode("overwrite").saveAsTable(name)


def take_over(spark: SparkSession, table: str, number: int, kept: dict[str | None, int]) -> None:
    """Complete a version by months that are stored with older ones, and note where each month is."""
    own = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {named(table, number)}").collect()]
    root = home(spark, table)
    for kind, name in (("data", named(table, number)), ("keys", keys_of(table, number))):
        parts = " ".join(
            f"PARTITION ({PARTITION} = {'NULL' if m is None else repr(m)}) LOCATION '{root}/v{v}/{kind}/{folder_of(m)}'"
            for m, v in kept.items()
        )
        if parts:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    places = kept | {None if m in (_ABSENT, "null") else m: number for m in own}
    if places:
        listed = ", ".join(f"'{_MONTH}{_ABSENT if m is None else m}' = '{v}'" for m, v in places.items())
        spark.sql(f"ALTER TABLE {named(table, number)} SET TBLPROPERTIES ({listed})")


def _let_go(spark: SparkSession, table: str, number: int) -> None:
    """Drop the versions before the previous one, with the folders that the two that stay do not use."""
    used = {(m, v) for n in (number, number - 1) if spark.catalog.tableExists(named(table, n)) for m, v in months(spark, table, n).items()}
    root = home(spark, table)
    old = number - 2
    while old >= 0 and spark.catalog.tableExists(named(table, old)):
        placed = months(spark, table, old)
        for name in (named(table, old), keys_of(table, old)):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for month, version in placed.items():
            if (month, version) not in used:
                for kind in ("data", "keys"):
                    folders.remove(spark, f"{root}/v{version}/{kind}/{folder_of(month)}")
        if not any(v == old for _, v in used):
            folders.remove(spark, f"{root}/v{old}")
        old -= 1
