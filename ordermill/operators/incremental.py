"""Keyed and incremental writes.

The functions up to ``insert_if_absent`` describe the new contents of a table as a
DataFrame. ``apply_batch`` carries a delete-and-insert out on a stored table.
"""

from __future__ import annotations

from datetime import date, datetime, time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import moment
from ..session import settle
from ..sources import versions

# Fixed value: the watermark of an empty target.
BEFORE_EVERYTHING = date(1900, 1, 1)


def watermark(target: DataFrame, column: str) -> date:
    """Newest value in the target; a single value on the driver, so pruning is static."""
    return target.agg(F.max(column)).first()[0] or BEFORE_EVERYTHING


def not_before(source: DataFrame, column: str, day: date) -> DataFrame:
    """Source rows from the start of the day on, that day included; NULL is left out.

    The bound is a timestamp literal on the stored column, so it reaches the file scan.
    """
    return source.where(F.col(column) >= moment(datetime.combine(day, time.min)))


def delete_insert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the batch's keys, plus the whole batch.

    Duplicate keys inside the batch all stay, which a SQL merge would not allow.
    """
    replaced = batch.select(*keys).distinct()
    return target.join(replaced, keys, "left_anti").select(*batch.columns).unionByName(batch)


def sync_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target in the batch's shape: new columns NULL, columns the batch lacks dropped."""
    present = set(target.columns)
    return target.select(
        *(
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in batch.schema.fields
        )
    )


def _all_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], updated: list[str]) -> DataFrame:
    """Insert new keys; for known ones overwrite the ``updated`` columns and keep the rest.

    A key that comes twice in one batch is an error, as a row cannot be updated twice by
    one statement. Rows with a NULL key match nothing and are inserted as they are.
    """
    complete = _all_present(keys)
    row = F.struct(*batch.columns)
    once = (
        batch.where(complete)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_copies"), F.any_value(row).alias("_new"))
        .withColumn(
            "_new",
            F.when(F.col("_copies") == 1, F.col("_new")).otherwise(
                F.raise_error(F.lit("a key occurs twice in the batch")).cast(batch.select(row).schema[0].dataType)
            ),
        )
    )
    known = target.withColumn("_known", F.lit(True)).alias("t")
    merged = known.join(once.alias("b"), keys, "full_outer")

    def merged_column(name: str) -> Column:
        if name in keys:
            return F.col(name)
        incoming = F.col(f"_new.{name}") if name in batch.columns else F.lit(None)
        old = F.col(f"t.{name}")
        if name in updated:
            return F.when(F.col("_copies").isNotNull(), incoming).otherwise(old).alias(name)
        return F.when(F.col("_known"), old).otherwise(incoming).alias(name)

    keyless = sync_columns(batch.where(~complete), target)
    return merged.select(*(merged_column(c) for c in target.columns)).unionByName(keyless)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the batch rows whose key it lacks; existing rows win.

    Of several batch rows with one key a single one is inserted: the smallest.
    """
    complete = _all_present(keys)
    others = [c for c in batch.columns if c not in keys]
    one_each = (
        batch.where(complete)
        .groupBy(*keys)
        .agg(F.min(F.struct(*others, *keys)).alias("_row"))
        .select("_row.*")
        .select(*batch.columns)
    )
    added = one_each.join(target.select(*keys), keys, "left_anti").select(*batch.columns)
    return target.unionByName(added).unionByName(batch.where(~complete))


def month_of(column: str) -> Column:
    return F.date_format(column, "yyyy-MM")


def _laid_out(df: DataFrame, sort_by: list[str]) -> DataFrame:
    """By month, sorted inside files so that their statistics prune.

    The rebalance hint splits a month that is far larger than others over several tasks and
    joins small ones.
    """
    return df.hint("rebalance", "part_month").sortWithinPartitions("part_month", *sort_by)


def months_of(spark: SparkSession, table: str, keys: DataFrame, key: str) -> DataFrame:
    """Months that hold rows of the keys, read from the index without a shuffle of it."""
    index = spark.table(versions.keys_of(table, versions.current(spark, table)))
    return index.join(keys.select(key).distinct(), key, "left_semi").select("part_month").distinct()


def _store_version(
    rows: DataFrame, table: str, number: int, sort_by: list[str], buckets: int, kept: dict[str | None, int]
) -> None:
    """The next version from the rows of its new months and the months it takes over: rows, index of keys, then the switch.

    The index has every (key, month) once, for the months in whose folders the rows are, so it neither grows nor goes stale.
    """
    spark = rows.sparkSession
    name, key = versions.named(table, number), sort_by[0]
    versions.write_months(_laid_out(rows, sort_by), table, number, "data", name)
    found = spark.table(name).select(key, "part_month").distinct()
    versions.write_months(found.repartition(buckets, key), table, number, "keys", versions.keys_of(table, number), (buckets, key))
    versions.take_over(spark, table, number, kept)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('buckets' = '{buckets}')")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS{' NOSCAN' if kept else ''}")
    versions.switch(spark, table, number)


def store_fact(df: DataFrame, table: str, day_column: str, sort_by: list[str]) -> None:
    """Replace a fact, partitioned by month; the old contents stay until the new ones are complete."""
    spark = df.sparkSession
    monthly = df.withColumn("part_month", month_of(day_column))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _store_version(monthly, table, versions.following(spark, table), sort_by, buckets, {})


def stored_watermark(spark: SparkSession, table: str, column: str) -> date:
    """Newest day of a fact, read from its newest month only."""
    listed = versions.months(spark, table, versions.current(spark, table))
    known = [m for m in listed if m is not None]
    if not known:
        return BEFORE_EVERYTHING
    return watermark(spark.table(table).where(F.col("part_month") == max(known)), column)


def _in_months(months: set[str | None]) -> Column:
    known = F.col("part_month").isin(*(m for m in months if m is not None))
    return known | F.col("part_month").isNull() if None in months else known


def _shape(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema.fields if f.name != "part_month"}


def apply_batch(
    spark: SparkSession, table: str, batch: DataFrame, keys: list[str], day_column: str, sort_by: list[str]
) -> None:
    """Delete-and-insert on a table written by ``store_fact``.

    Only months that hold a replaced key or receive a row are written anew, once, as part of the next version, which
    takes over the other months as they are, see ``versions``. A run that fails changes nothing. A batch with
    other columns or types than the table leads to a new version of all months.
    """
    target = spark.table(table)
    if _shape(target) != _shape(batch):
        whole = delete_insert(sync_columns(target.drop("part_month"), batch), batch, keys)
        store_fact(whole, table, day_column, sort_by)
        return

    columns = target.columns
    arriving = settle(batch.withColumn("part_month", month_of(day_column)).select(*columns))
    replaced = arriving.select(*keys).distinct()
    # One value per month, no more than the partition listing the driver already holds.
    found = months_of(spark, table, replaced, sort_by[0]).union(arriving.select("part_month")).distinct()
    touched = {m.part_month for m in found.collect()}
    if not touched:
        return

    staying = target.where(_in_months(touched)).join(replaced, keys, "left_anti").select(*columns)
    number = versions.following(spark, table)
    before = versions.months(spark, table, number - 1)
    buckets = int(versions.properties(spark, versions.named(table, number - 1))["buckets"])
    kept = {m: v for m, v in before.items() if m not in touched}
    _store_version(staying.unionByName(arriving), table, number, sort_by, buckets, kept)


def store_keyed(df: DataFrame, table: str) -> None:
    """Replace a table without partitions by the result of a keyed write that read it."""
    versions.publish(df.hint("rebalance"), table, statistics=True)
