"""The full build: raw tables, staging views, gate, marts, gate."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import incremental, quality
from ..operators.staging import STAGING, stage, stg_orders_payments, view_statements
from ..schemas import ORDER_EVENT
from ..sources import versions
from ..sources.catalog import (
    MARTS_LAYER, RAW_LAYER, REQUIRED_RAW_TABLES, STAGING_LAYER, create_if_absent, create_layers, layer_for,
    publish_sql_view, publish_table, publish_view, require_tables, source, store_raw, table_in,
)
from ..streaming import ingest
from . import marts
from .checks import MARTS_CHECKS, STAGING_CHECKS

# Keys of the incremental facts.
FACT_KEYS = {"fact_order_items": ["order_id", "order_item_id"], "fact_payments": ["order_id"]}
STREAM_TABLE = "streaming_orders"
STREAM_PARTITION = "batch_id"
STREAM_SCHEMA = T.StructType(
    [*ORDER_EVENT.fields, T.StructField("loaded_at", T.TimestampType()), T.StructField(STREAM_PARTITION, T.StringType())]
)
PARALLEL_MODELS = 4


def load_raw(spark: SparkSession, raw: dict[str, DataFrame], layer: str = RAW_LAYER) -> dict[str, DataFrame]:
    """Store the raw tables and give them back as declared sources."""
    _together(spark, [lambda n=n, df=df: store_raw(df, n, layer) for n, df in raw.items()])
    return {name: source(spark, name, layer) for name in raw}


def staging_models(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    models = {name: stage(raw[table], name) for name, (_, table) in STAGING.items() if table in raw}
    if "stg_payments" in models:
        models["stg_orders_payments"] = stg_orders_payments(models["stg_payments"])
    return models


def build_staging(raw: dict[str, DataFrame], layer: str = STAGING_LAYER) -> dict[str, DataFrame]:
    """Register the staging models of any DataFrames as views of this session, under the name of their layer."""
    return {name: publish_view(df, f"{layer}__{name}") for name, df in staging_models(raw).items()}


def staging_views(spark: SparkSession, raw_layer: str = RAW_LAYER, layer: str = STAGING_LAYER) -> dict[str, DataFrame]:
    """The staging models over the stored raw tables as views in the catalog, which every session can read by name.

    They hold no data of their own, so they show what the raw tables hold at the time of reading.
    """
    create_layers(spark, layer)
    for name, statement in view_statements(raw_layer, layer).items():
        publish_sql_view(spark, table_in(layer, name), statement)
    return {name: spark.table(table_in(layer, name)) for name in view_statements(raw_layer, layer)}


def load_stream(spark: SparkSession, source: str, target: str, checkpoint: str, layer: str = RAW_LAYER) -> list:
    """Take new event files in and append their good rows to the stream table of the raw layer.

    The table has a partition for every batch, so what it lacks is plain from its own listing: a batch that an earlier run took in
    and did not append is appended by this one, and one whose append broke off is written over. Returns the files that could not be read.
    """
    table = table_in(layer, STREAM_TABLE)
    create_if_absent(spark, table, STREAM_SCHEMA, STREAM_PARTITION)
    failed = ingest.ingest(spark, source, target, checkpoint)
    there = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    new = [b for b in ingest.batches(spark, target) if b not in there]
    if new:
        _write_batches(ingest.stream_table(spark, target, new).select(*STREAM_SCHEMA.names), table)
        _enter_batches(spark, table, new)
    return failed


def _write_batches(rows: DataFrame, table: str) -> None:
    """Rows into the folders of their batches, which nobody sees yet; what a broken run wrote there is replaced."""
    described = rows.sparkSession.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(STREAM_PARTITION).parquet(described.data_type)


def _enter_batches(spark: SparkSession, table: str, new: list[str]) -> None:
    """All at once into the table's listing, those without a good row as well, so that they are not read again."""
    listed = " ".join(f"PARTITION ({STREAM_PARTITION} = '{b}')" for b in new)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {listed}")


def _together(spark: SparkSession, tasks: list[Callable[[], object]]) -> None:
    """Submit independent table writes at the same time."""
    with ThreadPoolExecutor(PARALLEL_MODELS) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]:
            done.result()


def refresh_fact(
    spark: SparkSession,
    table: str,
    orders: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    keys: list[str],
    full_refresh: bool = False,
) -> None:
    """First run: all orders. Later runs: orders from the newest stored day on."""
    if full_refresh or versions.current(spark, table) is None:
        incremental.store_fact(build(orders), table, "order_date_id", keys)
        return
    newest = incremental.stored_watermark(spark, table, "order_date_id")
    batch = build(incremental.not_before(orders, "purchased_at", newest))
    incremental.apply_batch(spark, table, batch, keys, "order_date_id", keys)


def daily_mart(stored: dict[str, DataFrame]) -> DataFrame:
    """The daily mart of stored tables.

    Items are spread once by two columns of the mart's triples, so that neither the distinct orders nor the sums of the triples move them
    again. All these tables are in one task then, so the number of parts is kept and not reduced to few large ones.
    """
    fact = stored["fact_order_items"]
    parts = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return marts.mart_revenue_daily(
        fact.repartition(parts, "order_date_id", "customer_id"), stored["dim_date"], stored["dim_products"], stored["dim_customers"]
    )


def build_marts(
    spark: SparkSession,
    staged: dict[str, DataFrame],
    layer: str = MARTS_LAYER,
    first_day: date = marts.CALENDAR_START,
    last_day: date = marts.CALENDAR_END,
    full_refresh: bool = False,
) -> dict[str, DataFrame]:
    """Write dimensions and facts, then the daily mart from the stored tables."""

    def name(model: str) -> str:
        return table_in(layer, model)

    dimensions = {
        "dim_date": lambda: marts.dim_date(spark, first_day, last_day),
        "dim_customers": lambda: marts.dim_customers(staged["stg_customers"]),
        "dim_sellers": lambda: marts.dim_sellers(staged["stg_sellers"]),
        "dim_products": lambda: marts.dim_products(
            staged["stg_products"], staged["stg_category_translation"]
        ),
        "dim_geolocation": lambda: marts.dim_geolocation(staged["stg_geolocation"]),
    }
    facts = {
        "fact_order_items": lambda orders: marts.fact_order_items(staged["stg_order_items"], orders),
        "fact_payments": lambda orders: marts.fact_payments(orders, staged["stg_orders_payments"]),
    }
    tasks: list[Callable[[], object]] = [
        lambda m=m, make=make: refresh_fact(
            spark, name(m), staged["stg_orders"], make, FACT_KEYS[m], full_refresh
        )
        for m, make in facts.items()
    ]
    tasks += [lambda m=m, make=make: publish_table(make(), name(m)) for m, make in dimensions.items()]
    _together(spark, tasks)

    stored = {m: spark.table(name(m)) for m in (*dimensions, *facts)}
    daily = daily_mart(stored)
    # The order asked for is a global one, by day and category.
    stored["mart_revenue_daily"] = publish_table(
        daily.orderBy("date_day", "product_category"), name("mart_revenue_daily")
    )
    return stored


def run(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    layer: str = MARTS_LAYER,
    first_day: date = marts.CALENDAR_START,
    last_day: date = marts.CALENDAR_END,
    full_refresh: bool = False,
    staging_layer: str | None = None,
    raw_layer: str | None = None,
    stream: tuple[str, str, str] | None = None,
) -> dict[str, DataFrame]:
    """Build everything; failing staging checks stop the run before the marts are touched.

    With a raw layer, its tables must be there before anything else happens, and the staging views go into the
    catalog; without one they are views of this session over ``raw``. ``stream`` (source, target and
    checkpoint of the events) is then loaded into that layer before the staging views are made.
    """
    if raw_layer is not None:
        if stream:
            create_if_absent(spark, table_in(raw_layer, STREAM_TABLE), STREAM_SCHEMA, STREAM_PARTITION)
        require_tables(spark, REQUIRED_RAW_TABLES if stream else tuple(raw), raw_layer)
        if stream:
            load_stream(spark, *stream, raw_layer)
    staging_layer = layer_for(staging_layer, STAGING_LAYER)
    staged = build_staging(raw, staging_layer) if raw_layer is None else staging_views(spark, raw_layer, staging_layer)
    quality.gate(quality.report(staged, STAGING_CHECKS))
    stored = build_marts(spark, staged, layer, first_day, last_day, full_refresh)
    checked = {c.model for c in MARTS_CHECKS}
    models = {m: df for m, df in stored.items() if m in checked} | {
        m: staged[m] for m in ("stg_orders", "stg_products")
    }
    quality.gate(quality.report(models, MARTS_CHECKS))
    return stored
