"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.dates import moment
from .operators import incremental, quality, sampling, staging
from .plans import checks, gold, marts, metrics, pipeline
from .session import fresh_path, settle
from .sources import catalog, csv, folders, lake, rates, star
from .streaming import enrich, ingest

Query = Callable[[SparkSession, str], DataFrame]

# The given orders lie in these years; the default calendar starts later.
FIRST_DAY, LAST_DAY = date(1995, 1, 1), date(2002, 12, 31)
# Scenario values: last day of a first load, the orders sampled, one API response.
FIRST_LOAD_UNTIL = datetime(2000, 1, 1)
SAMPLED_STATUS, SAMPLE_SIZE, SAMPLE_SEED = "delivered", 100, "clone"
# Columns whose statistics are gathered, and how far an estimate may be off: over three standard errors of the sketch.
STATISTICS_OF, ESTIMATE_WITHIN = ("order_id", "order_item_id", "order_date_id", "price"), 0.16
# Event files of the bad-file scenario, and those of them that are cut off.
EVENT_SLOTS, CUT_SLOTS = 16, (3, 5)
STREAM_COLUMNS = (
    "order_id", "customer_state", "product", "price", "freight_value", "total_amount",
    "payment_type", "order_status", "review_score", "created_at", "event_timestamp",
)
RATE_RESPONSES = (
    '{"result": "success", "time_last_update_unix": 1704067200, "rates": {"USD": 1, "BRL": 5.4, "VND": 25400}}',
    '{"result": "success", "time_last_update_unix": 1703980800, "rates": {"USD": 1, "BRL": 4.9, "VND": 25300}}',
)


def _staged(spark: SparkSession, sf: str, model: str) -> DataFrame:
    return staging.stage(star.raw(spark, sf, staging.STAGING[model][1]), model)


def _order_payments(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_orders_payments(_staged(spark, sf, "stg_payments"))


def _dim_products(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_products(
        _staged(spark, sf, "stg_products"), _staged(spark, sf, "stg_category_translation")
    )


def _dim_customers(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_customers(_staged(spark, sf, "stg_customers"))


def _fact_items(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fact_order_items(_staged(spark, sf, "stg_order_items"), _staged(spark, sf, "stg_orders"))


def _fact_payments(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fact_payments(_staged(spark, sf, "stg_orders"), _order_payments(spark, sf))


def _days(spark: SparkSession) -> DataFrame:
    return marts.dim_date(spark, FIRST_DAY, LAST_DAY)


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.order_analytics_gold(
        _fact_items(spark, sf), _dim_customers(spark, sf), _staged(spark, sf, "stg_products")
    )


def _all_raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: star.raw(spark, sf, name) for name in star.RAW_TABLES}


def _fresh_layer(spark: SparkSession, label: str) -> str:
    path = fresh_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


# Staging and dimensions


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    orders = marts.dated_orders(_staged(spark, sf, "stg_orders"))
    return marts.dim_date_covering(orders, "order_date_id")


def dim_sellers(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_sellers(_staged(spark, sf, "stg_sellers"))


def dim_geolocation(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_geolocation(_staged(spark, sf, "stg_geolocation"))


def clean_customers(spark: SparkSession, sf: str) -> DataFrame:
    return staging.clean_customers(_staged(spark, sf, "stg_customers"))


def text_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose times come as text, those of every seventh order being none, staged with tolerance."""
    raw = star.raw(spark, sf, "orders")
    broken = F.when(F.col("order_id").cast("bigint") % 7 == 0, F.lit("unknown"))
    texts = {
        c: F.coalesce(broken, F.col(c).cast("string"))
        for c in ("order_purchase_timestamp", "order_delivered_customer_date")
    }
    return staging.stg_orders(raw.withColumns(texts), tolerant=True)


def product_volume(spark: SparkSession, sf: str) -> DataFrame:
    return staging.product_volume(_staged(spark, sf, "stg_products")).select("product_id", "volume_cm3")


def mart_revenue_daily(spark: SparkSession, sf: str) -> DataFrame:
    return marts.mart_revenue_daily(
        _fact_items(spark, sf), _days(spark), _dim_products(spark, sf), _dim_customers(spark, sf)
    )


def revenue_by_day_product_customer(spark: SparkSession, sf: str) -> DataFrame:
    return marts.revenue_by_day_product_customer(_fact_items(spark, sf))


# Incremental and keyed writes, each carried out on stored tables


def _first_load(spark: SparkSession, sf: str) -> DataFrame:
    """Orders known at the first load."""
    orders = _staged(spark, sf, "stg_orders")
    return orders.where(F.col("purchased_at") <= moment(FIRST_LOAD_UNTIL))


def fact_order_items_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """First load with freight still unknown, then one incremental run over everything."""
    table = f"{_fresh_layer(spark, 'marts')}.fact_order_items"
    items = _staged(spark, sf, "stg_order_items")
    keys = pipeline.FACT_KEYS["fact_order_items"]
    early = items.withColumn("freight_value", F.lit(0).cast("decimal(10,2)"))
    pipeline.refresh_fact(
        spark, table, _first_load(spark, sf), lambda o: marts.fact_order_items(early, o), keys
    )
    pipeline.refresh_fact(
        spark, table, _staged(spark, sf, "stg_orders"),
        lambda o: marts.fact_order_items(items, o), keys,
    )
    return spark.table(table).drop("part_month")


def fact_payments_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """First load with every payment still in one instalment, then one incremental run."""
    table = f"{_fresh_layer(spark, 'marts')}.fact_payments"
    keys = pipeline.FACT_KEYS["fact_payments"]
    paid = _order_payments(spark, sf)
    early = paid.withColumn("max_installments", F.lit(1))
    pipeline.refresh_fact(
        spark, table, _first_load(spark, sf), lambda o: marts.fact_payments(o, early), keys
    )
    pipeline.refresh_fact(
        spark, table, _staged(spark, sf, "stg_orders"), lambda o: marts.fact_payments(o, paid), keys
    )
    return spark.table(table).drop("part_month")


def column_sync(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch brings the order total as a new column and no longer has the customer."""
    table = f"{_fresh_layer(spark, 'marts')}.fact_payments"
    keys = pipeline.FACT_KEYS["fact_payments"]
    paid = _order_payments(spark, sf)
    pipeline.refresh_fact(
        spark, table, _first_load(spark, sf), lambda o: marts.fact_payments(o, paid), keys
    )

    def changed(orders: DataFrame) -> DataFrame:
        fact = marts.fact_payments(orders, paid)
        return fact.drop("customer_id").withColumn("is_split", F.col("payment_count") > 1)

    pipeline.refresh_fact(spark, table, _staged(spark, sf, "stg_orders"), changed, keys)
    return spark.table(table).drop("part_month")


def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Sellers by id are overwritten in city and inserted where new, from the customers."""
    target = _staged(spark, sf, "stg_sellers")
    batch = _staged(spark, sf, "stg_customers").select(
        F.col("customer_id").alias("seller_id"),
        F.col("customer_zip_code_prefix").alias("seller_zip_code_prefix"),
        F.col("customer_city").alias("seller_city"),
        F.col("customer_state").alias("seller_state"),
    )
    table = f"{_fresh_layer(spark, 'marts')}.sellers"
    incremental.store_keyed(target, table)
    incremental.store_keyed(incremental.upsert(spark.table(table), batch, ["seller_id"], ["seller_city"]), table)
    return spark.table(table)


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Review scores per order stay; orders without one get their smallest item number."""
    target = _staged(spark, sf, "stg_reviews").select("order_id", F.col("review_score").alias("n"))
    batch = _staged(spark, sf, "stg_order_items").select("order_id", F.col("order_item_id").alias("n"))
    table = f"{_fresh_layer(spark, 'marts')}.scores"
    incremental.store_keyed(target, table)
    incremental.store_keyed(incremental.insert_if_absent(spark.table(table), batch, ["order_id"]), table)
    return spark.table(table)


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The first contents, without states, are replaced as a whole."""
    table = f"{_fresh_layer(spark, 'marts')}.dim_customers"
    customers = _dim_customers(spark, sf)
    catalog.publish_table(customers.withColumn("customer_state", F.lit("none")), table)
    return catalog.publish_table(customers, table)


def column_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of the stored order-item fact; the estimate of different values is held against the exact number."""
    table = f"{_fresh_layer(spark, 'marts')}.fact_order_items"
    incremental.store_fact(_fact_items(spark, sf), table, "order_date_id", pipeline.FACT_KEYS["fact_order_items"])
    found = catalog.column_statistics(spark, table, list(STATISTICS_OF))
    exact = spark.table(table).agg(*(F.count_distinct(c).alias(c) for c in STATISTICS_OF))
    counted = exact.unpivot([], list(STATISTICS_OF), "column_name", "n_distinct")
    near = F.abs(F.col("distinct_estimate") - F.col("n_distinct")) <= F.col("n_distinct") * ESTIMATE_WITHIN
    return found.join(counted, "column_name").select("column_name", "min", "max", "nulls", "n_distinct", near.alias("near"))


def append_only(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads of the payments into one table accumulate."""
    path = fresh_path(spark, "payments")
    for _ in range(2):
        _staged(spark, sf, "stg_payments").write.mode("append").parquet(path)
    return metrics.payment_preference(spark.read.parquet(path))


# Cross-source queries


def gold_stream_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return gold.newest_first(gold.enrich_with_events(_gold(spark, sf), star.order_events(spark, sf)))


def gold_stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    latest = gold.latest_event_per_order(star.order_events(spark, sf))
    return gold.enriched_items(_fact_items(spark, sf), _dim_customers(spark, sf), _staged(spark, sf, "stg_products"), latest)


def gold_latest_event(spark: SparkSession, sf: str) -> DataFrame:
    return gold.latest_event_per_order(star.order_events(spark, sf))


def gold_revenue_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return gold.revenue_by_state_confirmed(_gold(spark, sf), star.order_events(spark, sf))


def unified_orders(spark: SparkSession, sf: str) -> DataFrame:
    return gold.unified_orders(star.order_events(spark, sf), _fact_items(spark, sf))


def federated_read(spark: SparkSession, sf: str) -> DataFrame:
    """Warehouse table by catalog name, lake table by path, in one plan."""
    table = f"{_fresh_layer(spark, 'warehouse')}.gold"
    catalog.publish_table(_gold(spark, sf), table)
    path = fresh_path(spark, "lake")
    star.order_events(spark, sf).write.parquet(path)
    return gold.enrich_with_events(lake.read_warehouse(spark, table), lake.read_lake(spark, path))


# Metrics


def monthly_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.monthly_revenue(_fact_items(spark, sf), _days(spark))


def top_categories(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.top_categories(_fact_items(spark, sf), _dim_products(spark, sf))


def _deliveries(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.deliveries(star.raw(spark, sf, "orders"))


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.table_counts(_all_raw(spark, sf))


def customers_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.customers_by_state(_dim_customers(spark, sf), _staged(spark, sf, "stg_orders"))


def revenue_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.revenue_by_state(_fact_items(spark, sf), _dim_customers(spark, sf))


def seller_revenue_rating(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.seller_revenue_rating(_fact_items(spark, sf), _staged(spark, sf, "stg_reviews"))


def freight_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.freight_by_category(_fact_items(spark, sf), _dim_products(spark, sf))


def rfm_segments(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.rfm_segments(_fact_items(spark, sf), _dim_customers(spark, sf))


def currency_convert(spark: SparkSession, sf: str) -> DataFrame:
    responses = spark.createDataFrame([(r,) for r in RATE_RESPONSES], "body STRING")
    rate = rates.latest_rate(rates.parse_rates(responses))
    monthly = monthly_revenue(spark, sf)
    return rates.convert(monthly, "gross_revenue", rate, "gross_revenue_usd")


# Data checks


def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    """Orders without a delivery time."""
    return quality.not_null(_staged(spark, sf, "stg_orders"), "delivered_at").select("order_id", "order_status")


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Orders listed under more than one item."""
    return quality.unique(_staged(spark, sf, "stg_order_items"), "order_id")


def dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose status is not an order status."""
    events = star.order_events(spark, sf)
    wanted = (*checks.ORDER_STATUSES, "view", "click")
    return quality.accepted_values(events, "order_status", wanted).select(
        "order_id", "order_status", "created_at"
    )


def dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that no event mentions."""
    events = star.order_events(spark, sf)
    items = _staged(spark, sf, "stg_order_items")
    return quality.relationships(items, "order_id", events, "order_id")


def dq_accepted_range_strict(spark: SparkSession, sf: str) -> DataFrame:
    """Items without freight: it is not above zero."""
    items = _staged(spark, sf, "stg_order_items")
    failing = quality.accepted_range(items, "freight_value", 0, inclusive=False)
    return failing.select("order_id", "order_item_id", "product_id", "freight_value")


def dq_accepted_range_inclusive(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' coordinates below zero."""
    places = _staged(spark, sf, "stg_geolocation")
    return quality.accepted_range(places, "geolocation_lat", 0).select(
        "geolocation_zip_code_prefix", "geolocation_lat"
    )


def dq_staging_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.report(pipeline.staging_models(_all_raw(spark, sf)), checks.STAGING_CHECKS)


def dq_marts_report(spark: SparkSession, sf: str) -> DataFrame:
    models = {
        "fact_order_items": _fact_items(spark, sf),
        "dim_customers": _dim_customers(spark, sf),
        "dim_products": _dim_products(spark, sf),
        "stg_orders": _staged(spark, sf, "stg_orders"),
        "stg_products": _staged(spark, sf, "stg_products"),
    }
    return quality.report(models, checks.MARTS_CHECKS)


def required_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Presence and row count of the raw tables; all but the stream table are stored first."""
    layer = _fresh_layer(spark, "raw")
    tables = _all_raw(spark, sf)
    for name, df in tables.items():
        df.write.format("parquet").saveAsTable(f"{layer}.{name}")
    counts = metrics.table_counts({name: spark.table(f"{layer}.{name}") for name in tables})
    return catalog.table_presence(spark, layer=layer).join(counts, "table_name", "left")


# Sources and sinks


def csv_load(spark: SparkSession, sf: str) -> DataFrame:
    """All nine raw tables out to CSV and back in as tables: every row as text, with its table."""
    layer, folder = _fresh_layer(spark, "raw"), fresh_path(spark, "csv")
    paths = csv.paths_below(folder)
    for name, path in paths.items():
        csv.write_csv(star.raw(spark, sf, name), path)
    csv.load_tables(spark, paths, layer)

    def as_text(name: str) -> DataFrame:
        columns = [c for c in spark.table(f"{layer}.{name}").columns if c != "loaded_at"]
        values = (F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns)
        return spark.table(f"{layer}.{name}").select(F.lit(name).alias("table_name"), F.concat_ws("|", *values).alias("line"))

    return reduce(DataFrame.unionByName, map(as_text, paths))


def csv_text_fidelity(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as review text: line breaks, quotes and commas survive the file."""
    path = fresh_path(spark, "csv")
    documents = star.documents(spark, sf)
    csv.write_csv(
        documents.select(
            F.col("doc_id").cast("string").alias("review_id"),
            F.col("source").alias("order_id"),
            F.lit(None).cast("int").alias("review_score"),
            F.col("lang").alias("review_comment_title"),
            F.col("text").alias("review_comment_message"),
            F.lit(None).cast("timestamp_ntz").alias("review_creation_date"),
            F.lit(None).cast("timestamp_ntz").alias("review_answer_timestamp"),
        ),
        path,
    )
    return csv.read_csv(spark, path, "reviews").select(
        "review_id", "order_id", "review_comment_title", "review_comment_message"
    )


def csv_load_report(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome per table; the payments have no file and are skipped."""
    layer, folder = _fresh_layer(spark, "raw"), fresh_path(spark, "csv")
    paths = {name: f"{folder}/{name}" for name in ("orders", "payments", "products")}
    for name in ("orders", "products"):
        csv.write_csv(star.raw(spark, sf, name), paths[name])
    return csv.load_tables(spark, paths, layer).select("table_name", "rows", "outcome")


def csv_append(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    for _ in range(2):
        csv.append_csv(star.raw(spark, sf, "sellers"), path)
    return csv.read_csv(spark, path, "sellers")


def partitioned_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews below year, month and day folders, counted from the folder columns."""
    path = fresh_path(spark, "lake")
    lake.write_by_day(_staged(spark, sf, "stg_reviews"), F.col("review_created_at"), path)
    return (
        lake.read_lake(spark, path)
        .groupBy("year", "month", "day")
        .agg(F.count(F.lit(1)).alias("reviews"), F.sum("review_score").alias("score_total"))
    )


def _summed(name: str, df: DataFrame) -> DataFrame:
    """Rows and a checksum of the contents; averages and coordinates are left out, as engines write them differently."""
    columns = [c for c, kind in df.dtypes if c != "part_month" and kind != "double"]
    line = F.concat_ws("|", *(F.col(c).cast("string") for c in columns))
    digest = F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")
    return df.agg(
        F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.sum(digest).alias("checksum")
    ).select("table_name", "rows", "checksum")


def staging_views(spark: SparkSession, sf: str) -> DataFrame:
    """All staging views over stored raw tables, read by their names in a session that did not make them."""
    raw_layer = _fresh_layer(spark, "raw")
    pipeline.load_raw(spark, _all_raw(spark, sf), raw_layer)
    layer = f"{raw_layer}_staging"
    names = pipeline.staging_views(spark, raw_layer, layer)
    other = spark.newSession()
    return reduce(DataFrame.unionByName, (_summed(name, other.table(f"{layer}.{name}")) for name in names))


def pipeline_build(spark: SparkSession, sf: str) -> DataFrame:
    """Raw load, stream, staging, gate, marts, gate: rows and a checksum of the contents of every stored table."""
    raw_layer = _fresh_layer(spark, "raw")
    raw = pipeline.load_raw(spark, _all_raw(spark, sf), raw_layer)
    events = (_event_files(spark, sf), fresh_path(spark, "stream"), fresh_path(spark, "ledger"))
    stored = pipeline.run(
        spark, raw, _fresh_layer(spark, "marts"), FIRST_DAY, LAST_DAY, staging_layer=f"{raw_layer}_staging",
        raw_layer=raw_layer, stream=events,
    )
    stored["streaming_orders"] = spark.table(f"{raw_layer}.streaming_orders").select(*STREAM_COLUMNS)
    return reduce(DataFrame.unionByName, (_summed(*table) for table in stored.items()))


# Streaming


def _event_files(spark: SparkSession, sf: str, broken: bool = False) -> str:
    """Event lines as JSON files for card payments, as gzipped text for the others.

    With ``broken``, zipped lines of error events are cut off and a blank line follows each, and
    clicks have a time that is none.
    """
    path = fresh_path(spark, "events")
    events = star.order_events(spark, sf)
    by_card = F.col("payment_type").isin("credit_card", "debit_card")
    events.where(by_card).write.json(f"{path}/plain")
    line = F.to_json(F.struct(*events.columns))
    if broken:
        cut = F.concat(F.regexp_replace(line, '"created_at.*', ""), F.lit("\n"))
        unclear = F.regexp_replace(line, '"created_at":"[^"]*"', '"created_at":"yesterday"')
        line = F.when(F.col("order_status") == "error", cut).when(F.col("order_status") == "click", unclear).otherwise(line)
    zipped = events.where(~by_card).select(line.alias("value"))
    zipped.write.option("compression", "gzip").text(f"{path}/zipped")
    return path


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the same files: the second finds nothing new."""
    files = _event_files(spark, sf)
    target, ledger = fresh_path(spark, "stream"), fresh_path(spark, "ledger")
    for _ in range(2):
        ingest.ingest(spark, files, target, ledger)
    return ingest.stream_table(spark, target).select(*STREAM_COLUMNS)


def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    files = _event_files(spark, sf, broken=True)
    target, ledger = fresh_path(spark, "stream"), fresh_path(spark, "ledger")
    ingest.ingest(spark, files, target, ledger)
    good = ingest.stream_table(spark, target).select("order_id", F.lit("good").alias("state"))
    bad = ingest.quarantine(spark, target).select(
        F.regexp_extract("line", '"order_id":"([^"]*)"', 1).alias("order_id"),
        F.lit("quarantined").alias("state"),
    )
    return good.unionByName(bad)


def stream_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Events taken in, then joined with the stored gold table; a second run has nothing to do."""
    files = _event_files(spark, sf)
    events, points, target = (fresh_path(spark, name) for name in ("stream", "points", "enriched"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    gold_table = enrich.store_gold(_gold(spark, sf), f"{_fresh_layer(spark, 'warehouse')}.gold", buckets)
    for _ in range(2):
        ingest.ingest(spark, files, events, points)
        enrich.enrich_new(spark, events, gold_table, target)
    return enrich.enriched(spark, target, gold_table)


def stream_bad_files(spark: SparkSession, sf: str) -> DataFrame:
    """Events and failed files after a run that meets cut-off files, and after one more when the first of them is whole again."""
    inbox, whole, target, points = (fresh_path(spark, name) for name in ("inbox", "whole", "stream", "points"))
    events = star.order_events(spark, sf)
    slot = F.pmod(F.col("order_id").cast("bigint"), F.lit(EVENT_SLOTS)).alias("slot")
    zipped = events.select(F.to_json(F.struct(*events.columns)).alias("value"), slot).repartition("slot")
    zipped.write.partitionBy("slot").option("compression", "gzip").text(inbox)

    def cut(slot: int) -> str:
        """Cut the last bytes off the file of a slot; returns where it still is whole."""
        file = folders.matching(spark, f"{inbox}/slot={slot}/part-*.gz")[0]
        kept = f"{whole}/{slot}.gz"
        folders.copy(spark, file, kept)
        folders.copy(spark, kept, file, less=16)
        return kept

    first, _ = [cut(slot) for slot in CUT_SLOTS]
    outcomes = []
    for run in (1, 2):
        if run == 2:
            folders.copy(spark, first, folders.matching(spark, f"{inbox}/slot={CUT_SLOTS[0]}/part-*.gz")[0])
        ingest.ingest(spark, inbox, target, points)
        good = ingest.stream_table(spark, target).groupBy(F.col("payment_type").alias("name")).agg(F.count(F.lit(1)).alias("n"))
        failed = ingest.outstanding(spark, target).select(
            F.regexp_extract("source_file", "(slot=[0-9]+)/", 1).alias("name"), F.col("attempts").alias("n")
        )
        for what, found in (("events", good), ("failed file", failed)):
            outcomes.append(settle(found).select(F.lit(run).alias("run"), F.lit(what).alias("what"), "name", "n"))
    return reduce(DataFrame.unionByName, outcomes)


# Sampling


def _sampled(spark: SparkSession, sf: str) -> DataFrame:
    delivered = star.raw(spark, sf, "orders").where(F.col("order_status") == SAMPLED_STATUS)
    return sampling.sample_rows(delivered, "order_id", SAMPLE_SIZE, SAMPLE_SEED)


def _extract(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """Rows of a table that belong to the sampled orders, under surrogate order ids."""
    chosen = _sampled(spark, sf)
    belonging = sampling.rows_of(star.raw(spark, sf, table), chosen, "order_id")
    return sampling.under_surrogates(belonging, sampling.key_map(chosen, "order_id", SAMPLE_SEED), "order_id")


def clone_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _extract(spark, sf, "orders")


def clone_order_items(spark: SparkSession, sf: str) -> DataFrame:
    return _extract(spark, sf, "order_items")


def clone_payments(spark: SparkSession, sf: str) -> DataFrame:
    return _extract(spark, sf, "payments")


def sampled_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items of the sampled orders under their own ids."""
    return sampling.rows_of(star.raw(spark, sf, "order_items"), _sampled(spark, sf), "order_id")


def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _sampled(spark, sf).select("order_id", "order_status")


QUERIES: dict[str, Query] = {
    **{m: (lambda spark, sf, m=m: _staged(spark, sf, m)) for m in staging.STAGING},
    "stg_orders_payments": _order_payments,
    "dim_customers": _dim_customers,
    "dim_sellers": dim_sellers,
    "dim_products": _dim_products,
    "dim_date": dim_date,
    "dim_geolocation": dim_geolocation,
    "clean_customers": clean_customers,
    "product_volume": product_volume,
    "text_timestamps": text_timestamps,
    "fact_order_items": _fact_items,
    "fact_payments": _fact_payments,
    "revenue_by_day_product_customer": revenue_by_day_product_customer,
    "mart_revenue_daily": mart_revenue_daily,
    "fact_order_items_incremental": fact_order_items_incremental,
    "fact_payments_incremental": fact_payments_incremental,
    "column_sync": column_sync,
    "keyed_upsert": keyed_upsert,
    "insert_if_absent": insert_if_absent,
    "full_refresh": full_refresh,
    "column_statistics": column_statistics,
    "append_only": append_only,
    "gold_view": _gold,
    "gold_stream_enrich": gold_stream_enrich,
    "gold_stream_latest": gold_stream_latest,
    "gold_latest_event": gold_latest_event,
    "gold_revenue_by_state": gold_revenue_by_state,
    "unified_orders": unified_orders,
    "federated_read": federated_read,
    "monthly_revenue": monthly_revenue,
    "top_categories": top_categories,
    "delivery_times": _deliveries,
    "avg_delivery_days": lambda spark, sf: metrics.avg_delivery_days(_deliveries(spark, sf)),
    "late_rate": lambda spark, sf: metrics.late_rate(_deliveries(spark, sf)),
    "delivery_histogram": lambda spark, sf: metrics.delivery_histogram(_deliveries(spark, sf)),
    "table_counts": table_counts,
    "customers_by_state": customers_by_state,
    "customer_order_counts": lambda spark, sf: metrics.customer_order_counts(_staged(spark, sf, "stg_orders")),
    "revenue_by_state": revenue_by_state,
    "seller_revenue_rating": seller_revenue_rating,
    "payment_preference": lambda spark, sf: metrics.payment_preference(_staged(spark, sf, "stg_payments")),
    "freight_by_category": freight_by_category,
    "rfm_segments": rfm_segments,
    "currency_convert": currency_convert,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": dq_relationships,
    "dq_accepted_range_strict": dq_accepted_range_strict,
    "dq_accepted_range_inclusive": dq_accepted_range_inclusive,
    "dq_staging_report": dq_staging_report,
    "dq_marts_report": dq_marts_report,
    "required_tables": required_tables,
    "csv_load": csv_load,
    "csv_text_fidelity": csv_text_fidelity,
    "csv_load_report": csv_load_report,
    "csv_append": csv_append,
    "partitioned_sink": partitioned_sink,
    "pipeline_build": pipeline_build,
    "staging_views": staging_views,
    "stream_ingest": stream_ingest,
    "stream_quarantine": stream_quarantine,
    "stream_enrich": stream_enrich,
    "stream_bad_files": stream_bad_files,
    "clone_orders": clone_orders,
    "clone_order_items": clone_order_items,
    "clone_payments": clone_payments,
    "sample_rows": sample_rows,
    "sampled_items": sampled_items,
}
