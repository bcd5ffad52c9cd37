"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermill.queries import QUERIES  # noqa: E402
from ordermill.session import build_session  # noqa: E402

HEADLINE = (
    "stg_orders_payments", "dim_products", "dim_geolocation", "fact_order_items", "fact_payments",
    "mart_revenue_daily", "gold_view", "gold_stream_enrich", "gold_stream_latest",
    "gold_revenue_by_state", "unified_orders", "monthly_revenue", "top_categories",
    "customers_by_state", "revenue_by_state", "seller_revenue_rating", "payment_preference",
    "freight_by_category", "avg_delivery_days", "rfm_segments", "dq_staging_report",
    "dq_marts_report", "fact_order_items_incremental", "fact_payments_incremental",
    "column_sync", "keyed_upsert", "federated_read", "stream_ingest", "stream_enrich", "csv_load", "pipeline_build",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            # Files of a size that fits this small data, so that writes use all cores.
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
            # Let the larger tables be shuffled over all cores here too, as they are at scale.
            "spark.sql.autoBroadcastJoinThreshold": "1m",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in wanted:
        best = None
        for run in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - started
            if run:
                best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
        print(f"{name:32s} {best:8.3f}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
