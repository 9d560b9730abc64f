"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) choose data and
cores; query names as arguments replace the default list.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from changeloom.plans import QUERIES
from changeloom.session import build_session

HEADLINE = (
    "daily_sales", "product_sales", "top_products", "customer_metrics", "sales_summary",
    "order_status_distribution", "parse_wrapped", "latest_state", "rebuild_table",
    "sales_sliding_1h_5m", "sales_hourly", "customer_sessions", "rfm_segments", "rfm_history",
    "anomaly_alerts", "current_inventory", "restock_events", "inventory_insights",
    "inventory_history", "order_lines", "recompute_order_totals", "search_index",
    "document_tokens", "inverted_index", "message_counts", "metric_slope", "stream_sales_windows",
    "stream_anomalies",
)

#: Input rows of a query, for events per second.
ROWS = {
    "daily_sales": ["orders"], "parse_wrapped": ["orders"], "sales_sliding_1h_5m": ["events"],
    "anomaly_alerts": ["events"], "inventory_history": ["lineitem", "part"],
    "rfm_segments": ["orders"], "stream_sales_windows": ["events"], "stream_anomalies": ["events"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "changeloom.spread": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        began = time.perf_counter()
        # The no-op sink makes every row and column without sending any to the driver.
        QUERIES[name].plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    took, rates = {}, {}
    for name in names:
        once(name)
        took[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        if name in ROWS:
            n = sum(spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ROWS[name])
            rates[name] = round(n / took[name])
        print(f"{name} {took[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "rows_per_second": rates, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
