"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of threads.
Every query runs once to warm up and three times for the median; the result is
materialised without being collected.
"""

from __future__ import annotations

import atexit
import json
import os
import shutil
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercato.checks import QUERIES  # noqa: E402

HEADLINE = [
    "customer_order_history",
    "customer_order_history_limit_first",
    "category_sales",
    "category_sales_labelled",
    "order_payment_summary",
    "order_payment_summary_bounded",
    "top_products",
    "top_products_exists",
    "pending_deliveries",
    "pending_deliveries_prioritised",
    "seller_revenue",
    "seller_revenue_preagg",
    "geo_sales_matrix",
    "geo_sales_matrix_rounded",
    "product_attr_contains",
    "product_attr_min",
    "delivery_delay_stats",
    "delivery_delay_stats_delayed_only",
    "order_detail",
    "state_sales",
    "build_product_documents",
    "catalog_category_stats",
    "review_text_search",
    "payment_value_by_type",
    "orphan_keys",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    shared = tempfile.mkdtemp(prefix="bench-")
    atexit.register(shutil.rmtree, shared, ignore_errors=True)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", shared)
        # Call sites per column expression are a debugging aid; each costs round trips to the JVM.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(3)), 4)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
