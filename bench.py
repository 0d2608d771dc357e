"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (default 3; the median run is reported per query).
A run builds the query, stages included, and writes its whole result to the noop sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermill.plans.registry import queries  # noqa: E402
from ordermill.session import build_session  # noqa: E402

HEADLINE = [
    "order_summary",
    "monthly_sales",
    "top_products",
    "customer_metrics",
    "category_performance",
    "ml_customer_features",
    "basket_monthly",
    "basket_products",
    "basket_customers",
    "basket_category",
    "basket_customer_features",
    "validate_accepted",
    "contract_violations",
    "stream_monthly_sales",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="ordermill-bench",
        shuffle_partitions=cpus * 2,
        extra={"spark.driver.memory": "8g"},
    )
    registry = queries()
    # Warm the JVM (class loading, codegen caches) on one query before timing.
    registry["category_performance"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
    spark.stop()
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_median",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(match.group(1)) if match else sf_dir,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
