"""Time the headline queries over the files in $BENCH_SF_DIR; prints one JSON line.

Each query is planned and run in full ``RUNS`` times after one warm-up, and its
median counts. Results go to Spark's no-op sink, so every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tillmetrics.registry import all_queries
from tillmetrics.session import build_session

RUNS = 3
HEADLINE = [
    "customer_ltv_segments",
    "product_performance",
    "daily_trends",
    "cohort_retention",
    "payment_risk",
    "kpi_dashboard",
    "kpi_dashboard_corrected",
    "sales_by_category_tier",
    "customer_geography",
    "top_products",
    "tier_summary",
    "dq_nulls",
    "dq_unique",
    "dq_fk",
    "dq_order_reconciliation",
    "dq_payment_reconciliation",
]


def scale_of(folder: str) -> float | str:
    name = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 4)
    spark.stop()
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": scale_of(folder),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
