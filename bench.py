"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tillback.operators.shares import release
from tillback.registry import all_queries

HEADLINE = [
    "mart_daily_sales_returns_summary",
    "mart_return_rate_by_product",
    "mart_return_rate_by_store",
    "mart_return_reason_summary",
    "mart_return_policy_exceptions",
    "mart_employee_return_activity",
    "gold_daily_sales_returns_summary",
    "gold_return_rate_by_product",
    "gold_return_rate_by_store",
    "gold_return_reason_summary",
    "gold_policy_exceptions",
    "gold_employee_return_activity",
    "int_sales_returns_joined",
    "report_exception_page",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> float:
        spark.catalog.clearCache()
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        took = round(time.perf_counter() - start, 3)
        release()
        return took

    run(HEADLINE[0])  # starts the JVM's code paths; not counted
    seconds = {name: run(name) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
