"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from monthtide.registry.queries import registered

HEADLINE = (
    "monthly_counts",
    "monthly_counts_by_supplier",
    "csv_monthly_counts_by_priority",
    "month_index_by_category",
    "category_index",
    "category_index_by_customer",
    "future_frame_by_category",
    "ols_forecast_overall",
    "ridge_metrics_by_supplier",
    "isotonic_by_supplier",
    "tree_by_supplier",
    "forest_by_supplier",
    "cv_model_choice",
    "glr_forecast_overall",
    "glr_forecast_by_supplier",
    "tree_forecast_overall",
    "tree_forecast_by_category",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("monthtide-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    registered()["ols_forecast_overall"](spark, sf_dir).collect()  # warm up the JVM
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
