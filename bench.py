"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder with the tables       (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local session   (default 8)
BENCH_QUERIES  comma-separated query names  (default: the headline queries below)
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from cartonwise.catalog import QUERIES
from cartonwise.config import remove_scratch

HEADLINE = (
    "top_suppliers", "follow_up", "supplier_kpis", "line_details", "carton_usage", "global_rank", "local_rank",
    "supplier_series", "density_series", "country_trend", "supplier_trend", "kpi_monthly", "approver_performance",
    "avg_lines_per_day", "supplier_factory_trend", "month_comparison", "dashboard_suppliers", "dashboard_cards",
    "rate_trend", "kpi_dashboard", "supplier_directory", "search_names", "transaction_page", "compliance_rate",
    "rolling_3m", "global_rank_all_months", "month_rollup", "clean_text", "supplier_json",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")  # one machine runs this
    spark = (SparkSession.builder.config("spark.checkpoint.dir", scratch).master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g").config("spark.sql.shuffle.partitions", cpus).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES[names[0]](spark, folder).collect()  # one untimed run, so that starting the JVM is not part of a query
    seconds = {}
    for name in names:
        start = time.perf_counter()
        # The noop sink runs the whole plan without bringing rows to the driver.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        remove_scratch(spark)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
