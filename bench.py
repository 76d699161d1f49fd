"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all) and BENCH_RUNS
(default 3) choose data, cores and timed runs. Each query is run once to warm up; its
time is the median of the runs, from building the plan to the last row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from shipreport.session import build_session
from shipreport.workload.queries import QUERIES

HEADLINE = (
    "weight_report", "invoice_report_range", "invoice_report_all", "doc_sort_report",
    "invoice_lines_cached", "eligible_invoices", "header_lines", "house_bill_by_mode",
    "customer_roles", "master_bill", "latest_booking", "top1_window", "latest_milestone",
    "charge_sum_direct", "charge_two_measures", "charge_sum_cached", "union_distinct_modes",
    "page_concat", "content_rules", "keyword_flags", "change_counts",
)


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 8)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, sf_dir, name)
        times[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
