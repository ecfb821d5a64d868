"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_RUNS     timed runs per query after one warm-up (default 1; the median is reported)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from ledgerlark.queries import load
from ledgerlark.queries.registry import QUERIES
from ledgerlark.session import build_session

HEADLINE = [
    "flagship_hourly_features", "s5_invoice_feed", "s11_chart_series", "j5_star_join", "j7_not_in_sets", "j11_interval_join", "j12_tolerance_join",
    "j19_group_join_back", "a1_group_measures", "a4_count_distinct", "a9_null_profile", "a13_dominant_value", "w1_top1_per_key", "w6_prefix_max",
    "w8_rolling_mean", "n4_explode_chain", "d3_spanish_date", "d29_text_normal_form", "e1_consolidated_invoice", "r_alert_rows", "k1_same_authorisation",
    "b6_daily_summary", "g2_kpis", "g5_latency_percentiles", "m7_scoring_source", "k_waterfall", "k12_attach_duplicates", "e9_processed_claims", "g5_agent_metrics", "g8_kpis_sink",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(cores), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    load()
    times = {}
    for name in HEADLINE:
        samples = []
        for run in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if run:
                samples.append(time.perf_counter() - started)
        times[name] = round(statistics.median(samples), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": folder}))
    spark.stop()


if __name__ == "__main__":
    main()
