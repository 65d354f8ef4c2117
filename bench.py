"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     warm runs per query (default 5); slow ones (cold run above 4 s) run twice, jobs once
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans.queries import QUERIES  # noqa: E402
from ledgerlens.session import get_spark  # noqa: E402

# The three dashboard queries, which have a target of 2 s each.
DASHBOARD = ["kpis_from_fact", "tpv_trend_from_fact", "alerts_by_rule"]
OPERATORS = ["validate_rows", "dedup_latest", "rolling_count", "lag_previous", "detect_velocity_attack", "detect_high_amount",
             "detect_geo_impossible", "run_suite", "fct_transactions", "scd2_snapshot", "apply_fraud_flags", "mart_executive_kpis",
             "mart_fraud_summary", "headline_kpis", "alert_kpis", "layer_counts", "score_isolation_forest"]
# Whole jobs over 100,000 transactions; targets are minutes.
JOBS = ["run_bronze_ingest", "run_silver_cleanse", "run_gold_modeling", "run_anomaly_detection", "stream_velocity"]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm_runs = int(os.environ.get("BENCH_RUNS", "5"))
    memory = os.environ.get("BENCH_MEMORY", "8g")
    spark = get_spark("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory})
    spark.sparkContext.setLogLevel("ERROR")
    detail = {}
    for name in OPERATORS + DASHBOARD + JOBS:
        cold = run(spark, name, sf_dir)
        runs = 1 if name in JOBS else 2 if cold > 4 and name not in DASHBOARD else warm_runs
        warm = sorted(run(spark, name, sf_dir) for _ in range(runs))
        detail[name] = {"cold": round(cold, 3), "median": round(statistics.median(warm), 3),
                        "p95": round(warm[min(len(warm) - 1, int(0.95 * len(warm)))], 3)}
        print(name, detail[name], file=sys.stderr, flush=True)
    medians = {name: d["median"] for name, d in detail.items()}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(medians.values()), 3), "unit": "sec", "queries": medians,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cores": int(cpus), "memory": memory, "detail": detail}))
    spark.stop()


if __name__ == "__main__":
    main()
