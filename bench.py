"""Benchmark: run the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    BENCH_EVENT_LOG=1 ...   # also write Spark's event log to a fresh /tmp/run-eventlog-* folder

q1..q5 are the five questions the reference timed end to end (count,
failed count, top merchant, failure rate by method, total revenue); the rest
are the flagship Gold query and the heavier operators of each family. Each
query is planned and executed in full (``noop`` sink: every row is
produced, nothing is shipped to the driver), one after another, after one
warm-up run that starts the JVM's code paths.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake.plans.catalog import load_all  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402

HEADLINE = {
    "q1": "total_count",
    "q2": "failed_count",
    "q3": "top_1",
    "q4": "failure_rate_by_method",
    "q5": "total_revenue",
    "merchant_performance_total": "merchant_performance_total",
    "daily_summary": "daily_summary",
    "customer_ltv": "customer_ltv",
    "three_way_join": "three_way_join",
    "reconcile_full_outer": "reconcile_full_outer",
    "dq_suite": "dq_suite",
    "dirty_classification": "dirty_classification",
    "distribution_drift": "distribution_drift",
    "schema_diff": "schema_diff",
    "sql_text_guard": "sql_text_guard",
    "pii_columns": "pii_columns",
    "incident_duplicates": "incident_duplicates",
    "alert_rules": "alert_rules",
    "partner_feed": "partner_feed",
    "stream_dedup": "stream_dedup",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        # Stage/task times without the UI: Spark's event log in a fresh scratch folder.
        log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir=os.environ.get("BENCH_EVENT_LOG_ROOT", "/tmp"))
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                 "spark.eventLog.compress": "false"}
        print(f"event log: {log_dir}", file=sys.stderr)
    spark = build_session(f"local[{cpus}]", max(8, 2 * cpus), app_name="ledgerlake-bench", extra_conf=extra)
    reg = load_all()

    def run(key: str) -> float:
        t0 = time.perf_counter()
        reg[key].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("merchant_performance_total")  # warm-up, not timed
    times = {name: round(run(key), 3) for name, key in HEADLINE.items()}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
