"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3). Each query is run to completion with the
``noop`` sink (full execution, nothing collected); the reported time per
query is the median over the repeats after one warm-up pass. ``parse_lines``
reads log files rendered beforehand: rendering them is no part of ingest.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "parse_lines", "fact_sessions", "user_profiles", "session_rank",
    "daily_active_users", "top_content", "activity_heatmap", "app_usage",
    "completion_buckets", "last_action", "events_by_app", "active_hours",
    "watch_time_by_bucket", "crashed_share", "completion_by_entry",
    "monthly_active_users", "mau_change", "churn_analysis", "cohort_retention",
    "quality_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))

    from viewlog.operators.ingest import ingest_lines
    from viewlog.plans.catalog import QUERIES
    from viewlog.session import get_spark, work_path
    from viewlog.sources.tables import load_raw_lines
    from viewlog.sources.text import read_text_logs

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="viewlog-bench",
                      extra={"spark.driver.memory": "8g"})

    logs = work_path(spark, "bench-logs")
    load_raw_lines(spark, sf_dir).write.text(logs)
    queries = {**QUERIES, "parse_lines": lambda s, d: ingest_lines(read_text_logs(s, logs, glob="part-*"))}

    def run(name: str) -> float:
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:  # warm-up: JVM, code generation, Python workers
        run(name)
    times = {name: round(statistics.median(run(name) for _ in range(repeats)), 3)
             for name in HEADLINE}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
