"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per
query after one warm-up (the median counts), BENCH_QUERIES a comma-separated choice.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.session import local_session  # noqa: E402
from millrace.suite.queries import queries  # noqa: E402

HEADLINE = (
    "fact_orders", "customer_sales", "daily_sales", "monthly_sales", "customer_revenue",
    "product_revenue", "promotion_products", "dq_assemble", "dq_metrics", "dedup_latest",
    "upsert_by_key", "upsert_newest_wins", "scd2_merge", "rescued_data", "qa_unique",
    "qa_reconcile", "qa_dimension_coverage", "bronze_stream_ingest", "silver_incremental",
    "silver_snapshot", "reprocess_quarantine", "gold_build",
)
# Jobs that write tables run once after the warm-up.
JOBS = {
    "bronze_stream_ingest", "silver_incremental", "silver_snapshot", "reprocess_quarantine",
    "gold_build",
}


def run(query, spark, sf_dir: str) -> float:
    """The result is computed in full and dropped, so no time goes into collecting it."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = local_session(cpus, memory="16g", app="millrace-bench")
    every = queries()
    seconds = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        run(every[name], spark, sf_dir)
        timed = [run(every[name], spark, sf_dir) for _ in range(1 if name in JOBS else runs)]
        seconds[name] = round(statistics.median(timed), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
