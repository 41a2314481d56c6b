"""Times the headline queries and the whole batch job; prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_ALL=1    time every registered query, not only the headline ones
BENCH_RUNS     runs per query, the fastest counts (default 1; 2 leaves out compiling)
"""

from __future__ import annotations

import json
import os
import re
import time

from martloom.plans.pipeline import run_job
from martloom.plans.reports import Reports
from martloom.session import get_session
from martloom.sources import paths
from martloom.workload import views
from martloom.workload.queries import QUERIES

HEADLINE = (
    "cast_timestamp_safe",
    "silver_orders",
    "silver_payments",
    "silver_order_items",
    "silver_reviews",
    "rejected_payments",
    "silver_lineitem_split",
    "quality_metrics",
    "reject_reason_counts",
    "monthly_revenue",
    "daily_sales",
    "top_products",
    "category_revenue",
    "seller_revenue",
    "kpis",
    "mom_growth",
    "category_share",
    "scd1_upsert",
    "rejects_latest",
    "stream_upsert_orders",
)


def seconds(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "martloom-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE

    def drain(name: str):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # Untimed, so that the first query is not charged with the start of the session.
    drain(names[0])()
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    times = {name: min(seconds(drain(name)) for _ in range(runs)) for name in names}

    # The three stages of the job over text files, as a user of the published figures runs it.
    folder = paths.shared_folder(spark)
    views.export_raw(spark, sf_dir, f"{folder}/raw")
    run = run_job(spark, f"{folder}/raw", f"{folder}/storage")
    stages = Reports(spark, f"{folder}/storage").log.stages()
    for r in stages.select("stage", "duration_s").distinct().collect():
        times[f"job_{r['stage']}"] = r["duration_s"]

    scale = re.search(r"sf([\d.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries and batch job, total time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "job_input_records": run["input_records"],
                "job_output_records": run["output_records"],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
