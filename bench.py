"""Time the load of every layer and the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
The layers are built first and timed on their own, so no query time hides a load. Each query is timed
three times and its median counts. Queries that land files of their own are timed with the writing of these.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caseflow.plans.registry import all_queries  # noqa: E402
from caseflow.plans.warehouse import warehouse  # noqa: E402

RUNS = 3
HEADLINE = (
    "overall_resolution resolution_by_priority resolution_by_category resolution_by_team"
    " resolution_distribution closure_by_category closure_by_priority status_share"
    " segment_drilldown pivot_category_status pivot_priority_status agent_scorecard_full"
    " team_rollup top3_agents_per_team region_volume region_by_category top10_customers"
    " monthly_volume region_quarter case_enriched agent_scorecard region_summary priority_sla"
    " monthly_trend dq_monitor top10_agents_by_closure open_health_alert dq_summary"
    " contract_unique contract_relationships scd2_apply merge_upsert merge_audit_columns"
    " asof_region_volume incremental_batch pruned_date_range metric_reconciliation"
    " raw_null_tokens incremental_file_load incremental_upsert"
).split()


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("caseflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the executor threads
    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        started = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - started, 3)

    w = warehouse(spark, sf_dir)
    timed("load_raw", lambda: [w.raw(n) for n in ("cases", "customers", "agents")])
    timed("load_staging", lambda: [w.stg_customers, w.stg_agents, w.stg_cases])
    timed("load_dimensions", lambda: [w.dim_customer, w.dim_agent])
    timed("load_fact", lambda: w.fact)
    queries = all_queries()
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            timed(name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
            runs.append(seconds[name])
        seconds[name] = statistics.median(runs)
    print(
        json.dumps(
            {
                "metric": "total_seconds_load_and_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
