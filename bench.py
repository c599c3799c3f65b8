"""Times the build and the headline queries; prints one JSON line.

    BENCH_SF_DIR  folder with the input tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default: all)
    BENCH_RUNS    timed runs per query after one warm-up (default 7)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark import SparkConf
from pyspark.sql import SparkSession

from shopstar.operators import layout
from shopstar.plans import registry
from shopstar.plans.warehouse import run_pipeline, sample_warehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
RUNS = int(os.environ.get("BENCH_RUNS", "7"))

HEADLINE = (
    "growth_exec_summary", "growth_monthly_trend", "growth_like_for_like", "growth_rolling_28d",
    "customer_rfm_summary", "customer_value_deciles", "customer_cohort_matrix",
    "customer_purchase_gap", "customer_new_vs_returning", "product_abc_skus",
    "product_top_affinities", "product_basket_size", "branch_scorecard", "branch_region_rollup",
    "branch_hour_weekday_heatmap", "kpi_monthly", "page_exec_time_measures",
)


def timed(run) -> float:
    """Median seconds of RUNS runs after one warm-up; results are fetched."""
    run().collect()
    samples = []
    for _ in range(RUNS):
        started = time.perf_counter()
        run().collect()
        samples.append(time.perf_counter() - started)
    return round(statistics.median(samples), 4)


def scanned(df) -> dict[str, int]:
    """Files and rows that the scans of an executed query took in."""
    df.collect()
    found = {"files": 0, "rows": 0}

    def walk(plan) -> None:
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if plan.getClass().getSimpleName().endswith("QueryStageExec"):
            return walk(plan.plan())
        metrics = plan.metrics()
        if metrics.contains("numFiles"):
            found["files"] += metrics.apply("numFiles").value()
            found["rows"] += metrics.apply("numOutputRows").value()
        children = plan.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def main() -> None:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("shopstar-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if not SparkConf().get("spark.checkpoint.dir"):  # one machine: its own folder is the shared one
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shopstar-bench-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    wh = sample_warehouse(spark, SF_DIR)
    started = time.perf_counter()
    slowest = run_pipeline(wh, control_copy=True, gate=False)
    pipeline = time.perf_counter() - started

    queries, flat, reads = {}, {}, {}
    for name, run in layout.QUERIES.items():
        queries[name] = timed(lambda run=run: run(wh, wh.fact_sales))
        flat[name] = timed(lambda run=run: run(wh, wh.fact_sales_flat))
        reads[name] = {"months": scanned(run(wh, wh.fact_sales)),
                       "flat": scanned(run(wh, wh.fact_sales_flat))}
    operators = registry.operators()
    for name in HEADLINE:
        queries[name] = timed(lambda run=operators[name]: run(wh))

    print(json.dumps({
        "metric": "sum of headline query medians",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(SF_DIR),
        "layout_flat": flat,
        "layout_scanned": reads,
        "pipeline_sec": round(pipeline, 2),
        "pipeline_slowest": {n: round(s, 2) for n, s in slowest},
        "landing_rows": wh.sales_landing.count(),
        "fact_rows": wh.fact_sales.count(),
        "cpus": CPUS,
        "runs": RUNS,
        "spark": spark.version,
    }))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
