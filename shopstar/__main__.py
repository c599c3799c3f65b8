"""Builds a warehouse from delivered CSV files.

    python -m shopstar LANDING_FOLDER WAREHOUSE_FOLDER [--control-copy] [--no-gate] [--line-breaks]

LANDING_FOLDER holds sales.csv, customers.csv, products.csv and branches.csv.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from shopstar.config import RetailConfig
from shopstar.operators import quality
from shopstar.plans.warehouse import Warehouse, run_pipeline
from shopstar.sources.landing import read_landing


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("landing")
    parser.add_argument("warehouse")
    parser.add_argument("--control-copy", action="store_true", help="also write the flat fact")
    parser.add_argument("--no-gate", action="store_true", help="do not fail on failed checks")
    parser.add_argument("--line-breaks", action="store_true", help="quoted fields may hold line breaks")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("shopstar").getOrCreate()
    landing = read_landing(spark, args.landing, args.line_breaks)
    wh = Warehouse(spark, landing, args.warehouse.rstrip("/"), RetailConfig())
    slowest = run_pipeline(wh, args.control_copy, gate=False)
    quality.load_audit_report(wh.load_audit).show(50, truncate=False)
    quality.reject_counts(wh.stg_sales_rejects).show(truncate=False)
    quality.dq_report(wh.dq_results).show(50, truncate=False)
    for name, seconds in slowest:
        print(f"{name:24s} {seconds:8.2f}s")
    if not args.no_gate:
        quality.dq_gate(wh.dq_results)


if __name__ == "__main__":
    main()
