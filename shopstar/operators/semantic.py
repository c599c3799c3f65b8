"""Tables prepared for reports: cohorts, product pairs and monthly figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.scalar import dbl, pct, rnd
from shopstar.operators.baskets import ALL_BASKETS, pair_counts
from shopstar.operators.common import (
    distinct_per, identified, line_count, rating_mean, summarise)

__all__ = ["ALL_BASKETS", "pair_counts"]


def months_between(later: Column, earlier: Column) -> Column:
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def cohort_counts(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Customers seen per cohort and month after it.

    The fact is cut to one row per customer and month before the join, so a
    customer brings at most as many rows as there are months.
    """
    active = fact.filter(identified()).select(
        "customer_key", "sale_month").distinct()
    cohorts = dim_customer.filter(F.col("cohort_month").isNotNull()).select(
        "customer_key", "cohort_month")
    index = months_between(F.col("sale_month"), F.col("cohort_month"))
    return (
        active.join(cohorts, "customer_key")
        .groupBy("cohort_month", index.alias("month_index"))
        .agg(F.count("*").alias("customers"))
    )


def cohort_sizes(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("month_index") == 0).select(
        "cohort_month", F.col("customers").alias("cohort_size"))


def cohort_retention_long(counts: DataFrame, cfg: RetailConfig) -> DataFrame:
    return (
        counts.filter(F.col("month_index").between(0, cfg.retention_horizon))
        .join(cohort_sizes(counts), "cohort_month")
        .select(
            "cohort_month",
            F.date_format("cohort_month", "yyyy-MM").alias("cohort_label"),
            "month_index", "cohort_size",
            F.col("customers").alias("retained_customers"),
            pct(F.col("customers"), F.col("cohort_size"), 2).alias("retention_pct"),
        )
    )


def pair_measures(pairs: DataFrame, dim_product: DataFrame, min_baskets: int) -> DataFrame:
    """Support, confidence and lift of the pairs with enough baskets."""
    total = pairs.filter(F.col("key_a") == ALL_BASKETS).select("n").scalar()
    single = pairs.filter((F.col("key_a") == F.col("key_b")) & (F.col("key_a") != ALL_BASKETS))

    def side(s: str) -> DataFrame:
        names = dim_product.select(
            F.col("product_key").alias(f"key_{s}"), F.col("sku").alias(f"sku_{s}"),
            F.col("product_name").alias(f"name_{s}"), F.col("product_line").alias(f"line_{s}"))
        return single.select(F.col("key_a").alias(f"key_{s}"), F.col("n").alias(f"n_{s}")).join(
            names, f"key_{s}")

    n, na, nb, t = dbl(F.col("n")), dbl(F.col("n_a")), dbl(F.col("n_b")), dbl(total)
    return (
        pairs.filter((F.col("key_a") < F.col("key_b")) & (F.col("n") >= min_baskets))
        .join(side("a"), "key_a").join(side("b"), "key_b")
        .withColumns({
            "baskets_together": F.col("n"),
            "support_pct": pct(n, t, 3),
            "confidence_a_pct": pct(n, na, 1),
            "confidence_b_pct": pct(n, nb, 1),
            "lift": rnd((n / t) / ((na / t) * (nb / t)), 2),
        })
    )


def basket_affinity(pairs: DataFrame, dim_product: DataFrame, cfg: RetailConfig) -> DataFrame:
    return pair_measures(pairs, dim_product, cfg.min_pair_baskets).select(
        F.col("name_a").alias("product_a"), F.col("name_b").alias("product_b"),
        "line_a", "line_b", "baskets_together", "support_pct",
        F.col("confidence_a_pct").alias("confidence_pct"), "lift",
        F.when(F.col("line_a") != F.col("line_b"), "Cross-category")
        .otherwise("Within-category").alias("pair_type"),
    )


def kpi_monthly(fact: DataFrame, dim_date: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Month by branch: the base grain of the overview page."""
    months = dim_date.select(
        F.col("month_start_date").alias("sale_month"), "year_month", "year_number", "month_number"
    ).distinct()
    branches = dim_branch.select("branch_key", "branch_code", "city", "region")
    by = ["sale_month", "branch_key"]
    customers = distinct_per(fact.filter(identified()), by, "customer_key", "active_customers")
    sums = [
        line_count(fact).alias("line_items"),
        F.sum("quantity").alias("units"),
        dbl(F.sum("total_amount")).alias("revenue"),
        dbl(F.sum("gross_sales")).alias("gross_sales"),
        dbl(F.sum("gross_profit")).alias("gross_profit"),
        rnd(rating_mean(fact), 4).alias("avg_rating"),
    ]
    return (
        summarise(fact, by, sums, {"invoices": "invoice_id"})
        .join(customers, by, "left").fillna(0, ["active_customers"])
        .join(months, "sale_month").join(branches, "branch_key")
        .withColumnRenamed("sale_month", "month_start_date")
    )
