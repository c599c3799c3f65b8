"""Queries that show what the month-partitioned layout buys over a flat copy.

Each takes either copy of the fact, so both run the same logic.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopstar.config import BenchPoints, RetailConfig
from shopstar.functions.scalar import dbl, mean, money, rnd
from shopstar.sources.store import date_range


def between(copy: DataFrame, first: date, months: int) -> DataFrame:
    return date_range(copy, F.lit(first), F.date_sub(F.add_months(F.lit(first), months), 1))


def month_by_branch(copy: DataFrame, at: BenchPoints) -> DataFrame:
    return between(copy, at.month, 1).groupBy("branch_key").agg(
        dbl(F.sum("total_amount")).alias("revenue"), F.count("*").alias("lines"),
    ).orderBy(F.desc("revenue"), "branch_key")


def year_by_line(copy: DataFrame, dim_product: DataFrame, at: BenchPoints) -> DataFrame:
    sums = between(copy, date(at.year, 1, 1), 12).groupBy("product_key").agg(
        F.sum("total_amount").alias("rev"), F.sum("gross_profit").alias("prof"))
    return sums.join(dim_product.select("product_key", "product_line"), "product_key").groupBy(
        "product_line"
    ).agg(
        dbl(F.sum("rev")).alias("revenue"), dbl(F.sum("prof")).alias("profit"),
    ).orderBy(F.desc("revenue"), "product_line")


def customer_history(copy: DataFrame, at: BenchPoints, index: DataFrame | None = None) -> DataFrame:
    """The orders of one customer; with an index only the months are opened in which it has the customer."""
    own = copy.filter(F.col("customer_key") == at.customer_key)
    if index is not None:  # one row per declared month at most
        months = index.filter(F.col("customer_key") == at.customer_key).select("sale_month")
        own = own.join(F.broadcast(months), "sale_month", "left_semi")
    return own.groupBy(
        "invoice_id", "sale_date"
    ).agg(dbl(F.sum("total_amount")).alias("basket")).orderBy(F.desc("sale_date"), "invoice_id")


def invoice_lookup(copy: DataFrame, at: BenchPoints, index: DataFrame | None = None) -> DataFrame:
    """One invoice of a day: the smallest, so that the choice is repeatable.

    An index gives the months of the invoice, most often one, and only those are opened.
    """
    day = F.lit(at.invoice_date)
    wanted = date_range(copy, day, day).agg(F.min("invoice_id")).scalar()
    own = copy.filter(F.col("invoice_id") == wanted)
    if index is not None:
        months = index.filter(F.col("invoice_id") == wanted).agg(
            F.struct(F.min("sale_month").alias("first"), F.max("sale_month").alias("last"))).scalar()
        own = own.filter(F.col("sale_month").between(months.getField("first"), months.getField("last")))
    return own.select(
        "line_no", "product_key", "quantity", dbl(F.col("total_amount")).alias("total_amount"),
    ).orderBy("line_no")


def quarter_scorecard(copy: DataFrame, at: BenchPoints) -> DataFrame:
    return between(copy, at.quarter_start, 3).groupBy("branch_key").agg(
        F.countDistinct("invoice_id").alias("invoices"),
        dbl(F.sum("total_amount")).alias("revenue"),
        rnd(mean(F.col("rating")), 4).alias("avg_rating"),
    ).orderBy(F.desc("revenue"), "branch_key").limit(10)


def full_aggregate(copy: DataFrame) -> DataFrame:
    return copy.agg(
        F.count("*").alias("lines"), money(F.sum("total_amount"), 2).alias("revenue"))


def branch_year_cover(copy: DataFrame, at: BenchPoints) -> DataFrame:
    year = F.col("date_key").between(at.year * 10000 + 101, at.year * 10000 + 1231)
    months = F.col("sale_month").between(F.lit(date(at.year, 1, 1)), F.lit(date(at.year, 12, 1)))
    return copy.filter((F.col("branch_key") == at.branch_key) & year & months).groupBy(
        "branch_key"
    ).agg(
        dbl(F.sum("total_amount")).alias("revenue"), dbl(F.sum("gross_profit")).alias("profit"))


# The timed queries by name; each takes the warehouse and one copy of the fact.
QUERIES = {
    "bench_month_by_branch": lambda w, copy: month_by_branch(copy, w.cfg.bench),
    "bench_year_by_line": lambda w, copy: year_by_line(copy, w.dim_product, w.cfg.bench),
    "bench_customer_history": lambda w, copy: customer_history(copy, w.cfg.bench, w.customer_index),
    "bench_invoice_lookup": lambda w, copy: invoice_lookup(copy, w.cfg.bench, w.invoice_index),
    "bench_quarter_scorecard": lambda w, copy: quarter_scorecard(copy, w.cfg.bench),
    "bench_full_aggregate": lambda w, copy: full_aggregate(copy),
    "bench_branch_year_cover": lambda w, copy: branch_year_cover(copy, w.cfg.bench),
}


def content_sum() -> Column:
    """A weighted sum over the keys and numbers of all lines, in whole numbers."""
    weights = {"line_no": 7, "branch_key": 11, "product_key": 13, "payment_key": 17, "quantity": 19,
               "customer_key": 23, "date_key": 29, "sale_hour": 31}
    parts = [F.coalesce(F.col(c), F.lit(0)).cast("bigint") * w for c, w in weights.items()]
    return F.sum(reduce(Column.__add__, parts))


def layout_parity(partitioned: DataFrame, flat: DataFrame) -> DataFrame:
    """Rows, revenue and content sums of both copies side by side, and whether all columns agree."""
    def one(df: DataFrame):
        digest = F.xxhash64(*sorted(c for c in df.columns)).cast("decimal(20,0)")
        return df.agg(F.struct(
            F.count("*").alias("n"), F.sum("total_amount").alias("rev"),
            content_sum().alias("content"), F.sum(digest).alias("digest"))).scalar()

    both = partitioned.sparkSession.range(1).select(
        one(partitioned).alias("p"), one(flat).alias("f"))
    return both.select(
        F.col("p.n").alias("partitioned_rows"),
        F.col("f.n").alias("flat_rows"),
        money(F.col("p.rev"), 2).alias("partitioned_revenue"),
        money(F.col("f.rev"), 2).alias("flat_revenue"),
        F.col("p.content").alias("partitioned_content"),
        F.col("f.content").alias("flat_content"),
        ((F.col("p.n") == F.col("f.n")) & (F.col("p.n") > 0)
         & (F.col("p.digest") == F.col("f.digest"))).cast("int").alias("same_content"),
    )


def partition_profile(partitioned: DataFrame, flat: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Declared and populated months with their row counts, next to the flat copy."""
    months = partitioned.groupBy("sale_month").agg(F.count("*").alias("n"))
    declared = F.months_between(
        F.trunc(F.lit(cfg.window_end), "month"), F.trunc(F.lit(cfg.window_start), "month")) + 1

    def row(name: str, parts, populated) -> list:
        return [
            F.lit(name).alias("object"), parts.cast("bigint").alias("partitions"),
            populated.cast("bigint").alias("populated"), F.sum("n").alias("row_count"),
            F.min("n").alias("fewest_rows"), F.max("n").alias("most_rows")]

    whole = flat.agg(F.count("*").alias("n"))
    return months.agg(*row("fact_sales", F.first(declared), F.count("*"))).unionByName(
        whole.agg(*row("fact_sales_flat", F.count("*"), F.count("*"))))
