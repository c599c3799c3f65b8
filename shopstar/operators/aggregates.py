"""Exact aggregate tables of the sales, and the rule that picks one for a query.

Both tables keep the additive columns of the fact under their own names, so an
operator that only sums gives the same result on the fact and on an aggregate.
"""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.skew import dealt, find_hot_buckets, row_count
from shopstar.operators.common import (
    FIRST_OF, LINE_SUMS, identified, line_sums, sale_year)

if TYPE_CHECKING:
    from shopstar.plans.warehouse import Warehouse

DAY = ("sale_date", "date_key", "sale_month")
INVOICE_GRAIN = ("invoice_id", *DAY, "sale_hour", "branch_key", "customer_key")

# The levels of the daily cube: sales per day and one of these.
LEVELS = ("payment_key", "sale_hour", "branch_key", "product_key")


def fact_invoices(fact: DataFrame, cfg: RetailConfig) -> DataFrame:
    """One row per invoice, day, hour, branch and customer: sums and marks of first rows.

    Most invoices are one row; an invoice whose lines differ in these columns is
    several. For each entry of FIRST_OF exactly one row of an invoice within the
    named columns is marked 1, so the sum of the marks is the number of distinct
    invoices by these columns, which needs no distinct count and no repeated rows.

    The lines are dealt by invoice once, and sums and marks both use that. Lines of
    an invoice so common that it would fill a task are summed on the map side first.
    """
    hot = find_hot_buckets(fact, ["invoice_id"], cfg)
    lines = fact if hot else dealt(fact, ["invoice_id"], row_count(fact), cfg)
    rows = lines.groupBy(*INVOICE_GRAIN).agg(*line_sums(fact)).withColumns({
        "_year": sale_year(), "_known": identified()})
    if hot:
        rows = dealt(rows, ["invoice_id"], row_count(fact), cfg)
    by_date = ["_year", "sale_month", "branch_key", "sale_date", "sale_hour", "customer_key"]

    def first(by: list[str]) -> Column:
        order = [c for c in by_date if c not in by]
        return (F.row_number().over(W.partitionBy("invoice_id", *by).orderBy(*order)) == 1).cast("int")

    # Sorted by year, month and branch, four of the marks follow from one order.
    source = {"sale_year": ["_year"], "sale_month": ["_year", "sale_month"], "identified": ["_known"]}
    marks = {
        mark: first([c for b in by for c in source.get(b, [b])]) for by, mark in FIRST_OF.items()}
    return rows.withColumns(marks).drop("_year", "_known")


# The sums of decimals in the cube, as wide whether lines or sums of lines were added up.
CUBE_SUMS = {
    "total_amount": "decimal(32,4)", "gross_profit": "decimal(32,4)", "gross_sales": "decimal(32,2)",
    "rating_sum": "decimal(23,1)"}


def daily_cube(fact: DataFrame, invoices: DataFrame) -> DataFrame:
    """Sales per day and branch, hour, product or payment method.

    `level` names the column whose values `key` holds. Its size grows with days and
    keys, not with sales. What the invoice table can answer comes from there; the
    fact may stand in for it.
    """
    def level(name: str) -> DataFrame:
        source = invoices if name in invoices.columns else fact
        return source.groupBy(*DAY, F.col(name).cast("int").alias("key")).agg(*line_sums(source)).withColumns({
            "level": F.lit(name), "sale_year": sale_year()})

    return reduce(DataFrame.unionByName, map(level, LEVELS)).withColumns({
        name: F.col(name).cast(kind) for name, kind in CUBE_SUMS.items()})


def stored_sales(wh: "Warehouse") -> DataFrame:
    """The invoice table if it is stored already, else the fact.

    For operators that give the same on either and use the marks in one sum at most:
    the invoice table is dearer to build than what it would save one of them.
    """
    return wh.fact_invoices if wh.has("fact_invoices") else wh.fact_sales


def sales(wh: "Warehouse", *columns: str) -> DataFrame:
    """The smallest table that has the additive columns and `columns`.

    The rule: the daily cube serves days with at most one of its levels, the
    invoice table whatever is in its grain, the fact all else.
    """
    others = [c for c in columns if c not in DAY]
    if len(others) < 2 and set(others) <= set(LEVELS):
        level = others[0] if others else LEVELS[0]
        return wh.daily_cube.filter(F.col("level") == level).select(
            *DAY, F.col("key").alias(level), *LINE_SUMS, "sale_year")
    if set(others) <= set(INVOICE_GRAIN):
        return wh.fact_invoices
    return wh.fact_sales

