"""Pieces that several groups of operators build on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopstar.functions.scalar import ratio
from shopstar.operators.dims import UNKNOWN_KEY


# Columns that sum up lines, in the aggregate tables; the first four are the fact's own.
LINE_SUMS = (
    "total_amount", "gross_profit", "gross_sales", "quantity", "lines", "rating_sum", "rated", "low_rated")

# By which columns an invoice is counted, and the mark of its first row in the invoice table.
FIRST_OF = {
    (): "first_of_all", ("sale_year",): "first_of_year", ("sale_month",): "first_of_month",
    ("sale_month", "branch_key"): "first_of_month_branch", ("branch_key",): "first_of_branch",
    ("sale_hour",): "first_of_hour", ("identified",): "first_of_known",
}


def sale_year() -> Column:
    return F.year("sale_date")


def line_count(sales: DataFrame) -> Column:
    """Number of sales lines, of the fact or of an aggregate table."""
    return F.coalesce(F.sum("lines"), F.lit(0).cast("bigint")) if "lines" in sales.columns else F.count("*")


def rated_count(sales: DataFrame) -> Column:
    return F.coalesce(F.sum("rated"), F.lit(0).cast("bigint")) if "rated" in sales.columns else F.count("rating")


def low_rated_count(sales: DataFrame) -> Column:
    """Number of ratings of 5 or less."""
    if "low_rated" in sales.columns:
        return F.coalesce(F.sum("low_rated"), F.lit(0).cast("bigint"))
    return F.count(F.when(F.col("rating") <= 5, 1))


def rating_total(sales: DataFrame) -> Column:
    return F.sum("rating_sum" if "rating_sum" in sales.columns else "rating")


def rating_mean(sales: DataFrame) -> Column:
    return ratio(rating_total(sales), rated_count(sales))


def line_sums(sales: DataFrame) -> list[Column]:
    """LINE_SUMS over a group of the fact, or of an aggregate table."""
    return [
        *[F.sum(c).alias(c) for c in LINE_SUMS[:4]],
        line_count(sales).alias("lines"), rating_total(sales).alias("rating_sum"),
        rated_count(sales).alias("rated"), low_rated_count(sales).alias("low_rated")]


def invoice_count(sales: DataFrame, *by: str) -> Column:
    """Number of distinct invoices of a group by the columns `by`.

    The invoice table answers it by the sum of its marks, if there is one for
    this grouping; else the invoices are counted.
    """
    mark = FIRST_OF.get(by)
    if mark in sales.columns:
        return F.coalesce(F.sum(mark), F.lit(0)).cast("bigint")
    return F.countDistinct("invoice_id")


def with_calendar(fact: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    """Calendar attributes of each sale; the calendar is a few thousand rows."""
    return fact.join(F.broadcast(dim_date.select("date_key", *columns)), "date_key")


def identified() -> Column:
    return F.col("customer_key") != UNKNOWN_KEY


def in_years(sales: DataFrame, years: Sequence[int]) -> DataFrame:
    """Sales of some years; the filter names the stored folders, those of the cube or the months."""
    if "sale_year" in sales.columns:
        return sales.filter(F.col("sale_year").isin(*years))
    spans = [F.col("sale_month").between(F.make_date(F.lit(y), F.lit(1), F.lit(1)),
                                         F.make_date(F.lit(y), F.lit(12), F.lit(1))) for y in years]
    return sales.filter(reduce(Column.__or__, spans))


def how_many(df: DataFrame, column: str) -> Column:
    """Number of distinct values as a scalar.

    Several distinct counts in one aggregate would repeat every row once per
    count; apart, each reads one column and combines it on the map side.
    """
    return df.agg(F.countDistinct(column)).scalar()


def distinct_per(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    """Distinct values of a column per group, as a frame of its own."""
    return df.groupBy(*by).agg(F.countDistinct(column).alias(name))


def summarise(df: DataFrame, by: Sequence[str], sums: Sequence[Column],
              distinct: Mapping[str, str]) -> DataFrame:
    """Sums per group next to distinct counts {name: column}, few groups.

    Taken together, every sum would travel with each distinct value. Apart, the
    sums combine to one row per group and task, and a distinct count moves its
    own column only; what is joined is one row per group. Invoices that the marks
    of the invoice table count are sums like others.
    """
    marked = {n for n, c in distinct.items() if c == "invoice_id" and FIRST_OF.get(tuple(by)) in df.columns}
    out = df.groupBy(*by).agg(*sums, *[invoice_count(df, *by).alias(n) for n in distinct if n in marked])
    for name, column in distinct.items():
        if name in marked:
            continue
        out = out.join(distinct_per(df, by, column, name), list(by))
    return out
