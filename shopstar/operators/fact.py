"""The fact at invoice line grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.ranking import number_rows
from shopstar.functions.scalar import date_number
from shopstar.functions.skew import lookup
from shopstar.operators.dims import UNKNOWN_KEY
from shopstar.schemas import FACT_COLUMNS


class OutOfWindowError(RuntimeError):
    """Sales dated outside the declared months reached the fact."""


def resolve_keys(sales: DataFrame, scan: DataFrame, dims: dict[str, DataFrame],
                 cfg: RetailConfig) -> DataFrame:
    """Natural to surrogate keys; a miss points to the Unknown member."""
    pairs = [
        ("dim_branch", "branch_code", "branch_code", "branch_key"),
        ("dim_product", "sku", "product_sku", "product_key"),
        ("dim_customer", "customer_id", "customer_id", "customer_key"),
        ("dim_payment", "payment_method", "payment_method", "payment_key"),
    ]
    out = sales
    for dim, natural, source, key in pairs:
        one = dims[dim].select(F.col(natural).alias(source), key)
        out = lookup(out, one, [source], cfg, "sale_id", "left", scan, dims[dim])
        out = out.withColumn(key, F.coalesce(key, F.lit(UNKNOWN_KEY)))
    return out


def fact_sales(stored_sales: DataFrame, dims: dict[str, DataFrame],
               cfg: RetailConfig) -> DataFrame:
    """Global sale ids in (date, time, invoice, line) order, keys resolved.

    `stored_sales` is the clean table as written: sorted over that order, with
    the position of each row, so the ids cost no further shuffle.
    """
    numbered = number_rows(stored_sales, "sale_id").drop("_total")
    keyed = resolve_keys(numbered, stored_sales, dims, cfg)
    derived = {
        "date_key": date_number(F.col("sale_date")),
        "sale_month": F.trunc("sale_date", "month"),
    }
    return keyed.select(*(
        derived.get(name, F.col(name)).cast(dtype).alias(name)
        for name, dtype in FACT_COLUMNS.items()))


def outside_window(fact: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Rows per month that no declared month would take; empty for a sound load."""
    return fact.filter(
        ~F.col("sale_date").between(F.lit(cfg.window_start), F.lit(cfg.window_end))
    ).groupBy("sale_month").agg(F.count("*").alias("rows_outside"))


def assert_no_default_partition(fact: DataFrame, cfg: RetailConfig) -> None:
    n = outside_window(fact, cfg).agg(F.coalesce(F.sum("rows_outside"), F.lit(0))).first()[0]
    if n:
        raise OutOfWindowError(f"{n} fact rows lie outside the declared months")
