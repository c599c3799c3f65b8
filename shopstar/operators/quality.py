"""Eighteen assertions over the loaded warehouse, their reports, audit and gate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import TYPE_CHECKING, NamedTuple

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shopstar.functions.scalar import all_rows, initcap_words, pct
from shopstar.operators.aggregates import sales
from shopstar.operators.clean import PAYMENT_METHODS
from shopstar.operators.dims import UNKNOWN_KEY

if TYPE_CHECKING:
    from shopstar.plans.warehouse import Warehouse


class QualityGateError(RuntimeError):
    """At least one assertion failed."""


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


# Gives the column of a named counter of the check at hand.
Counter = Callable[[str], Column]


@dataclass(frozen=True)
class Check:
    """One assertion: aggregates over a source, a verdict and a text over them."""

    check_id: int
    key: str
    category: str
    name: str
    expected: str
    source: Callable[["Warehouse"], DataFrame]
    counters: Callable[["Warehouse"], dict[str, Column]]
    passed: Callable[[Counter], Column]
    actual: Callable[[Counter], Column]


def _text(suffix: str = "") -> Callable[[Counter], Column]:
    return lambda c: F.concat(c("n").cast("string"), F.lit(suffix))


def _zero(c: Counter) -> Column:
    return c("n") == 0


def fact_rows(wh: "Warehouse") -> DataFrame:
    return wh.fact_sales


def one_row(wh: "Warehouse") -> DataFrame:
    return wh.spark.range(1)


def _count(df: DataFrame) -> Column:
    return F.max(df.agg(F.count("*")).scalar())


def _sum(df: DataFrame, c: str) -> Column:
    return F.max(df.agg(F.sum(c)).scalar())


def duplicate_grain(wh: "Warehouse") -> DataFrame:
    return wh.fact_sales.groupBy("invoice_id", "line_no").agg(
        F.count("*").alias("copies")).filter(F.col("copies") > 1)


def orphans(wh: "Warehouse") -> DataFrame:
    """Fact rows with a key that some dimension lacks.

    The keys in use meet the dimensions, one row per key. Only keys that miss are
    looked up among the sales, and no line passes the filter before those joins if
    there is none, as in a sound load.
    """
    keys = {
        "date_key": wh.dim_date, "branch_key": wh.dim_branch, "product_key": wh.dim_product,
        "customer_key": wh.dim_customer, "payment_key": wh.dim_payment,
    }
    lost = {
        key: wh.fact_sales.groupBy(key).agg(F.count("*").alias("_lines"))
        .join(dim.select(key), key, "left_anti").select(key, F.lit(True).alias(f"lost_{key}"))
        for key, dim in keys.items()}
    found = reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n")) for df in lost.values()))
    rows = wh.fact_sales.select(*keys).filter(found.agg(F.sum("n")).scalar() > 0)
    for key, df in lost.items():
        rows = rows.join(df, key, "left")
    return rows.filter(reduce(Column.__or__, (F.col(f"lost_{k}").isNotNull() for k in keys)))


# How many payment texts outside the vocabulary a report names.
NAMED_OFFENDERS = 20


def unknown_payments(wh: "Warehouse") -> DataFrame:
    """The payment texts outside the vocabulary with most sales, and how many there are in all."""
    strange = wh.dim_payment.filter(~F.col("payment_method").isin(*PAYMENT_METHODS, "Unknown"))
    used = sales(wh, "payment_key").groupBy("payment_key").agg(F.sum("lines").alias("_lines"))
    return (
        strange.join(used, "payment_key", "left")
        .orderBy(F.desc_nulls_last("_lines"), "payment_method").limit(NAMED_OFFENDERS)
        .withColumn("_every", strange.agg(F.count("*")).scalar()))


def _named(c: "Counter") -> Column:
    more = F.when(c("more") > 0, F.concat(F.lit(" and "), c("more").cast("string"), F.lit(" more")))
    return F.coalesce(F.concat(c("offenders"), F.coalesce(more, F.lit(""))), F.lit("none"))


def missing_days(wh: "Warehouse") -> DataFrame:
    days = F.explode(F.sequence(F.lit(wh.cfg.window_start), F.lit(wh.cfg.window_end)))
    traded = wh.fact_sales.select(F.col("sale_date").alias("day")).distinct()
    return wh.spark.range(1).select(days.alias("day")).join(traded, "day", "left_anti")


def branch_month_gaps(wh: "Warehouse") -> DataFrame:
    """Months from its opening on in which a branch sold nothing."""
    months = F.explode(F.sequence(
        F.trunc(F.lit(wh.cfg.window_start), "month"), F.trunc(F.lit(wh.cfg.window_end), "month"),
        F.expr("interval 1 month")))
    open_months = wh.dim_branch.filter(F.col("branch_key") != UNKNOWN_KEY).select(
        "branch_key", "opened_date", months.alias("sale_month")
    ).filter(F.col("opened_date") <= F.col("sale_month"))
    traded = wh.fact_sales.select("branch_key", "sale_month").distinct()
    return open_months.join(traded, ["branch_key", "sale_month"], "left_anti")


def _violations(cond: Callable[["Warehouse"], Column]) -> Callable[["Warehouse"], dict[str, Column]]:
    return lambda wh: {"n": count_if(cond(wh))}


def _rows(_: "Warehouse") -> dict[str, Column]:
    return {"n": F.count("*")}


def _far(a: Column, b: Column) -> Column:
    return F.abs(a - b) > 0.01


def _outside(wh: "Warehouse") -> Column:
    return ~F.col("sale_date").between(F.lit(wh.cfg.window_start), F.lit(wh.cfg.window_end))


def _percent(name: str) -> Callable[[Counter], Column]:
    return lambda c: F.format_string("%.2f%%", c(name))


# Numbers, categories, names, limits and report texts of the checks.
CHECKS = (
    Check(1, "dq_raw_reconciles", "reconciliation", "raw rows = staged + rejected", "diff = 0",
          one_row,
          lambda wh: {"raw": _count(wh.sales_landing), "staged": _count(wh.stg_sales),
                      "rejected": _count(wh.stg_sales_rejects)},
          lambda c: c("raw") == c("staged") + c("rejected"),
          lambda c: F.format_string(
              "raw=%d staged=%d rejected=%d diff=%d", c("raw"), c("staged"), c("rejected"),
              c("raw") - c("staged") - c("rejected"))),
    Check(2, "dq_stage_fact_rows", "reconciliation", "staged rows = fact rows", "equal",
          one_row,
          lambda wh: {"staged": _count(wh.stg_sales), "fact": _count(wh.fact_sales)},
          lambda c: c("staged") == c("fact"),
          lambda c: F.format_string("staged=%d fact=%d", c("staged"), c("fact"))),
    Check(3, "dq_revenue_ties", "reconciliation", "revenue ties staging to mart",
          "difference < 0.01", one_row,
          lambda wh: {"staging": _sum(wh.stg_sales, "total_amount"),
                      "mart": _sum(wh.fact_sales, "total_amount")},
          lambda c: F.abs(c("staging") - c("mart")) < 0.01,
          lambda c: F.concat(
              F.lit("staging="), F.round(c("staging"), 2).cast("string"),
              F.lit(" mart="), F.round(c("mart"), 2).cast("string"),
              F.lit(" diff="),
              F.round(F.abs(c("staging") - c("mart")), 4).cast("string"))),
    Check(4, "dq_grain_unique", "integrity", "fact grain is unique (invoice_id, line_no)",
          "0 duplicate keys", duplicate_grain, _rows, _zero, _text()),
    Check(5, "dq_no_orphans", "integrity", "no orphaned foreign keys", "0 orphans",
          orphans, _rows, _zero, _text()),
    Check(6, "dq_no_unknown_keys", "integrity", "no rows fell back to Unknown dimension members",
          "0 rows", fact_rows,
          _violations(lambda wh: (F.col("branch_key") == UNKNOWN_KEY)
                      | (F.col("product_key") == UNKNOWN_KEY)
                      | (F.col("payment_key") == UNKNOWN_KEY)),
          _zero, _text()),
    Check(7, "dq_default_partition_empty", "integrity", "default partition is empty", "0 rows",
          fact_rows, _violations(_outside), _zero, _text()),
    Check(8, "dq_quantity_positive", "validity", "quantity > 0 on every row", "0 violations",
          fact_rows, _violations(lambda wh: F.col("quantity") <= 0), _zero, _text()),
    Check(9, "dq_rating_domain", "validity", "rating within 1-10 or NULL", "0 violations",
          fact_rows, _violations(lambda wh: ~F.col("rating").between(1, 10)),
          _zero, _text()),
    Check(10, "dq_date_window", "validity", "sale_date within the reporting window",
          "0 out of range", fact_rows, _violations(_outside), _zero, _text()),
    Check(11, "dq_city_conformed", "validity",
          "city values conformed (no casing/whitespace variants)", "0 variants",
          lambda wh: wh.dim_branch,
          _violations(lambda wh: F.col("city") != initcap_words(F.trim("city"))),
          _zero, _text()),
    Check(12, "dq_payment_vocabulary", "validity", "payment methods in controlled vocabulary",
          "only Cash/Credit card/Ewallet",
          unknown_payments,
          lambda wh: {"n": F.coalesce(F.max("_every"), F.lit(0).cast("bigint")),
                      "more": F.coalesce(F.max("_every"), F.lit(0).cast("bigint")) - F.count("*"),
                      "offenders": F.expr(
                          "listagg(payment_method, ', ') within group (order by payment_method)")},
          _zero, _named),
    Check(13, "dq_gross_consistent", "consistency", "gross_sales = unit_price * quantity",
          "0 mismatches", fact_rows,
          _violations(lambda wh: _far(
              F.col("gross_sales"), F.col("unit_price") * F.col("quantity"))),
          _zero, _text()),
    Check(14, "dq_total_profit_consistent", "consistency",
          "total = gross + tax and profit = gross - cogs", "0 mismatches", fact_rows,
          _violations(lambda wh: _far(
              F.col("total_amount"), F.col("gross_sales") + F.col("tax_amount"))
              | _far(F.col("gross_profit"), F.col("gross_sales") - F.col("cogs"))),
          _zero, _text()),
    Check(15, "dq_margin_plausible", "consistency", "blended gross margin within 5-60%",
          "between 5% and 60%", fact_rows,
          lambda wh: {"m": pct(F.sum("gross_profit"), F.sum("gross_sales"), 2)},
          lambda c: c("m").between(5, 60), _percent("m")),
    Check(16, "dq_no_missing_days", "completeness", "no missing trading days in the window",
          "0 gaps", missing_days, _rows, _zero, _text(" missing days")),
    Check(17, "dq_branch_trades_monthly", "completeness", "every open branch trades every month",
          "0 gaps", branch_month_gaps, _rows, _zero, _text(" branch-months")),
    Check(18, "dq_rating_null_rate", "completeness", "rating null rate below 2%", "< 2%",
          fact_rows,
          lambda wh: {"p": pct(count_if(F.col("rating").isNull()), F.count("*"), 2)},
          lambda c: c("p") < 2.0, _percent("p")),
)


def evaluate(wh: "Warehouse", checks: tuple[Check, ...]) -> DataFrame:
    """Run checks; all that read the same source share one pass over it."""
    groups: dict[Callable, list[Check]] = {}
    for check in checks:
        groups.setdefault(check.source, []).append(check)
    return reduce(
        DataFrame.unionByName, (_verdicts(wh, source, of) for source, of in groups.items()))


def _verdicts(wh: "Warehouse", source: Callable, checks: list[Check]) -> DataFrame:
    """All counters of a source in one row, then one row per check out of it."""
    def counter(check: Check) -> Counter:
        return lambda name: F.col(f"{check.key}__{name}")

    sums = source(wh).agg(*(
        column.alias(f"{k.key}__{name}")
        for k in checks for name, column in k.counters(wh).items()))
    verdicts = F.array(*(
        F.struct(
            F.lit(k.check_id).alias("check_id"),
            F.lit(k.category).alias("category"),
            F.lit(k.name).alias("check_name"),
            F.when(k.passed(counter(k)), "PASS").otherwise("FAIL").alias("status"),
            k.actual(counter(k)).alias("actual_value"),
            F.lit(k.expected).alias("expected"))
        for k in checks))
    return sums.select(F.explode(verdicts).alias("v")).select("v.*")


def run_checks(wh: "Warehouse") -> DataFrame:
    return evaluate(wh, CHECKS)


def dq_report(results: DataFrame) -> DataFrame:
    return results.orderBy("check_id")


def dq_category_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("category").agg(
        F.count("*").alias("checks"),
        count_if(F.col("status") == "PASS").alias("passed"),
        count_if(F.col("status") == "FAIL").alias("failed"),
    ).orderBy("category")


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason").agg(F.count("*").alias("rows_rejected")).orderBy(
        F.desc("rows_rejected"), "reject_reason")


def dq_reject_breakdown(rejects: DataFrame, landed: DataFrame) -> DataFrame:
    source = landed.agg(F.count("*")).scalar()
    rows = F.col("rows_rejected")
    return reject_counts(rejects).select(
        "reject_reason", "rows_rejected",
        pct(rows, F.sum(rows).over(all_rows())).alias("pct_of_rejects"),
        pct(rows, source, 2).alias("pct_of_source"),
    ).orderBy(F.desc("rows_rejected"), "reject_reason")


def dq_gate(results: DataFrame) -> int:
    """Raise if any assertion failed; else return how many passed."""
    failed = [r["check_name"] for r in results.filter(F.col("status") == "FAIL").collect()]
    if failed:
        raise QualityGateError(f"{len(failed)} assertion(s) failed: {'; '.join(failed)}")
    return results.count()


class Hop(NamedTuple):
    """A counted step of the load; `after` is the stored table that completes it."""

    step: str
    table: str
    after: str
    notes: str | None
    rows: Callable[[DataFrame], DataFrame] = lambda stored: stored


# Step names, table names and notes of the trail.
HOPS = (
    Hop("extract", "raw.sales_landing", "sales_landing", "rows as delivered by source"),
    Hop("reject", "staging.stg_sales_rejects", "stg_sales_rejects", "quarantined with reason code"),
    Hop("clean", "staging.stg_sales", "stg_sales_sorted", "typed, deduplicated, conformed"),
    Hop("dimensions", "marts.dim_date", "dim_date", None),
    Hop("dimensions", "marts.dim_branch", "dim_branch", None),
    Hop("dimensions", "marts.dim_product", "dim_product", None),
    Hop("dimensions", "marts.dim_customer", "dim_customer_static", None),
    Hop("dimensions", "marts.dim_payment", "dim_payment", None),
    Hop("load", "marts.fact_sales", "fact_sales", "invoice-line grain, surrogate keys resolved"),
    Hop("enrich", "marts.dim_customer", "dim_customer", "customers with at least one purchase",
        lambda c: c.filter("first_purchase_date is not null")),
    Hop("enrich", "marts.dim_customer.never_activated", "dim_customer", "signed up, never transacted",
        lambda c: c.filter("is_member and first_purchase_date is null")),
    Hop("rfm", "staging.customer_rfm", "customer_rfm", "scored customers"),
    Hop("powerbi", "marts.dim_customer_rfm", "dim_customer_rfm", "RFM segment dimension"),
)


def hop_row(audit_id: int, stored: DataFrame) -> DataFrame:
    """The audit row of a hop, with the time at which it is written."""
    hop = HOPS[audit_id - 1]
    return hop.rows(stored).agg(F.count("*").alias("row_count")).select(
        F.lit(audit_id).alias("audit_id"), F.lit(hop.step).alias("step_name"),
        F.lit(hop.table).alias("table_name"), "row_count",
        F.current_timestamp().alias("loaded_at"), F.lit(hop.notes).cast("string").alias("notes"))


def append_audit(wh: "Warehouse") -> DataFrame:
    """Row count at every hop, in load order, as noted when each step ended."""
    for hop in HOPS:
        wh.table(hop.after)
    return wh.audit_trail()


def load_audit_report(audit: DataFrame) -> DataFrame:
    """The audit trail with the change from the previous hop."""
    change = F.col("row_count") - F.lag("row_count").over(W.orderBy("audit_id"))
    return audit.select(
        "audit_id", "step_name", "table_name", "row_count",
        change.alias("delta_from_prev"), "loaded_at", "notes").orderBy("audit_id")
