"""Checks that the loaded data shows the patterns a retailer expects.

Every signal is one row: its name, the measured value and whether it passed.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.scalar import dbl, mean, ratio, rnd
from shopstar.operators.aggregates import sales
from shopstar.operators.baskets import product_bits
from shopstar.operators.branch import is_peak
from shopstar.operators.common import invoice_count, line_count, rating_mean
from shopstar.sources.store import date_range

# The bounds a signal has to reach.
DEFECT_BAND = (0.03, 0.06)
MIN_CAGR = 0.15
MAX_DIP_YOY = 0.05
MIN_REBOUND_YOY = 0.15
MIN_Q4_INDEX = 1.20
MIN_WEEKEND_INDEX = 1.15
MIN_SHARE_GAIN = 0.04
MAX_SHARE_LOSS = -0.03
MIN_REPEAT_RATE = 0.55
TOP_PART = 0.20
MIN_TOP_SHARE = 0.40
MIN_PEAK_PENALTY = 0.25
MIN_LIFT = 2.0
MIN_MARGIN_SPREAD = 0.15


def _signal(df: DataFrame, name: str, value: Column, passed: Column) -> DataFrame:
    """`value` and `passed` are columns of the one row of `df`; no value is a failure."""
    return df.select(
        F.lit(name).alias("check_name"),
        rnd(value, 4).alias("value"),
        F.coalesce(passed, F.lit(False)).cast("int").alias("passed"),
    )


def defect_profile(normalised: DataFrame, cfg: RetailConfig) -> DataFrame:
    first = ~F.col("is_duplicate")
    valid = F.coalesce(
        F.col("sale_date").between(F.lit(cfg.window_start), F.lit(cfg.window_end))
        & (F.col("quantity") > 0) & F.col("unit_price").isNotNull(), F.lit(False))

    def n(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    return normalised.agg(
        F.count("*").alias("raw_rows"),
        n(F.col("is_duplicate") | F.col("is_dirty")).alias("dirty_rows"),
        n(first).alias("after_dedupe"),
        n(first & ~valid).alias("rejected"),
        n(first & valid).alias("clean_rows"),
    )


def defect_rate(normalised: DataFrame, cfg: RetailConfig) -> DataFrame:
    rate = ratio(F.col("dirty_rows"), F.col("raw_rows"))
    return _signal(defect_profile(normalised, cfg), "defect rate in band", rate,
                   rate.between(*DEFECT_BAND))


def _yearly(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.year("sale_date").alias("yr")).agg(F.sum("total_amount").alias("rev"))


def _cagr_columns() -> list[Column]:
    years = F.max("yr") - F.min("yr")
    return [(F.pow(ratio(F.max_by("rev", "yr"), F.min_by("rev", "yr")),
                   F.try_divide(F.lit(1.0), dbl(years))) - 1).alias("cagr")]


def cagr(fact: DataFrame) -> DataFrame:
    c = F.col("cagr")
    return _signal(_yearly(fact).agg(*_cagr_columns()), "multi-year CAGR", c, c > MIN_CAGR)


def _year_on_year(fact: DataFrame, year: int) -> DataFrame:
    def of(y: int) -> Column:
        return F.max(F.when(F.col("yr") == y, F.col("rev")))

    both = date_range(fact, F.lit(date(year - 1, 1, 1)), F.lit(date(year, 12, 31)))
    return _yearly(both).agg((ratio(of(year), of(year - 1)) - 1).alias("yoy"))


def dip_year(fact: DataFrame, cfg: RetailConfig) -> DataFrame:
    yoy = F.col("yoy")
    return _signal(_year_on_year(fact, cfg.signals.dip_year), "dip year", yoy, yoy < MAX_DIP_YOY)


def rebound_year(fact: DataFrame, cfg: RetailConfig) -> DataFrame:
    yoy = F.col("yoy")
    return _signal(_year_on_year(fact, cfg.signals.rebound_year), "rebound year", yoy,
                   yoy > MIN_REBOUND_YOY)


def _index_of(fact: DataFrame, part: Column, chosen: tuple[int, ...]) -> DataFrame:
    """Mean of the chosen parts over the mean of all parts."""
    sums = fact.groupBy("sale_date").agg(F.sum("total_amount").alias("rev")).groupBy(
        part.alias("part")).agg(F.sum("rev").alias("rev"))
    picked = F.when(F.col("part").isin(*chosen), F.col("rev"))
    return sums.agg(ratio(mean(picked), mean(F.col("rev"))).alias("index"))


def q4_peak(fact: DataFrame) -> DataFrame:
    i = F.col("index")
    return _signal(_index_of(fact, F.month("sale_date"), (11, 12)), "Q4 seasonal peak", i,
                   i > MIN_Q4_INDEX)


def weekend_lift(fact: DataFrame) -> DataFrame:
    i = F.col("index")
    return _signal(_index_of(fact, F.weekday("sale_date") + 1, (6, 7)), "weekend lift", i,
                   i > MIN_WEEKEND_INDEX)


def _share_change(fact: DataFrame, dim_product: DataFrame, line: str) -> DataFrame:
    sums = (
        fact.groupBy(F.year("sale_date").alias("yr"), "product_key")
        .agg(F.sum("total_amount").alias("rev"))
        .join(dim_product.select("product_key", "product_line"), "product_key")
        .groupBy("yr").agg(
            ratio(F.sum(F.when(F.col("product_line") == line, F.col("rev"))), F.sum("rev"))
            .alias("share")))
    return sums.agg((F.max_by("share", "yr") - F.min_by("share", "yr")).alias("change"))


def mix_gain(fact: DataFrame, dim_product: DataFrame, cfg: RetailConfig) -> DataFrame:
    c = F.col("change")
    return _signal(_share_change(fact, dim_product, cfg.signals.gaining_line),
                   "line gaining share", c, c > MIN_SHARE_GAIN)


def mix_loss(fact: DataFrame, dim_product: DataFrame, cfg: RetailConfig) -> DataFrame:
    c = F.col("change")
    return _signal(_share_change(fact, dim_product, cfg.signals.losing_line),
                   "line losing share", c, c < MAX_SHARE_LOSS)


def repeat_rate(rfm_base: DataFrame) -> DataFrame:
    rate = F.col("rate")
    repeaters = F.count(F.when(F.col("frequency") > 1, 1))
    return _signal(rfm_base.agg(ratio(repeaters, F.count("*")).alias("rate")),
                   "repeat-purchase rate", rate, rate > MIN_REPEAT_RATE)


def top20_share(rfm: DataFrame) -> DataFrame:
    """Part of all spend by the best fifth; the fifth is cut by the place by spend that the table keeps."""
    cut = F.floor(dbl(rfm.agg(F.count("*")).scalar()) * F.lit(TOP_PART))
    spend = F.col("monetary")
    share = rfm.withColumn("best", F.col("monetary_rank") <= cut).agg(
        ratio(F.sum(F.when(F.col("best"), spend)), F.sum(spend)).alias("share"))
    s = F.col("share")
    return _signal(share, "spend concentration", s, s > MIN_TOP_SHARE)


def peak_rating_penalty(fact: DataFrame, cfg: RetailConfig) -> DataFrame:
    hours = fact.groupBy("sale_hour").agg(rating_mean(fact).alias("rating"))
    peak = F.avg(F.when(is_peak(cfg), F.col("rating")))
    off = F.avg(F.when(~is_peak(cfg), F.col("rating")))
    gap = F.col("gap")
    return _signal(hours.agg((off - peak).alias("gap")), "peak-hour rating penalty", gap,
                   gap > MIN_PEAK_PENALTY)


def affinity_lift(masks: DataFrame, dim_product: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Lift of a known pair among baskets of more than one product, from the stored basket masks."""
    a, b = cfg.signals.affinity_pair
    known = F.broadcast(product_bits(dim_product.filter(F.col("sku").isin(a, b)), cfg).select(
        "block", *[F.when(F.col("sku") == sku, F.col("bit")).otherwise(F.lit(0).cast("bigint")).alias(name)
                   for sku, name in ((a, "bit_a"), (b, "bit_b"))],
    ).groupBy("block").agg(F.bit_or("bit_a").alias("bit_a"), F.bit_or("bit_b").alias("bit_b")))

    def held(bit: str) -> Column:
        return F.max(F.coalesce(F.col("mask").bitwiseAND(F.col(bit)) != 0, F.lit(False)))

    baskets = masks.join(known, "block", "left").groupBy("invoice_id").agg(
        F.sum(F.bit_count("mask")).alias("items"), held("bit_a").alias("a"), held("bit_b").alias("b"),
    ).filter(F.col("items") > 1)

    def part(cond: Column) -> Column:
        return ratio(F.count(F.when(cond, 1)), F.count("*"))

    both, pa, pb = part(F.col("a") & F.col("b")), part(F.col("a")), part(F.col("b"))
    lift = F.col("lift")
    return _signal(
        baskets.agg(F.coalesce(F.try_divide(both, pa * pb), F.lit(0.0)).alias("lift")),
        "known affinity pair", lift, lift > MIN_LIFT)


def margin_spread(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    lines = (
        fact.groupBy("product_key")
        .agg(F.sum("gross_profit").alias("p"), F.sum("gross_sales").alias("g"))
        .join(dim_product.select("product_key", "product_line"), "product_key")
        .groupBy("product_line").agg(ratio(F.sum("p"), F.sum("g")).alias("margin")))
    s = F.col("spread")
    return _signal(lines.agg((F.max("margin") - F.min("margin")).alias("spread")),
                   "margin spread across lines", s, s > MIN_MARGIN_SPREAD)


def headline_figures(fact: DataFrame, dim_branch: DataFrame, rfm_base: DataFrame) -> DataFrame:
    totals = fact.agg(
        line_count(fact).alias("line_items"),
        F.min("sale_date").alias("first_sale"),
        F.max("sale_date").alias("last_sale"),
        F.sum("total_amount").alias("rev"),
        F.sum("gross_profit").alias("profit"),
    )
    cities = fact.select("branch_key").distinct().join(dim_branch, "branch_key").groupBy("city").agg(
        F.count("*").alias("branches"))
    places = cities.agg(F.struct(F.coalesce(F.sum("branches"), F.lit(0).cast("bigint")).alias("branches"),
                                 F.count("city").alias("cities"))).scalar()
    spread = rfm_base.groupBy("frequency").agg(F.count("*").alias("n")).agg(F.struct(
        F.sum("n").alias("customers"),
        F.percentile("frequency", 0.5, F.col("n")).alias("p50"),
        F.percentile("frequency", 0.9, F.col("n")).alias("p90"),
        F.max("frequency").alias("most"))).scalar()
    growth = _yearly(fact).agg(*_cagr_columns()).scalar()
    # Apart, as of plain lines it is a distinct count, which the sums would travel with.
    invoices = fact.agg(invoice_count(fact)).scalar()
    return totals.withColumns({"places": places, "spread": spread, "invoices": invoices}).select(
        "line_items", "invoices",
        F.col("spread.customers").alias("customers"),
        F.col("places.branches").alias("branches"),
        F.col("places.cities").alias("cities"),
        "first_sale", "last_sale",
        dbl(F.round("rev", 0)).alias("total_revenue"),
        dbl(F.round("profit", 0)).alias("gross_profit"),
        rnd(ratio(F.col("rev"), F.col("invoices")), 2).alias("avg_basket_value"),
        rnd(growth, 4).alias("revenue_cagr"),
        F.col("spread.p50").alias("orders_p50"),
        F.col("spread.p90").alias("orders_p90"),
        F.col("spread.most").alias("orders_max"),
    )


# Every signal by its short name.
SIGNALS = {
    "sig_defect_rate": lambda w: defect_rate(w.normalised, w.cfg),
    "sig_cagr": lambda w: cagr(sales(w)),
    "sig_dip_year": lambda w: dip_year(sales(w), w.cfg),
    "sig_rebound_year": lambda w: rebound_year(sales(w), w.cfg),
    "sig_q4_peak": lambda w: q4_peak(sales(w)),
    "sig_weekend_lift": lambda w: weekend_lift(sales(w)),
    "sig_mix_gain": lambda w: mix_gain(sales(w, "product_key"), w.dim_product, w.cfg),
    "sig_mix_loss": lambda w: mix_loss(sales(w, "product_key"), w.dim_product, w.cfg),
    "sig_repeat_rate": lambda w: repeat_rate(w.rfm_base),
    "sig_top20_share": lambda w: top20_share(w.customer_rfm),
    "sig_peak_rating_penalty": lambda w: peak_rating_penalty(sales(w, "sale_hour"), w.cfg),
    "sig_affinity_lift": lambda w: affinity_lift(w.basket_masks, w.dim_product, w.cfg),
    "sig_margin_spread": lambda w: margin_spread(sales(w, "product_key"), w.dim_product),
}


def signal_report(wh) -> DataFrame:
    """All signals; none of them reads the sales lines, only tables made of them."""
    return reduce(DataFrame.unionByName, (build(wh) for build in SIGNALS.values()))


def assert_signals(report: DataFrame) -> None:
    failed = [r["check_name"] for r in report.filter(F.col("passed") == 0).collect()]
    if failed:
        raise RuntimeError(f"{len(failed)} signal(s) missing: {'; '.join(failed)}")
