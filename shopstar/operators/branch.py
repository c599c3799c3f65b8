"""Branch performance and store operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.scalar import all_rows, mean, money, pct, ratio, rnd
from shopstar.operators.common import (
    FIRST_OF, distinct_per, identified, in_years, invoice_count, low_rated_count, rated_count, rating_mean,
    rating_total, summarise, with_calendar)
from shopstar.operators.product import with_all, yearly_shares

# ISO weekdays 1 to 7.
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")


def scorecard(fact: DataFrame, dim_branch: DataFrame, cfg: RetailConfig) -> DataFrame:
    by = ["branch_key"]
    marked = FIRST_OF[("branch_key",)] in fact.columns
    days = fact.groupBy("branch_key", "sale_date").agg(
        F.sum("total_amount").alias("rev"), F.sum("gross_profit").alias("profit"),
        rating_total(fact).alias("rating_sum"), rated_count(fact).alias("rated"),
        *([invoice_count(fact, *by).alias("invoices")] if marked else []))
    per_branch = days.groupBy(*by).agg(
        F.count("*").alias("trading_days"),
        F.sum("rev").alias("rev"),
        F.sum("profit").alias("profit"),
        ratio(F.sum("rating_sum"), F.sum("rated")).alias("rating"),
        *([F.sum("invoices").alias("invoices")] if marked else []))
    if not marked:
        per_branch = per_branch.join(distinct_per(fact, by, "invoice_id", "invoices"), by)
    per_branch = per_branch.join(
        distinct_per(fact.filter(identified()), by, "customer_key", "customers"), by, "left"
    ).fillna(0, ["customers"])
    c = F.col
    daily = ratio(c("rev"), c("trading_days"))
    net = c("rev").cast("double") / F.lit(1.0 + float(cfg.tax_rate))
    return per_branch.join(dim_branch, "branch_key").select(
        "branch_code", "city", "size_band", "opened_date", "trading_days",
        money(c("rev")).alias("revenue"),
        money(c("profit")).alias("gross_profit"),
        pct(c("profit"), net).alias("margin_pct"),
        rnd(daily, 0).alias("revenue_per_trading_day"),
        rnd(ratio(c("rev"), c("invoices")), 2).alias("avg_basket"),
        rnd(c("rating"), 2).alias("avg_rating"),
        "customers",
        F.rank().over(W.orderBy(F.desc("rev"))).alias("rank_by_revenue"),
        F.rank().over(W.orderBy(daily.desc())).alias("rank_by_daily_rate"),
        F.rank().over(W.orderBy(F.desc_nulls_first("rating"))).alias("rank_by_rating"),
    ).orderBy(F.desc("revenue"), "branch_code")


def region_rollup(fact: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Cities, regions and the whole; shares are of all sales, so the whole is 100.

    The rollup runs over one row per branch, not over the expanded fact.
    """
    per_branch = fact.groupBy("branch_key").agg(
        F.sum("total_amount").alias("rev"), F.sum("gross_profit").alias("prof"),
        rating_total(fact).alias("rating_sum"), rated_count(fact).alias("rated"))
    rolled = per_branch.join(dim_branch.select("branch_key", "region", "city"), "branch_key").rollup(
        "region", "city"
    ).agg(
        F.countDistinct("branch_key").alias("branches"),
        F.grouping_id().alias("level"),
        *(F.sum(x).alias(x) for x in ("rev", "prof", "rating_sum", "rated")))
    c = F.col
    # Level 3 is the row over all regions and cities.
    every = F.max(F.when(c("level") == 3, c("rev"))).over(all_rows())
    return rolled.select(
        "region", "city", "branches",
        money(c("rev")).alias("revenue"),
        pct(c("rev"), every).alias("pct_of_revenue"),
        money(c("prof")).alias("profit"),
        rnd(ratio(c("rev"), c("branches")), 0).alias("revenue_per_branch"),
        rnd(ratio(c("rating_sum"), c("rated")), 2).alias("avg_rating"),
    ).orderBy(F.asc_nulls_last("region"), F.desc_nulls_last("revenue"), F.asc_nulls_last("city"))


def hour_weekday_heatmap(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue per occurrence of each hour and weekday.

    Summing per hour and day first turns the count of distinct days into a
    count of rows.
    """
    slots = fact.groupBy("sale_hour", "date_key").agg(F.sum("total_amount").alias("rev"))
    pivoted = (
        with_calendar(slots, dim_date, "day_of_week")
        .groupBy("sale_hour").pivot("day_of_week", list(range(1, 8)))
        .agg(F.sum("rev").alias("rev"), F.count("rev").alias("days"))
    )
    return pivoted.select(
        "sale_hour",
        *(rnd(ratio(F.col(f"{i}_rev"), F.col(f"{i}_days")), 0).alias(name)
          for i, name in enumerate(WEEKDAYS, 1)),
    ).orderBy("sale_hour")


def hourly_service(fact: DataFrame) -> DataFrame:
    hourly = summarise(
        fact, ["sale_hour"],
        [F.sum("total_amount").alias("rev"), rating_mean(fact).alias("rating")],
        {"invoices": "invoice_id"})
    c = F.col
    return hourly.select(
        "sale_hour",
        money(c("rev")).alias("revenue"),
        pct(c("rev"), F.sum("rev").over(all_rows())).alias("pct_of_revenue"),
        "invoices",
        rnd(ratio(c("rev"), c("invoices")), 2).alias("avg_basket"),
        rnd(c("rating"), 2).alias("avg_rating"),
        rnd(c("rating") - F.avg("rating").over(all_rows()), 2).alias("rating_vs_mean"),
        F.rank().over(W.orderBy(F.desc("rev"))).alias("busiest_rank"),
        F.rank().over(W.orderBy(F.desc_nulls_first("rating"))).alias("rating_rank"),
    ).orderBy(F.desc("revenue"), "sale_hour")


def is_peak(cfg: RetailConfig) -> Column:
    return F.col("sale_hour").between(cfg.peak_from, cfg.peak_to)


def peak_service_gap(fact: DataFrame, cfg: RetailConfig) -> DataFrame:
    label = F.when(is_peak(cfg), f"Peak ({cfg.peak_from}-{cfg.peak_to})").otherwise("Off-peak")
    hours = fact.groupBy("sale_hour").agg(
        F.sum("total_amount").alias("rev"), rating_total(fact).alias("rating_sum"),
        low_rated_count(fact).alias("low"), rated_count(fact).alias("rated"))
    periods = hours.groupBy(label.alias("period")).agg(
        F.sum("rev").alias("rev"), ratio(F.sum("rating_sum"), F.sum("rated")).alias("rating"),
        F.sum("low").alias("low"), F.sum("rated").alias("rated"), F.count("sale_hour").alias("hours"),
    ).join(distinct_per(fact.withColumn("period", label), ["period"], "invoice_id", "invoices"), "period")
    c = F.col
    return periods.select(
        "period", "invoices",
        money(c("rev")).alias("revenue"),
        pct(c("rev"), F.sum("rev").over(all_rows())).alias("pct_of_revenue"),
        rnd(ratio(c("invoices"), c("hours")), 0).alias("invoices_per_hour_slot"),
        rnd(c("rating"), 2).alias("avg_rating"),
        pct(c("low"), c("rated")).alias("pct_ratings_5_or_below"),
    ).orderBy(F.desc("revenue"))


def payment_adoption(fact: DataFrame, dim_date: DataFrame, dim_payment: DataFrame,
                     cfg: RetailConfig) -> DataFrame:
    first, _, last = cfg.share_years
    names = dim_payment.select("payment_key", "payment_method")
    sums = (
        with_calendar(in_years(fact, cfg.share_years), dim_date, "year_number")
        .groupBy(F.col("year_number").alias("yr"), "payment_key")
        .agg(F.sum("total_amount").alias("revenue"))
        .join(names, "payment_key")
    )
    used = fact.select("payment_key").distinct().join(names, "payment_key").select("payment_method")
    c = F.col
    return with_all(used, yearly_shares(sums, "payment_method", cfg.share_years), "payment_method").select(
        "payment_method",
        *(rnd(c(f"{y}_share"), 1).alias(f"y{y}") for y in cfg.share_years),
        rnd(c(f"{last}_share") - c(f"{first}_share"), 1).alias("change_pts"),
    ).orderBy(F.desc(f"y{last}"), "payment_method")


def rank_movement(fact: DataFrame, dim_date: DataFrame, dim_branch: DataFrame,
                  cfg: RetailConfig) -> DataFrame:
    """Places by revenue per trading day; the daily sums make days countable rows."""
    daily = in_years(fact, cfg.rank_years).groupBy("branch_key", "date_key").agg(
        F.sum("total_amount").alias("rev"))
    rates = (
        with_calendar(daily, dim_date, "year_number")
        .groupBy(F.col("year_number").alias("yr"), "branch_key")
        .agg(mean(F.col("rev")).alias("rate"))
    )
    place = F.rank().over(W.partitionBy("yr").orderBy(F.desc("rate")))
    pivoted = (
        rates.withColumn("place", place)
        .groupBy("branch_key").pivot("yr", list(cfg.rank_years))
        .agg(F.max("place").alias("place"), F.max("rate").alias("rate"))
    )
    first, _, last = cfg.rank_years
    c = F.col
    traded = with_all(fact.select("branch_key").distinct(), pivoted, "branch_key")
    return traded.join(dim_branch.select("branch_key", "branch_code"), "branch_key").select(
        "branch_code",
        *(c(f"{y}_place").alias(f"rank_{y}") for y in cfg.rank_years),
        (c(f"{first}_place") - c(f"{last}_place")).alias("places_gained"),
        rnd(c(f"{last}_rate"), 0).alias(f"daily_rate_{last}"),
    ).orderBy(F.desc_nulls_last("places_gained"), "branch_code")


def rating_distribution(fact: DataFrame, dim_branch: DataFrame) -> DataFrame:
    rated = F.count("rating")
    high = F.count(F.when(F.col("rating") >= 9, 1))
    low = F.count(F.when(F.col("rating") <= 5, 1))
    per_branch = fact.groupBy("branch_key").agg(
        rated.alias("rated_transactions"),
        rnd(mean(F.col("rating")), 2).alias("avg_rating"),
        pct(high, rated).alias("pct_promoters"),
        pct(low, rated).alias("pct_detractors"),
        rnd(ratio(F.lit(100.0) * high, rated) - ratio(F.lit(100.0) * low, rated), 1)
        .alias("net_promoter_style_score"),
    )
    return per_branch.join(dim_branch.select("branch_key", "branch_code", "city"), "branch_key").drop(
        "branch_key").orderBy(F.desc("net_promoter_style_score"), "branch_code")
