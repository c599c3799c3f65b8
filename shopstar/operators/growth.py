"""Revenue growth and trend. Windows run only over aggregated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.scalar import all_rows, dbl, growth_pct, mean, money, pct, ratio, rnd
from shopstar.operators.common import (
    FIRST_OF, how_many, identified, invoice_count, line_count, rated_count, rating_total,
    sale_year, summarise, with_calendar)



def daily_revenue(fact: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    """Aggregate per day first, so that only days meet the calendar."""
    days = fact.groupBy("date_key").agg(F.sum("total_amount").alias("revenue"))
    return with_calendar(days, dim_date, "full_date", *columns)


def exec_summary(fact: DataFrame, dim_customer: DataFrame | None = None) -> DataFrame:
    """Key figures of all sales; customers who bought are those with a first purchase."""
    c = F.col
    per_branch = fact.groupBy("branch_key").agg(
        line_count(fact).alias("line_items"),
        F.min("sale_date").alias("first_sale"),
        F.max("sale_date").alias("last_sale"),
        F.sum("total_amount").alias("rev"),
        F.sum("gross_profit").alias("profit"),
        F.sum("gross_sales").alias("gross"),
        rating_total(fact).alias("rating_sum"),
        rated_count(fact).alias("rated"),
        *([invoice_count(fact).alias("invoices")] if FIRST_OF[()] in fact.columns else []),
    )
    none = F.lit(0).cast("bigint")
    sums = per_branch.agg(
        *[F.coalesce(F.sum(x), none).alias(x) for x in ("line_items", "invoices") if x in per_branch.columns],
        F.min("first_sale").alias("first_sale"), F.max("last_sale").alias("last_sale"),
        *[F.sum(x).alias(x) for x in ("rev", "profit", "gross")],
        ratio(F.sum("rating_sum"), F.sum("rated")).alias("rating"),
        F.count("branch_key").alias("branches"))
    if "invoices" not in sums.columns:
        sums = sums.withColumn("invoices", how_many(fact, "invoice_id"))
    known = how_many(fact.filter(identified()), "customer_key") if dim_customer is None else (
        dim_customer.filter(identified() & c("first_purchase_date").isNotNull()).agg(F.count("*")).scalar())
    return sums.select(
        "line_items", "invoices",
        known.alias("identified_customers"),
        "branches",
        "first_sale", "last_sale",
        money(c("rev")).alias("total_revenue"),
        money(c("profit")).alias("gross_profit"),
        pct(c("profit"), c("gross"), 2).alias("gross_margin_pct"),
        rnd(ratio(c("rev"), c("invoices")), 2).alias("avg_basket_value"),
        rnd(c("rating"), 2).alias("avg_rating"),
    )


def monthly_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Month on month, same month last year and three-month average.

    The earlier months are found by their distance in months and not by their
    position, so a month without sales gives NULL instead of a wrong partner.
    """
    months = dim_date.select(
        F.col("month_start_date").alias("sale_month"), "year_month").distinct()
    monthly = summarise(
        fact, ["sale_month"], [F.sum("total_amount").alias("revenue")], {"invoices": "invoice_id"},
    ).join(months, "sale_month").withColumnRenamed("sale_month", "month_start").withColumn(
        "month_no", F.year("month_start") * 12 + F.month("month_start"))
    by_month = W.orderBy("month_no")

    def ago(n: int):
        return F.max("revenue").over(by_month.rangeBetween(-n, -n))

    last3 = by_month.rowsBetween(-2, 0)
    now = F.col("revenue")
    return monthly.select(
        "year_month", "month_start",
        money(now).alias("revenue"),
        growth_pct(now, ago(1)).alias("mom_pct"),
        growth_pct(now, ago(12)).alias("yoy_pct"),
        rnd(ratio(F.sum("revenue").over(last3), F.count("revenue").over(last3)), 0)
        .alias("revenue_3mo_ma"),
        "invoices",
        rnd(ratio(now, F.col("invoices")), 2).alias("avg_basket"),
    ).orderBy("month_start").drop("month_start")


def annual_cagr(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    sales = fact.withColumn("sale_year", sale_year())
    per_branch = sales.groupBy("sale_year", "branch_key").agg(
        F.sum("total_amount").alias("revenue"), F.sum("gross_profit").alias("profit"))
    yearly = per_branch.groupBy("sale_year").agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"),
        F.count("branch_key").alias("branches_trading"),
    ).join(sales.groupBy("sale_year").agg(invoice_count(sales, "sale_year").alias("invoices")), "sale_year")
    years = dim_date.select(F.col("year_number").alias("sale_year")).distinct()
    yearly = yearly.join(years, "sale_year").withColumnRenamed("sale_year", "yr")
    by_year = W.orderBy("yr")
    grown = yearly.withColumns({
        "prev": F.lag("revenue").over(by_year),
        "base": F.first("revenue").over(by_year),
        "elapsed": F.col("yr") - F.min("yr").over(all_rows()),
    })
    exponent = F.try_divide(F.lit(1.0), dbl(F.col("elapsed")))
    cagr = F.lit(100.0) * (F.pow(ratio(F.col("revenue"), F.col("base")), exponent) - 1)
    return grown.select(
        "yr",
        money(F.col("revenue")).alias("revenue"),
        money(F.col("profit")).alias("gross_profit"),
        "branches_trading",
        growth_pct(F.col("revenue"), F.col("prev")).alias("yoy_growth_pct"),
        rnd(ratio(F.col("revenue"), F.col("invoices")), 2).alias("avg_basket"),
        rnd(cagr, 1).alias("cagr_to_date_pct"),
    ).orderBy("yr")


def like_for_like(fact: DataFrame, dim_date: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Growth of branches open for the whole prior year against new stores.

    A branch meets its own prior year through a window over its few yearly
    rows, so the sales are read once.
    """
    c = F.col
    branch_year = (
        with_calendar(fact, dim_date, "year_number")
        .groupBy(c("year_number").alias("yr"), "branch_key")
        .agg(F.sum("total_amount").alias("revenue"))
        .join(dim_branch.select("branch_key", "opened_date"), "branch_key")
    )
    year_before = W.partitionBy("branch_key").orderBy("yr").rangeBetween(-1, -1)
    classed = branch_year.withColumns({
        "comparable": F.coalesce(
            c("opened_date") <= F.make_date(c("yr") - 1, F.lit(1), F.lit(1)), F.lit(False)),
        "prior": F.max("revenue").over(year_before),
    })
    totals = classed.groupBy("yr").agg(
        F.sum("revenue").alias("total"),
        F.sum(F.when(c("comparable"), c("revenue"))).alias("lfl"),
        F.sum(F.when(~c("comparable"), c("revenue"))).alias("fresh"),
        F.sum(F.when(c("comparable"), c("prior"))).alias("lfl_prior"),
    )
    fresh = F.coalesce("fresh", F.lit(0))
    before = F.lag("total").over(W.orderBy("yr"))
    return totals.select(
        "yr",
        money(c("total")).alias("total_revenue"),
        money(c("lfl")).alias("lfl_revenue"),
        money(fresh).alias("new_store_revenue"),
        pct(fresh, c("total")).alias("new_store_share_pct"),
        growth_pct(c("lfl"), c("lfl_prior")).alias("lfl_growth_pct"),
        growth_pct(c("total"), before).alias("headline_growth_pct"),
    ).orderBy("yr")


def seasonality_index(fact: DataFrame, dim_date: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Each month against the mean month of its own year; 100 is average."""
    monthly = with_calendar(fact, dim_date, "year_number", "month_number", "month_abbr").groupBy(
        F.col("year_number").alias("yr"), F.col("month_number").alias("mth"), "month_abbr"
    ).agg(F.sum("total_amount").alias("revenue"))
    year = W.partitionBy("yr")
    year_mean = ratio(F.sum("revenue").over(year), F.count("revenue").over(year))
    indexed = monthly.withColumn("index", F.lit(100.0) * dbl(F.col("revenue")) / year_mean)
    average = F.avg("index")
    return indexed.groupBy("mth").agg(
        F.min("month_abbr").alias("month"),
        rnd(average, 1).alias("seasonality_index"),
        rnd(F.min("index"), 1).alias("min_index"),
        rnd(F.max("index"), 1).alias("max_index"),
        F.when(average >= cfg.season_peak, "Peak")
        .when(average >= cfg.season_above, "Above average")
        .when(average >= cfg.season_below, "Below average")
        .otherwise("Trough").alias("trading_period"),
    ).orderBy("mth")


def day_of_week(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    sales = with_calendar(fact, dim_date, "day_of_week", "day_abbr").withColumnRenamed(
        "day_abbr", "day")
    days = summarise(sales, ["day_of_week", "day"], [F.sum("total_amount").alias("rev")],
                     {"invoices": "invoice_id"})
    total, n = F.sum("rev").over(all_rows()), F.count("rev").over(all_rows())
    return days.select(
        "day_of_week", "day",
        money(F.col("rev")).alias("revenue"),
        "invoices",
        rnd(ratio(F.col("rev"), F.col("invoices")), 2).alias("avg_basket"),
        pct(F.col("rev"), total).alias("pct_of_revenue"),
        pct(F.col("rev"), ratio(total, n)).alias("index_vs_avg_day"),
    ).orderBy("day_of_week")


def promo_uplift(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Campaign days against the other days of the same month."""
    daily = daily_revenue(fact, dim_date, "year_month", "is_promo_window")
    promo = F.when(F.col("is_promo_window"), F.col("revenue"))
    normal = F.when(~F.col("is_promo_window"), F.col("revenue"))
    months = daily.groupBy("year_month").agg(
        mean(promo).alias("promo_avg"),
        mean(normal).alias("normal_avg"),
        F.count(promo).alias("promo_days"),
    ).filter(F.col("promo_days") > 0)
    p, n = F.avg("promo_avg"), F.avg("normal_avg")
    return months.agg(
        rnd(p, 0).alias("avg_promo_day_revenue"),
        rnd(n, 0).alias("avg_normal_day_revenue"),
        pct(p - n, n).alias("uplift_pct"),
        F.sum("promo_days").alias("total_promo_days"),
        rnd(F.sum(F.col("promo_days") * (F.col("promo_avg") - F.col("normal_avg"))), 0)
        .alias("incremental_revenue"),
    )


def rolling_28d(fact: DataFrame, dim_date: DataFrame, cfg: RetailConfig) -> DataFrame:
    daily = daily_revenue(fact, dim_date)
    frame = W.orderBy("full_date").rowsBetween(1 - cfg.rolling_days, 0)
    year = W.partitionBy(F.year("full_date")).orderBy("full_date")
    return (
        daily.select(
            "full_date",
            money(F.col("revenue")).alias("revenue"),
            rnd(ratio(F.sum("revenue").over(frame), F.count("revenue").over(frame)), 0)
            .alias("revenue_28d_ma"),
            money(F.sum("revenue").over(year)).alias("ytd_revenue"),
            F.max("full_date").over(all_rows()).alias("_last"),
        )
        .filter(F.col("full_date") > F.date_sub("_last", cfg.tail_days))
        .drop("_last").orderBy("full_date")
    )
