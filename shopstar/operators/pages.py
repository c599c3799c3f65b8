"""The datasets behind the four report pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from shopstar.functions.scalar import dbl, pct
from shopstar.operators import customer, semantic
from shopstar.operators.aggregates import stored_sales
from shopstar.operators.measures import (
    customer_value, dense_place, done, measures, new_customers, revenue_share, standing,
    time_measures)

KPIS = ("total_revenue", "gross_profit", "gross_margin_pct", "invoices", "line_items",
        "units_sold", "avg_basket_value", "avg_rating", "active_customers")


def exec_kpis(wh) -> DataFrame:
    return done(measures(wh, [*KPIS, "revenue_ly", "revenue_yoy_pct"]))


def exec_kpis_sliced(wh) -> DataFrame:
    """The cards under a year, a region and a product line slicer."""
    cfg = wh.cfg
    filters = {"year_number": cfg.slicer_year, "region": cfg.slicer_region,
               "product_line": list(cfg.slicer_lines)}
    cards = measures(
        wh, [*KPIS, "revenue_ly", "revenue_yoy_pct", "profit_yoy_pct"], filters=filters)
    return done(cards.withColumn("revenue_share_pct", revenue_share(wh)))


def exec_trend(wh) -> DataFrame:
    return time_measures(wh).select("year_month", "total_revenue", "revenue_3m_avg")


def exec_seasonality(wh) -> DataFrame:
    by = ["month_number", "year_number"]
    return done(measures(wh, ["total_revenue"], by), *by)


def exec_bridge(wh) -> DataFrame:
    """Each year's revenue and its step from the year before."""
    years = measures(wh, ["total_revenue", "revenue_yoy_pct"], ["year_number"])
    step = F.col("_rev") - F.lag("_rev").over(W.orderBy("year_number"))
    return done(years.withColumn("step", dbl(step)), "year_number")


def exec_region_matrix(wh) -> DataFrame:
    by = ["region", "city"]
    return done(measures(
        wh, ["total_revenue", "revenue_yoy_pct", "gross_margin_pct", "avg_rating"], by,
        {"year_number": wh.cfg.slicer_year}), *by)


def product_scatter(wh) -> DataFrame:
    by = ["product_name", "product_line"]
    return done(measures(wh, ["total_revenue", "gross_margin_pct", "units_sold"], by), *by)


def product_pareto(wh) -> DataFrame:
    names = standing(wh, measures(wh, ["total_revenue"], ["product_name"]), wh.dim_product)
    return done(names.select(
        "product_name", "total_revenue",
        F.col("place").alias("product_rank"),
        dbl(F.col("running")).alias("revenue_running_total"),
        pct(F.col("running"), F.col("total"), 2).alias("pareto_cumulative_pct"),
    ), F.desc("total_revenue"), "product_name")


def product_mix(wh) -> DataFrame:
    by = ["year_number", "product_line"]
    share = pct(F.col("_rev"), F.sum("_rev").over(W.partitionBy("year_number")), 2)
    return done(measures(wh, ["total_revenue"], by).withColumn("revenue_share_pct", share), *by)


def product_affinity(wh) -> DataFrame:
    return semantic.basket_affinity(wh.pair_counts, wh.dim_product, wh.cfg).select(
        "product_a", "product_b", "lift", "confidence_pct", "pair_type",
    ).orderBy(F.desc("lift"), "product_a", "product_b")


def product_matrix(wh) -> DataFrame:
    lines = measures(
        wh, ["total_revenue", "gross_profit", "gross_margin_pct", "avg_rating"], ["product_line"])
    return done(lines.withColumn("product_rank", dense_place()), "product_rank")


def customer_cards(wh) -> DataFrame:
    cards = done(measures(wh, [
        "active_customers", "champions_revenue", "champions_pct", "revenue_at_risk"]))
    value = customer_value(wh)
    packed = value.select(F.struct(*value.columns)).scalar()
    return cards.withColumn("_value", packed).select("*", "_value.*").drop("_value")


def customer_rfm_grid(wh) -> DataFrame:
    """Scored customers who bought, by recency and frequency score."""
    by = ["r_score", "f_score"]
    return done(measures(wh, ["active_customers"], by).filter(F.col("r_score").isNotNull()), *by)


def customer_segments(wh) -> DataFrame:
    segments = measures(wh, ["total_revenue"], ["rfm_segment"])
    return done(
        segments.withColumn("revenue_share_pct", revenue_share(wh))
        .filter(F.col("rfm_segment").isNotNull()),
        F.desc("total_revenue"), "rfm_segment")


def customer_cohorts(wh) -> DataFrame:
    return semantic.cohort_retention_long(wh.cohort_counts, wh.cfg).select(
        "cohort_label", "month_index", "retention_pct").orderBy("cohort_label", "month_index")


def customer_activity(wh) -> DataFrame:
    states = measures(wh, ["total_revenue"], ["activity_status"])
    return done(states.filter(F.col("activity_status").isNotNull()),
                F.desc("total_revenue"), "activity_status")


def customer_acquisition(wh) -> DataFrame:
    returning = customer.new_vs_returning(stored_sales(wh), wh.dim_customer, wh.cfg).select(
        F.col("yr").alias("year_number"), "returning_revenue")
    return new_customers(wh).join(returning, "year_number", "full").orderBy("year_number")


def branch_scorecard(wh) -> DataFrame:
    branches = measures(
        wh, ["total_revenue", "revenue_per_trading_day", "gross_margin_pct", "avg_rating",
             "detractor_pct"], ["branch_code"])
    return done(branches.withColumn("branch_rank", dense_place()), "branch_rank", "branch_code")


def branch_hour_weekday(wh) -> DataFrame:
    """Totals per slot; the operator of the same shape divides by occurrences."""
    by = ["sale_hour", "day_of_week", "day_name"]
    return done(measures(wh, ["total_revenue"], by), "sale_hour", "day_of_week")


def branch_hours(wh) -> DataFrame:
    return done(measures(wh, ["total_revenue", "avg_rating"], ["sale_hour"]), "sale_hour")


def branch_cards(wh) -> DataFrame:
    return done(measures(wh, [
        "peak_hour_revenue", "peak_hour_revenue_pct", "peak_hour_rating", "off_peak_rating",
        "rating_gap", "detractor_pct"]))


def branch_payment_mix(wh) -> DataFrame:
    by = ["year_number", "payment_method"]
    share = pct(F.col("_rev"), F.sum("_rev").over(W.partitionBy("year_number")), 2)
    return done(measures(wh, ["total_revenue"], by).withColumn("revenue_share_pct", share), *by)


def branch_drillthrough(wh) -> DataFrame:
    """One branch by year, as reached by drilling through from any visual."""
    return done(measures(
        wh, ["total_revenue", "gross_profit", "gross_margin_pct", "invoices", "avg_rating",
             "revenue_yoy_pct"], ["year_number"], {"branch_code": wh.cfg.slicer_branch}),
        "year_number")


def measure_time_by_region(wh) -> DataFrame:
    """The trend page by region under a product line slicer."""
    by = ["region", "year_month"]
    names = ["total_revenue", "revenue_ytd", "revenue_ly_ytd", "revenue_mom_pct", "revenue_3m_avg",
             "revenue_rolling_12m"]
    return done(measures(wh, names, by, {"product_line": list(wh.cfg.slicer_lines)}), *by)


def measure_year_to_date_cards(wh) -> DataFrame:
    """The period cards under a year and a region slicer."""
    return done(measures(
        wh, ["total_revenue", "revenue_ytd", "revenue_ly_ytd", "revenue_rolling_12m"],
        filters={"year_number": wh.cfg.slicer_year, "region": wh.cfg.slicer_region}))


def measure_quarters(wh) -> DataFrame:
    """Weekends and weekdays of each quarter, by branch size."""
    by = ["quarter_number", "is_weekend", "size_band"]
    return done(measures(wh, ["total_revenue", "line_items"], by), *by)


def measure_segment_profit(wh) -> DataFrame:
    """Profit, invoices and rating by segment, with growth under a year slicer."""
    by = ["rfm_segment"]
    return done(measures(
        wh, ["total_revenue", "gross_profit", "invoices", "avg_rating", "revenue_yoy_pct"], by,
        {"year_number": wh.cfg.slicer_year}), *by)


def measure_hours_of_champions(wh) -> DataFrame:
    """Sales by hour under a segment slicer, and the share that segment has of each hour."""
    by = ["sale_hour"]
    return done(measures(
        wh, ["total_revenue", "champions_revenue", "champions_pct", "revenue_at_risk"], by,
        {"rfm_segment": "Champions"}), *by)


def measure_customers_by_segment(wh) -> DataFrame:
    """Customer figures by segment and activity."""
    by = ["rfm_segment", "activity_status"]
    return done(measures(
        wh, ["active_customers", "customer_lifetime_value", "repeat_customer_pct",
             "avg_days_since_purchase", "new_customers"], by), *by)


PAGES = {
    "measure_time_by_region": measure_time_by_region,
    "measure_year_to_date_cards": measure_year_to_date_cards,
    "measure_quarters": measure_quarters,
    "measure_segment_profit": measure_segment_profit,
    "measure_hours_of_champions": measure_hours_of_champions,
    "measure_customers_by_segment": measure_customers_by_segment,
    "page_exec_kpis": exec_kpis,
    "page_exec_kpis_sliced": exec_kpis_sliced,
    "page_exec_trend": exec_trend,
    "page_exec_time_measures": time_measures,
    "page_exec_seasonality": exec_seasonality,
    "page_exec_bridge": exec_bridge,
    "page_exec_region_matrix": exec_region_matrix,
    "page_product_scatter": product_scatter,
    "page_product_pareto": product_pareto,
    "page_product_mix": product_mix,
    "page_product_affinity": product_affinity,
    "page_product_matrix": product_matrix,
    "page_customer_cards": customer_cards,
    "page_customer_rfm_grid": customer_rfm_grid,
    "page_customer_segments": customer_segments,
    "page_customer_cohorts": customer_cohorts,
    "page_customer_activity": customer_activity,
    "page_customer_acquisition": customer_acquisition,
    "page_branch_scorecard": branch_scorecard,
    "page_branch_hour_weekday": branch_hour_weekday,
    "page_branch_hours": branch_hours,
    "page_branch_cards": branch_cards,
    "page_branch_payment_mix": branch_payment_mix,
    "page_branch_drillthrough": branch_drillthrough,
}
