"""All registered queries, by the name of the operator they run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopstar.operators import (
    branch, customer, dims, growth, layout, pages, product, profiles, quality, semantic,
    signals)
from shopstar.operators.aggregates import sales, stored_sales
from shopstar.plans.warehouse import Warehouse, sample_warehouse

Query = Callable[[SparkSession, str], DataFrame]
Operator = Callable[[Warehouse], DataFrame]


def _steps() -> dict[str, Operator]:
    """Single build steps, in build order."""
    p = profiles
    return {
        "read_landing_csv": lambda w: w.landed_from_csv(),
        "try_to_date": lambda w: p.try_to_date(w.sales_landing),
        "try_to_numeric": lambda w: p.try_to_numeric(w.sales_landing),
        "dedupe_lines": lambda w: p.dedupe_lines(w.normalised),
        "trim_to_null": lambda w: p.trim_to_null(w.sales_landing),
        "conform_codes": lambda w: p.conform_codes(w.sales_landing),
        "conform_city_gender": lambda w: p.conform_city_gender(w.sales_landing),
        "derive_customer_type": lambda w: p.derive_customer_type(w.sales_landing),
        "flag_type_repaired": lambda w: p.flag_type_repaired(w.sales_landing),
        "parse_iso_date": lambda w: p.parse_iso_date(w.sales_landing),
        "parse_time": lambda w: p.parse_time(w.sales_landing),
        "normalise_payment": lambda w: p.normalise_payment(w.sales_landing),
        "parse_numerics": lambda w: p.parse_numerics(w.sales_landing),
        "classify_reject": lambda w: p.classify_reject(w.normalised),
        "quarantine": lambda w: w.stg_sales_rejects.drop("rejected_at"),
        "clean_sales": lambda w: p.clean_sales(w.stg_sales),
        "single_pass_split": lambda w: p.single_pass_split(w.normalised),
        "reject_counts": lambda w: quality.reject_counts(w.stg_sales_rejects),
        "dim_date": lambda w: p.calendar(w.dim_date),
        "is_promo_window": lambda w: p.promo_days(w.fact_sales, w.dim_date),
        "dim_branch": lambda w: p.branches(w.dim_branch),
        "dim_product": lambda w: p.products(w.dim_product),
        "dim_payment": lambda w: w.dim_payment,
        "dim_customer": lambda w: p.customers(w.dim_customer_static),
        "dense_key": lambda w: w.dim_customer_static.select("customer_key", "customer_id"),
        "global_rank": lambda w: p.global_rank(w.fact_sales),
        "resolve_keys": lambda w: p.resolve_keys(w.fact_sales),
        "fact_sales": lambda w: p.fact_rows(w.fact_sales),
        "promo_windows": lambda w: p.promo_windows(w.fact_sales, w.cfg),
        "generated_series": lambda w: p.generated_series(w.fact_sales, w.stg_sales, w.cfg),
        "assert_no_default_partition": lambda w: p.outside_window(w.fact_sales, w.cfg),
        "customer_enrich": lambda w: p.customers(w.dim_customer),
        "never_activated": lambda w: dims.never_activated(w.dim_customer),
        "rfm_base": lambda w: p.rfm_rows(w.rfm_base),
        "rfm_score": lambda w: w.customer_rfm.select(
            "customer_key", "r_score", "f_score", "m_score"),
        "rfm_segment": lambda w: p.rfm_rows(w.customer_rfm.drop("monetary_rank")),
        "dim_customer_rfm": lambda w: p.rfm_rows(w.dim_customer_rfm),
        "cohort_retention_long": lambda w: semantic.cohort_retention_long(w.cohort_counts, w.cfg),
        "basket_affinity": lambda w: semantic.basket_affinity(w.pair_counts, w.dim_product, w.cfg),
        "kpi_monthly": lambda w: semantic.kpi_monthly(w.fact_invoices, w.dim_date, w.dim_branch),
        "append_audit": lambda w: quality.append_audit(w).drop("loaded_at"),
        "load_audit_report": lambda w: quality.load_audit_report(w.load_audit).drop("loaded_at"),
    }


def _analysis() -> dict[str, Operator]:
    return {
        "growth_exec_summary": lambda w: growth.exec_summary(w.fact_invoices, w.dim_customer),
        "growth_monthly_trend": lambda w: growth.monthly_trend(w.fact_invoices, w.dim_date),
        "growth_annual_cagr": lambda w: growth.annual_cagr(stored_sales(w), w.dim_date),
        "growth_like_for_like": lambda w: growth.like_for_like(
            sales(w, "branch_key"), w.dim_date, w.dim_branch),
        "growth_seasonality_index": lambda w: growth.seasonality_index(
            sales(w), w.dim_date, w.cfg),
        "growth_day_of_week": lambda w: growth.day_of_week(w.fact_invoices, w.dim_date),
        "growth_promo_uplift": lambda w: growth.promo_uplift(sales(w), w.dim_date),
        "growth_rolling_28d": lambda w: growth.rolling_28d(sales(w), w.dim_date, w.cfg),
        "customer_base_overview": lambda w: customer.base_overview(w.fact_invoices, w.dim_customer),
        "customer_rfm_summary": lambda w: customer.rfm_summary(w.customer_rfm),
        "customer_value_deciles": lambda w: customer.value_deciles(w.customer_rfm),
        "customer_cohort_matrix": lambda w: customer.cohort_matrix(w.cohort_counts, w.cfg),
        "customer_retention_curve": lambda w: customer.retention_curve(
            w.cohort_counts, sales(w), w.cfg),
        "customer_clv_by_segment": lambda w: customer.clv_by_segment(w.customer_rfm),
        "customer_revenue_at_risk": lambda w: customer.revenue_at_risk(w.customer_rfm),
        "customer_new_vs_returning": lambda w: customer.new_vs_returning(
            stored_sales(w), w.dim_customer, w.cfg),
        "customer_purchase_gap": lambda w: customer.purchase_gap(w.fact_invoices),
        "product_line_performance": lambda w: product.line_performance(
            sales(w, "product_key"), w.dim_product),
        "product_abc_skus": lambda w: product.abc_skus(w.sku_shares),
        "product_abc_summary": lambda w: product.abc_summary(w.sku_shares),
        "product_mix_shift": lambda w: product.mix_shift(
            sales(w, "product_key"), w.dim_date, w.dim_product, w.cfg),
        "product_top_affinities": lambda w: product.top_affinities(
            w.pair_counts, w.dim_product, w.cfg),
        "product_cross_category": lambda w: product.cross_category(w.line_pair_counts, w.cfg),
        "product_basket_size": lambda w: product.basket_size(w.fact_invoices),
        "product_price_bands": lambda w: product.price_bands(w.fact_sales, w.dim_product),
        "product_by_segment": lambda w: product.lines_by_segment(
            w.fact_sales, w.customer_rfm, w.dim_product, w.cfg),
        "branch_scorecard": lambda w: branch.scorecard(w.fact_invoices, w.dim_branch, w.cfg),
        "branch_region_rollup": lambda w: branch.region_rollup(sales(w, "branch_key"), w.dim_branch),
        "branch_hour_weekday_heatmap": lambda w: branch.hour_weekday_heatmap(
            sales(w, "sale_hour"), w.dim_date),
        "branch_hourly_service": lambda w: branch.hourly_service(w.fact_invoices),
        "branch_peak_service_gap": lambda w: branch.peak_service_gap(w.fact_invoices, w.cfg),
        "branch_payment_adoption": lambda w: branch.payment_adoption(
            sales(w, "payment_key"), w.dim_date, w.dim_payment, w.cfg),
        "branch_rank_movement": lambda w: branch.rank_movement(
            sales(w, "branch_key"), w.dim_date, w.dim_branch, w.cfg),
        "branch_rating_distribution": lambda w: branch.rating_distribution(
            w.fact_sales, w.dim_branch),
    }


def _quality() -> dict[str, Operator]:
    checks = {
        c.key: (lambda w, c=c: quality.evaluate(w, (c,))) for c in quality.CHECKS}
    return checks | {
        "dq_report": lambda w: quality.dq_report(w.dq_results),
        "dq_category_summary": lambda w: quality.dq_category_summary(w.dq_results),
        "dq_reject_breakdown": lambda w: quality.dq_reject_breakdown(
            w.stg_sales_rejects, w.sales_landing),
    }


def _signals() -> dict[str, Operator]:
    return {
        "defect_profile": lambda w: signals.defect_profile(w.normalised, w.cfg),
        **{name: (lambda w, build=build: build(w)) for name, build in signals.SIGNALS.items()},
        "headline_figures": lambda w: signals.headline_figures(
            stored_sales(w), w.dim_branch, w.rfm_base),
        "signal_report": signals.signal_report,
    }


def _layout() -> dict[str, Operator]:
    return {
        **{name: (lambda w, run=run: run(w, w.fact_sales))
           for name, run in layout.QUERIES.items()},
        "layout_parity": lambda w: layout.layout_parity(w.fact_sales, w.fact_sales_flat),
        "partition_profile": lambda w: layout.partition_profile(
            w.fact_sales, w.fact_sales_flat, w.cfg),
    }


def operators() -> dict[str, Operator]:
    return {**_steps(), **_analysis(), **_quality(), **_signals(), **_layout(), **pages.PAGES}


def queries() -> dict[str, Query]:
    def bind(run: Operator) -> Query:
        return lambda spark, sf_dir: run(sample_warehouse(spark, sf_dir))

    return {name: bind(run) for name, run in operators().items()}
