"""Edge cases of single operators on small made-up facts."""

from datetime import date
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from shopstar.config import RetailConfig
from shopstar.operators import branch, customer, dims, growth, product, semantic
from shopstar.sources.store import write_table

CFG = RetailConfig()


@pytest.fixture()
def spool(tmp_path):
    return lambda df, name: write_table(df, str(tmp_path / name))


def make_fact(spark, rows):
    """Rows are dicts; everything not given has a plain value."""
    plain = dict(
        invoice_id="i", line_no=1, sale_date=date(2022, 1, 1), sale_hour=12, branch_key=1,
        product_key=1, customer_key=-1, payment_key=1, quantity=1, total=Decimal("105"),
        profit=Decimal("20"), rating=None)
    data = [{**plain, **r} for r in rows]
    df = spark.createDataFrame(
        [tuple(d[c] for c in plain) for d in data],
        "invoice_id string, line_no int, sale_date date, sale_hour int, branch_key int, "
        "product_key int, customer_key bigint, payment_key int, quantity int, "
        "total_amount decimal(12,4), gross_profit decimal(12,4), rating decimal(3,1)")
    return df.withColumns({
        "gross_sales": (F.col("total_amount") / Decimal("1.05")).cast("decimal(12,2)"),
        "unit_price": F.col("total_amount").cast("decimal(10,2)"),
        "date_key": F.date_format("sale_date", "yyyyMMdd").cast("int"),
        "sale_month": F.trunc("sale_date", "month"),
        "sale_id": F.monotonically_increasing_id(),
    })


def make_calendar(spark, first=date(2020, 1, 1), last=date(2024, 1, 1)):
    bounds = spark.createDataFrame([(first, last)], "first_day date, last_day date")
    return dims.dim_date(bounds, CFG)


def make_products(spark, n=3):
    return spark.createDataFrame(
        [(-1, "UNKNOWN", "Unknown", "Unknown", "Unknown")] + [
            (i, f"S{i}", f"P{i}", f"L{i % 2}", "Mid") for i in range(1, n + 1)],
        "product_key int, sku string, product_name string, product_line string, price_band string")


def test_calendar(spark):
    cal = make_calendar(spark)
    assert cal.agg(F.min("full_date"), F.max("full_date")).first() == (
        date(2019, 1, 1), date(2026, 12, 31))
    day = cal.filter("full_date = date'2024-12-30'").first()
    assert (day.iso_year_week, day.week_of_year, day.day_of_week) == ("2025-W01", 1, 1)
    promo = {str(r.full_date)[5:] for r in cal.filter("is_promo_window and year_number = 2023").collect()}
    assert promo == {
        "11-24", "11-25", "11-26", "11-27", "12-26", "12-27", "12-28", "12-29", "12-30", "12-31",
        "01-02", "01-03", "01-04", "01-05", "01-06", "04-13", "04-14", "04-15", "04-16", "04-17",
        "07-07", "07-08", "07-09"}


def test_month_without_sales_has_no_partner(spark):
    fact = make_fact(spark, [
        {"invoice_id": "a", "sale_date": date(2022, 1, 5)},
        {"invoice_id": "b", "sale_date": date(2022, 3, 5)},
        {"invoice_id": "c", "sale_date": date(2023, 1, 5), "total": Decimal("210")}])
    rows = {r.year_month: r for r in growth.monthly_trend(fact, make_calendar(spark)).collect()}
    assert rows["2022-03"].mom_pct is None
    assert rows["2023-01"].yoy_pct == 100.0 and rows["2023-01"].mom_pct is None


def test_like_for_like_boundary_and_first_year(spark):
    branches = spark.createDataFrame(
        [(1, date(2020, 1, 1)), (2, date(2020, 1, 2))], "branch_key int, opened_date date")
    fact = make_fact(spark, [
        {"invoice_id": f"{y}-{b}", "sale_date": date(y, 3, 1), "branch_key": b,
         "total": Decimal(100 * b * (y - 2019))} for y in (2020, 2021) for b in (1, 2)])
    rows = {r.yr: r for r in growth.like_for_like(fact, make_calendar(spark), branches).collect()}
    assert rows[2020].lfl_revenue is None and rows[2020].new_store_share_pct == 100.0
    assert rows[2021].lfl_revenue == 200.0 and rows[2021].lfl_growth_pct == 100.0
    assert rows[2021].new_store_revenue == 400.0 and rows[2021].headline_growth_pct == 100.0


def brute_pairs(baskets):
    single, pair = {}, {}
    for items in baskets.values():
        for a in items:
            single[a, a] = single.get((a, a), 0) + 1
        for p in combinations(sorted(items), 2):
            pair[p] = pair.get(p, 0) + 1
    return {**single, **pair, (semantic.ALL_BASKETS, semantic.ALL_BASKETS): len(baskets)}


@pytest.mark.parametrize("block", [64, 4, 1])
def test_pair_counts_against_brute_force(spark, spool, block):
    """Repeated products, single-line baskets, an unknown product and a very wide basket."""
    rows = [(f"i{i % 40}", (i * 7) % 11 + 1) for i in range(300)]
    rows += [("wide", k) for k in range(1, 12)] * 3 + [("one", 3), ("lost", -1), ("lost", 2)]
    baskets = {}
    for inv, key in rows:
        baskets.setdefault(inv, set()).add(key)
    fact = make_fact(spark, [{"invoice_id": i, "product_key": k} for i, k in rows])
    got = semantic.pair_counts(fact, make_products(spark, 11), CFG.with_(basket_block=block), spool)
    assert {(r.key_a, r.key_b): r.n for r in got.collect()} == brute_pairs(baskets)


def test_pair_counts_use_every_bit_of_a_block(spark, spool):
    keys = [1, 62, 63, 64, 65, 127, 128, 130]
    fact = make_fact(spark, [{"invoice_id": f"i{i}", "product_key": k} for i in range(2) for k in keys[i:]])
    got = semantic.pair_counts(fact, make_products(spark, 130), CFG, spool)
    assert {(r.key_a, r.key_b): r.n for r in got.collect()} == brute_pairs(
        {i: set(keys[i:]) for i in range(2)})


def test_lift_is_symmetric_and_needs_enough_baskets(spark, spool):
    fact = make_fact(spark, [
        {"invoice_id": f"i{i}", "product_key": k} for i in range(10) for k in ((1, 2) if i < 6 else (3,))])
    products = make_products(spark)
    pairs = semantic.pair_counts(fact, products, CFG, spool)
    row = semantic.basket_affinity(pairs, products, CFG.with_(min_pair_baskets=6)).first()
    assert (row.baskets_together, row.support_pct, row.confidence_pct, row.lift) == (6, 60.0, 100.0, 1.67)
    assert semantic.basket_affinity(pairs, products, CFG.with_(min_pair_baskets=7)).count() == 0


def test_purchase_gaps(spark):
    """Two orders on one day are a gap of zero; one order gives no gap."""
    days = [("a", 1, 1), ("b", 1, 1), ("c", 1, 11), ("d", 1, 31), ("e", 2, 5)]
    fact = make_fact(spark, [
        {"invoice_id": i, "customer_key": c, "sale_date": date(2022, 1, d)} for i, c, d in days])
    row = customer.purchase_gap(fact).first()
    assert (row.repeat_orders, row.avg_gap_days, row.median_gap_days) == (3, 10.0, 10.0)
    assert (row.p75_gap_days, row.p90_gap_days) == (15.0, 18.0)


def test_retention_starts_at_all_and_uses_old_cohorts_only(spark):
    fact = make_fact(spark, [
        {"invoice_id": "a", "customer_key": 1, "sale_date": date(2022, 1, 31)},
        {"invoice_id": "b", "customer_key": 1, "sale_date": date(2022, 3, 1)},
        {"invoice_id": "c", "customer_key": 2, "sale_date": date(2022, 3, 15)}])
    static = spark.createDataFrame(
        [(1, "x", True), (2, "y", True), (3, "z", True)],
        "customer_key bigint, customer_id string, is_member boolean").withColumns({
            c: F.lit(None).cast(t) for c, t in (
                ("gender", "string"), ("signup_date", "date"), ("home_branch_code", "string"),
                ("home_city", "string"))})
    members = dims.customer_enrich(static, fact)
    assert dims.never_activated(members).first()[0] == 1
    counts = semantic.cohort_counts(fact, members)
    curve = {r.month_n: r.retention_pct for r in customer.retention_curve(counts, fact, CFG).collect()}
    assert curve == {0: 100.0, 2: 100.0}


def test_rollup_whole_is_a_hundred(spark):
    branches = spark.createDataFrame(
        [(1, "N", "A"), (2, "N", "B"), (3, "S", "C")], "branch_key int, region string, city string")
    fact = make_fact(spark, [{"invoice_id": f"{b}", "branch_key": b} for b in (1, 2, 3, 3)])
    rows = {(r.region, r.city): r.pct_of_revenue for r in branch.region_rollup(fact, branches).collect()}
    assert rows[None, None] == 100.0 and rows["N", None] == 50.0 and rows["S", "C"] == 50.0
    assert len(rows) == 6


def test_branch_without_ratings_and_zero_sales(spark):
    branches = spark.createDataFrame([(1, "A", "X")], "branch_key int, branch_code string, city string")
    fact = make_fact(spark, [{"total": Decimal(0), "profit": Decimal(0)}])
    row = branch.rating_distribution(fact, branches).first()
    assert row.rated_transactions == 0 and row.avg_rating is None and row.pct_promoters is None
    assert growth.exec_summary(fact).first().gross_margin_pct is None
    assert product.line_performance(fact, make_products(spark)).first().margin_pct is None


def test_empty_fact(spark, spool):
    fact = make_fact(spark, [{}]).limit(0)
    cal, products = make_calendar(spark), make_products(spark)
    assert growth.exec_summary(fact).first().line_items == 0
    assert growth.monthly_trend(fact, cal).count() == 0
    assert customer.purchase_gap(fact).first().repeat_orders == 0
    assert semantic.pair_counts(fact, products, CFG, spool).first().n == 0


def test_unique_natural_keys(spark):
    dims.assert_unique(make_products(spark), "sku")
    with pytest.raises(dims.DuplicateKeyError):
        dims.assert_unique(make_products(spark).union(make_products(spark)), "sku")
