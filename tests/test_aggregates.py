"""The invoice table, the daily cube, baskets of frequent products and the rules that use them."""

import random
import re
from datetime import date, timedelta
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from compare import TESTDATA
from shopstar.config import RetailConfig
from shopstar.operators import aggregates, baskets, branch, common, customer, growth, layout, measures, quality, signals
from shopstar.plans import registry
from shopstar.plans.warehouse import sample_warehouse
from test_operators import make_calendar, make_fact, make_products, spool  # noqa: F401

CFG = RetailConfig()


@pytest.fixture(scope="module")
def wh(spark):
    return sample_warehouse(spark, f"{TESTDATA}/sf0.01")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def random_lines(n=400, seed=3):
    """Invoices whose lines differ in date, branch, hour and customer, and one invoice with many lines."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append({
            "invoice_id": "hot" if i % 3 == 0 else f"i{rng.randrange(60)}",
            "sale_date": date(2021, 11, 1) + timedelta(rng.randrange(120)), "branch_key": rng.randrange(4),
            "sale_hour": rng.choice([10, 11, 19]), "customer_key": rng.choice([-1, 1, 2, 3]),
            "product_key": rng.randrange(1, 4), "payment_key": rng.randrange(3), "quantity": rng.randrange(1, 5),
            "total": Decimal(rng.randrange(100, 9999)), "profit": Decimal(rng.randrange(50)),
            "rating": rng.choice([None, Decimal("4.5"), Decimal("9.0")])})
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_marks_count_distinct_invoices(spark, hot, tmp_path):
    """For every grouping that has marks; alike whether lines are summed before they are dealt or not."""
    fact = make_fact(spark, random_lines())
    cfg = CFG.with_(skew_min_rows=1) if hot else CFG
    path = str(tmp_path / "invoices")
    aggregates.fact_invoices(fact, cfg).write.parquet(path)
    table = spark.read.parquet(path)
    assert table.groupBy(*aggregates.INVOICE_GRAIN).count().filter("count > 1").count() == 0
    derived = {"sale_year": F.year("sale_date"), "identified": common.identified()}
    for by, mark in common.FIRST_OF.items():
        keys = [derived.get(c, F.col(c)).alias(f"by_{c}") for c in by]
        want = fact.groupBy(*keys).agg(F.countDistinct("invoice_id").alias("n"))
        got = table.groupBy(*keys).agg(common.invoice_count(table, *by).alias("n"))
        assert "first_of" in mark and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    sums = lambda df: df.agg(*common.line_sums(df)).first()
    assert tuple(sums(table)) == tuple(sums(fact))


def test_cube_levels_add_up(spark):
    fact = make_fact(spark, random_lines())
    invoices = aggregates.fact_invoices(fact, CFG)
    cube = aggregates.daily_cube(fact, invoices).cache()
    for level in aggregates.LEVELS:
        want = fact.groupBy("sale_date", F.col(level).alias("key")).agg(*common.line_sums(fact))
        got = cube.filter(F.col("level") == level).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_operators_agree_on_lines_and_aggregates(spark):
    """The same rows from the lines, the invoice table and the cube."""
    lines = make_fact(spark, random_lines()).cache()
    invoices = aggregates.fact_invoices(lines, CFG).cache()
    cube = aggregates.daily_cube(lines, invoices).cache()
    level = lambda name: cube.filter(F.col("level") == name).withColumnRenamed("key", name)
    cal, products = make_calendar(spark), make_products(spark)
    branches = spark.createDataFrame(
        [(i, f"B{i}", f"C{i % 2}", "R", date(2020, 1, 1), "Small") for i in range(4)],
        "branch_key int, branch_code string, city string, region string, opened_date date, size_band string")
    known = spark.createDataFrame(
        [(k, date(2021, 11, 1) if k > 0 else None, k > 0) for k in (-1, 1, 2, 3)],
        "customer_key bigint, first_purchase_date date, is_member boolean")
    pairs = [
        (lambda f: growth.exec_summary(f, known), invoices), (lambda f: growth.exec_summary(f), invoices),
        (lambda f: growth.monthly_trend(f, cal), invoices), (lambda f: growth.annual_cagr(f, cal), invoices),
        (lambda f: growth.day_of_week(f, cal), invoices),
        (lambda f: growth.seasonality_index(f, cal, CFG), level("branch_key")),
        (lambda f: growth.rolling_28d(f, cal, CFG), level("payment_key")),
        (lambda f: customer.base_overview(f, known), invoices),
        (lambda f: customer.new_vs_returning(f, known, CFG), invoices),
        (lambda f: branch.scorecard(f, branches, CFG), invoices),
        (lambda f: branch.hourly_service(f), invoices), (lambda f: branch.peak_service_gap(f, CFG), invoices),
        (lambda f: branch.region_rollup(f, branches), level("branch_key")),
        (lambda f: branch.hour_weekday_heatmap(f, cal), level("sale_hour")),
        (lambda f: signals.margin_spread(f, products), level("product_key")),
        (lambda f: signals.peak_rating_penalty(f, CFG), level("sale_hour")),
    ]
    for run, other in pairs:
        assert list(map(tuple, run(other).collect())) == list(map(tuple, run(lines).collect()))


def test_rule_picks_the_smallest_table(wh):
    assert "level" not in aggregates.sales(wh, "branch_key").columns
    assert "key" not in aggregates.sales(wh).columns and "invoice_id" not in aggregates.sales(wh, "sale_hour").columns
    assert aggregates.sales(wh, "invoice_id").columns == wh.fact_invoices.columns
    assert aggregates.sales(wh, "branch_key", "sale_hour").columns == wh.fact_invoices.columns
    assert aggregates.sales(wh, "unit_price") is wh.fact_sales


@pytest.mark.parametrize("name", [
    "growth_exec_summary", "customer_base_overview", "page_exec_kpis", "kpi_monthly", "headline_figures",
    "branch_scorecard", "growth_monthly_trend"])
def test_no_rows_are_repeated_for_distinct_counts(wh, name):
    text = plan(registry.operators()[name](wh))
    assert "Expand" not in text


@pytest.mark.parametrize("name", [
    "signal_report", "growth_rolling_28d", "product_mix_shift", "branch_payment_adoption", "branch_rank_movement"])
def test_sales_lines_are_not_read(wh, name):
    files = registry.operators()[name](wh).inputFiles()
    assert not [f for f in files if "/fact_sales" in f] and [f for f in files if "/daily_cube/" in f]


@pytest.mark.parametrize("name", ["product_mix_shift", "branch_payment_adoption", "branch_rank_movement"])
def test_three_years_are_named_in_the_partition_filter(wh, name):
    text = plan(registry.operators()[name](wh))
    assert re.search(r"PartitionFilters: \[[^\]]*sale_year#\d+ IN \(", text)


def test_an_item_sold_in_other_years_only_is_shown(spark):
    rows = [{"invoice_id": f"{y}", "sale_date": date(y, 3, 1), "payment_key": k} for y, k in ((2019, 1), (2021, 1), (2020, 2))]
    methods = spark.createDataFrame([(1, "Cash"), (2, "Cheque"), (3, "Never")], "payment_key int, payment_method string")
    cfg = CFG.with_(share_years=(2019, 2021, 2023))
    got = {r.payment_method: r.y2019 for r in branch.payment_adoption(
        make_fact(spark, rows), make_calendar(spark, date(2019, 1, 1)), methods, cfg).collect()}
    assert got == {"Cash": 100.0, "Cheque": None}


def brute(groups, least, lines):
    single, pair, of_lines = {}, {}, {}
    for items in groups.values():
        for a in items:
            single[a] = single.get(a, 0) + 1
        for a, b in combinations(sorted(items), 2):
            pair[a, b] = pair.get((a, b), 0) + 1
            if lines[a] != lines[b]:
                key = tuple(sorted((lines[a], lines[b])))
                of_lines[key] = of_lines.get(key, 0) + 1
    return single, {p: n for p, n in pair.items() if n >= least}, of_lines


@pytest.mark.parametrize("block, side", [(64, 64), (4, 64), (1, 2), (3, 1)])
@pytest.mark.parametrize("least", [1, 4])
def test_frequent_pairs_against_brute_force(spark, spool, block, side, least):  # noqa: F811
    """Also a basket with most of the catalogue, whose blocks are dealt into several sides."""
    rng = random.Random(7)
    rows = [(f"i{rng.randrange(30)}", int(rng.triangular(1, 40, 3))) for _ in range(250)]
    rows += [("huge", k) for k in range(1, 41)] + [("huge", -1), ("one", 2), ("lost", -1)]
    groups = {}
    for inv, key in rows:
        groups.setdefault(inv, set()).add(key)
    fact = make_fact(spark, [{"invoice_id": i, "product_key": k} for i, k in rows])
    products = make_products(spark, 40)
    cfg = CFG.with_(basket_block=block, basket_side=side)
    masks = spool(baskets.basket_masks(fact, cfg), "masks")
    lines = {r.product_key: r.product_line for r in products.collect()}
    single, pair, of_lines = brute(groups, least, lines)
    got = {(r.key_a, r.key_b): r.n for r in baskets.pair_counts(fact, products, cfg, spool, least, masks).collect()}
    all_key = (baskets.ALL_BASKETS, baskets.ALL_BASKETS)
    assert got == {**{(a, a): n for a, n in single.items()}, **pair, all_key: len(groups)}
    found = baskets.line_pair_counts(masks, products, cfg, spool).collect()
    assert {(r.line_a, r.line_b): r.n for r in found} == of_lines


def test_rare_products_form_no_pair(wh):
    """Products below the minimum support are cut out of the masks."""
    least = wh.cfg.min_pair_baskets
    kept = wh.pair_counts.filter("key_a < key_b").agg(F.min("n"), F.count("*")).first()
    assert kept[0] is None or kept[0] >= least
    assert wh.pair_counts.filter("key_a = key_b and key_a > 0").count() == 25


def test_orphans_without_a_join_of_lines(spark, wh):
    """Rows with one or more lost keys count once; of a sound load no line gets as far as a join."""

    class Loaded:
        cfg = wh.cfg
        fact_sales = wh.fact_sales
        dim_date, dim_product, dim_payment = wh.dim_date, wh.dim_product, wh.dim_payment
        dim_branch = wh.dim_branch.filter("branch_key <> 3")
        dim_customer = wh.dim_customer.filter("customer_key % 50 <> 1")

    want = wh.fact_sales.filter("branch_key = 3 or customer_key % 50 = 1").count()
    assert want > 0 and quality.orphans(Loaded).count() == want
    sound = quality.orphans(wh)
    assert sound.collect() == []
    # All lines are held back by a filter on the number of lost keys.
    text = sound._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Filter \(scalar-subquery#\d+ \[\] > 0\)", text)


def test_unknown_payments_are_named_up_to_a_bound(spark, wh):
    check = next(c for c in quality.CHECKS if c.key == "dq_payment_vocabulary")
    names = [f"Odd {i:02d}" for i in range(30)]

    class Loaded:
        dim_payment = spark.createDataFrame(
            [(-1, "Unknown"), (1, "Cash")] + [(10 + i, n) for i, n in enumerate(names)],
            "payment_key int, payment_method string")
        daily_cube = spark.createDataFrame(
            [("payment_key", 10 + i, i) for i in range(30)], "level string, key int, lines int").withColumns({
                c: F.lit(1) for c in (*aggregates.DAY, "sale_year", *common.LINE_SUMS) if c != "lines"})

    row = quality.evaluate(Loaded, (check,)).first()
    assert row.status == "FAIL"
    assert row.actual_value == ", ".join(names[10:]) + " and 10 more"
    Loaded.dim_payment = Loaded.dim_payment.limit(4).filter("payment_key <> 11")
    assert quality.evaluate(Loaded, (check,)).first().actual_value == "Odd 00"


def test_lookups_open_few_files(wh):
    """The index gives the months, so a lookup of one invoice opens its month only."""
    text = plan(layout.invoice_lookup(wh.fact_sales, wh.cfg.bench, wh.invoice_index))
    assert re.search(r"PartitionFilters: \[[^\]]*sale_month#\d+ >= .*[Ss]ubquery", text)
    text = plan(layout.customer_history(wh.fact_sales, wh.cfg.bench, wh.customer_index))
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", text)
    whole = wh.fact_sales.filter(
        F.col("invoice_id") == wh.fact_sales.filter(F.col("sale_date") == F.lit(wh.cfg.bench.invoice_date)).agg(
            F.min("invoice_id")).first()[0]).count()
    assert layout.invoice_lookup(wh.fact_sales, wh.cfg.bench, wh.invoice_index).count() == whole
    own = wh.fact_sales.filter(F.col("customer_key") == wh.cfg.bench.customer_key)
    assert layout.customer_history(wh.fact_sales, wh.cfg.bench, wh.customer_index).count() == own.select(
        "invoice_id", "sale_date").distinct().count()


def test_marked_contexts():
    assert measures.marked_by(set()) == ()
    assert measures.marked_by({"year_number"}) == ("sale_year",)
    assert measures.marked_by({"branch_code", "year_month"}) == ("sale_month", "branch_key")
    assert measures.marked_by({"region"}) is None and measures.marked_by({"sale_hour", "branch_code"}) is None
