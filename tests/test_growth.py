"""What a larger input may not change: compiled code, rows per task, work done once."""

import pytest
from pyspark.sql import functions as F

from compare import TESTDATA
from shopstar import schemas
from shopstar.config import RetailConfig, sample_config
from shopstar.functions import ranking, scalar, skew
from shopstar.operators import aggregates, clean, dims, rfm, semantic
from shopstar.plans import registry
from shopstar.plans.warehouse import Warehouse, sample_warehouse
from shopstar.sources.landing import Landing
from shopstar.sources.store import write_table

# HotSpot compiles no larger method; such a one is interpreted row by row.
COMPILED = 8000


def lines(spark, n=1200):
    """Lines of `n` rows in 1..3 copies each, some with defects."""
    i = F.col("id")
    text = {
        "invoice_id": (i % (n // 4)).cast("string"), "line_no": (i % 3 + 1).cast("string"),
        "branch": F.lit("a"), "city": F.lit(" YANGON "), "customer_id": F.concat(F.lit("C"), (i % 7).cast("string")),
        "gender": F.lit("male"), "product_sku": F.lit("s1"), "product_line": F.lit("Line"),
        "product_name": F.lit("One"), "unit_price": F.when(i % 5 == 0, "$1,000.00").otherwise("10.25"),
        "quantity": F.when(i % 11 == 0, "-2").otherwise("2"), "tax_pct": F.lit("0.05"),
        "date": F.when(i % 13 == 0, "1900-01-01").otherwise(F.concat(F.lit("1996-0"), (i % 9 + 1).cast("string"), F.lit("-05"))),
        "time": F.lit("10:05:00"), "payment": F.lit("E-Wallet"), "gross_margin_pct": F.lit("20"),
        "rating": F.when(i % 3 == 0, "9.1").when(i % 17 == 0, "900000"),
    }
    return spark.range(0, n, 1, 4).select(
        *[text.get(c, F.lit(None).cast("string")).alias(c) for c in schemas.SALES_LANDING.names],
        i.alias("l_partkey"), F.lit(1).alias("l_suppkey"))


def generated(spark, df):
    """Sizes of the largest methods generated for a query, in bytes."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = df.select("*")._jdf.queryExecution().debug().codegenToSeq()
        return [stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.size())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("cfg", [sample_config(), RetailConfig()], ids=["sample", "delivery"])
def test_code_of_normalise_is_compiled(spark, tmp_path, cfg):
    spool = lambda df, name: write_table(df, str(tmp_path / name))
    sizes = generated(spark, clean.normalise(spool(lines(spark), "landing"), cfg, spool))
    assert sizes and max(sizes) < COMPILED


def test_rows_per_task_stay_bounded(spark, tmp_path):
    """Beyond the checked size the number of tasks follows the rows, with the same result."""
    spool = lambda df, name: write_table(df, str(tmp_path / name))
    landing = spool(lines(spark), "landing")
    cfg = sample_config()
    large = cfg.with_(skew_min_rows=1, task_rows=30)
    calm = skew.HotBuckets((), 1)
    plain = clean.dedupe_lines(landing, cfg, spool, calm)
    many = clean.dedupe_lines(landing, large, spool, calm)
    assert many.rdd.getNumPartitions() == 1200 // 30
    assert many.exceptAll(plain).count() == 0 and plain.exceptAll(many).count() == 0


def test_hot_key_is_measured_by_the_rows_of_a_task(spark):
    cfg = sample_config().with_(skew_min_rows=1)
    rows = spark.range(4000).select(F.when(F.col("id") % 10 == 0, -1).otherwise(F.col("id")).alias("key"))
    assert not skew.find_hot_buckets(rows, ["key"], cfg)
    hot = skew.find_hot_buckets(rows, ["key"], cfg.with_(task_rows=100))
    assert len(hot.ids) == 1 and hot.salts >= 4


def test_range_tasks_follow_the_rows(spark, tmp_path):
    df = ranking.range_sorted(spark.range(1000), F.asc("id"), tasks=25)
    assert df.rdd.getNumPartitions() == 25
    stored = write_table(df, str(tmp_path / "ranked"))
    ranked = ranking.number_rows(stored, "place").drop("_total")
    assert ranked.filter(F.col("place") != F.col("id") + 1).count() == 0 and ranked.count() == 1000


def test_invoices_are_worked_out_once(spark, tmp_path, monkeypatch):
    """The range shuffle of the invoice table samples stored rows, not the sums and marks again."""
    from shopstar.plans import warehouse

    given = []
    monkeypatch.setattr(warehouse.store, "write_invoices", lambda df, path: given.append(df) or df)
    names = ("branch_code", "sku", "customer_id")
    none = {n: spark.createDataFrame([], f"{n} string") for n in names}
    wh = Warehouse(spark, Landing(lines(spark), *none.values()), str(tmp_path / "wh"), sample_config())
    fact = write_table(spark.createDataFrame([], ", ".join(
        f"{n} {t if isinstance(t, str) else t.simpleString()}" for n, t in schemas.FACT_COLUMNS.items())), str(tmp_path / "fact"))
    wh._built["fact_sales"] = fact
    wh.fact_invoices
    assert "Window" not in given[0]._jdf.queryExecution().optimizedPlan().toString()
    assert set(aggregates.INVOICE_GRAIN) < set(given[0].columns)


# Queries that need sums of lines or one distinct count, which the fact gives as well.
WITHOUT_INVOICES = (
    "headline_figures", "growth_seasonality_index", "page_exec_kpis_sliced", "product_cross_category",
    "product_by_segment", "partition_profile", "dq_report", "dq_category_summary", "signal_report")


def test_invoice_table_is_not_built_for_one_sum(spark):
    """A query alone does not pay for the invoice table; what is made of the fact is the same."""
    cfg = sample_config().with_(tail_days=119)  # a warehouse of its own
    wh = sample_warehouse(spark, f"{TESTDATA}/sf0.001", cfg)
    alone = {name: registry.operators()[name](wh).collect() for name in WITHOUT_INVOICES}
    assert all(alone.values()) and not wh.has("fact_invoices")
    invoices = wh.fact_invoices
    pairs = [
        (wh.rfm_base, rfm.rfm_base(invoices)),
        (wh.daily_cube, aggregates.daily_cube(wh.fact_sales, invoices)),
        (wh.dim_customer, dims.customer_enrich(wh.dim_customer_static, invoices)),
        (wh.cohort_counts, semantic.cohort_counts(invoices, wh.dim_customer))]
    for got, want in pairs:
        assert dict(got.dtypes) == dict(want.dtypes)
        want = want.select(*got.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert aggregates.stored_sales(wh) is invoices
    assert registry.operators()["headline_figures"](wh).collect() == alone["headline_figures"]


def test_city_is_conformed_once(spark, tmp_path):
    """The mark of a dirty line shares the conformed city."""
    def capitals(*columns):
        stages = landing.select(*columns)._jdf.queryExecution().debug().codegenToSeq()
        return sum(stages.apply(k)._2().count("InitCap") for k in range(stages.size()))

    landing = write_table(lines(spark), str(tmp_path / "landing"))
    city = scalar.initcap_words(F.trim("city"))
    assert capitals(city) > 0 and capitals(city.alias("city"), clean.is_dirty()) == capitals(city)
    rows = spark.createDataFrame(
        [(c, "Member", "1", "2", "Cash", "2020-01-01", "9") for c in ("York", " York", "yORK", "O'Neil", "o'Neil", "", None)],
        "city string, customer_type string, unit_price string, quantity string, payment string, date string, rating string")
    assert [r.dirty for r in rows.select("city", clean.is_dirty().alias("dirty")).collect()] == [
        False, True, True, False, True, False, False]
