"""What a build may leave on disk: no shuffle files, no shuffle of all lines at once, no wide lines dealt in vain."""

import time

import pytest
from pyspark.sql import functions as F

from compare import TESTDATA
from shopstar.config import sample_config
from shopstar.functions import skew
from shopstar.operators import clean
from shopstar.plans import registry, warehouse
from shopstar.plans.warehouse import Warehouse, sample_warehouse
from shopstar.sources import sample_landing, store
from shopstar.sources.landing import Landing
from shopstar.sources.store import write_table
from test_growth import lines

SLICED = sample_config().with_(slice_rows=1500, skew_min_rows=1, task_rows=400, broadcast_rows=5)


def same_rows(got, want):
    assert dict(got.dtypes) == dict(want.dtypes)
    want = want.select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(k).getName() for k in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_built_table_leaves_no_shuffle_files(spark, tmp_path):
    names = ("branch_code", "sku", "customer_id")
    none = [spark.createDataFrame([], f"{n} string") for n in names]
    wh = Warehouse(spark, Landing(lines(spark), *none), str(tmp_path / "wh"), sample_config())
    wh.sales_landing
    before = shuffle_files(spark)
    settings = {name: spark.conf.get(name, None) for name in (*store.SPARING, store.READ_BYTES)}
    wh.normalised
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and wh.normalised.count() == 1200
    assert {name: spark.conf.get(name, None) for name in settings} == settings


def test_settings_come_back_after_a_failure(spark):
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    with pytest.raises(ValueError):
        with store.sparing_disk(spark):
            assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"
            raise ValueError
    assert spark.conf.get("spark.sql.parquet.compression.codec") == before


def test_sliced_build_gives_the_same_tables(spark, monkeypatch):
    """Lines dealt, sorted and written slice by slice: the same rows, sale ids included."""
    found = {}

    def counted(slices, path):
        slices = list(slices)
        found[path.rsplit("/", 1)[1]] = len(slices)
        return write(slices, path)

    write = store.write_slices
    monkeypatch.setattr(warehouse.store, "write_slices", counted)
    fact_months = []
    deal = store.write_fact_partitioned
    monkeypatch.setattr(
        warehouse.store, "write_fact_partitioned",
        lambda fact, path, by_date, months: fact_months.append(months) or deal(fact, path, by_date, months))
    whole = sample_warehouse(spark, f"{TESTDATA}/sf0.001", sample_config())
    sliced = sample_warehouse(spark, f"{TESTDATA}/sf0.001", SLICED)
    names = ("normalised", "stg_sales", "stg_sales_rejects", "fact_sales")
    for name in names:
        want, got = getattr(whole, name), getattr(sliced, name)
        hidden = [c for c in ("rejected_at",) if c in got.columns]
        same_rows(got.drop(*hidden), want.drop(*hidden))
    assert found["normalised"] > 1 and found["stg_sales_sorted"] > 1 and len(fact_months[-1]) > 1
    n = got.count()
    assert got.agg(F.min("sale_id"), F.max("sale_id"), F.countDistinct("sale_id")).first()[:] == (1, n, n)


def test_slices_hold_whole_keys_and_all_lines(spark, tmp_path):
    landing = write_table(lines(spark).withColumn(
        "invoice_id", F.when(F.col("l_partkey") % 7 > 0, F.col("invoice_id"))), str(tmp_path / "landing"))
    slices = clean.by_line_key(landing, SLICED.with_(slice_rows=500))
    assert len(slices) == 3 and sum(s.count() for s in slices) == 1200
    keys = [s.select(*clean.LINE_KEY).distinct() for s in slices]
    assert sum(k.count() for k in keys) == landing.select(*clean.LINE_KEY).distinct().count()


def test_spans_cover_every_value_once(spark, tmp_path):
    rows = write_table(spark.range(1000).select(
        F.when(F.col("id") < 400, 3).otherwise(F.col("id") % 10).alias("day")), str(tmp_path / "days"))
    assert skew.spans(rows, F.col("day"), SLICED) == []
    spans = skew.spans(rows, F.col("day"), SLICED.with_(slice_rows=250))
    assert sum(n for *_, n in spans) == 1000 and spans[0][0] == 0 and spans[-1][1] == 9
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and (3, 3, 460) in spans
    assert all(n <= 250 * 1.05 for first, _, n in spans if first != 3)


def test_lines_do_not_carry_the_texts_of_their_sides(spark):
    """Where the sides are not broadcast, a line is dealt with keys and names, and its order joins last."""
    def exchanges(plan):
        own = [plan.output()] if plan.nodeName() == "Exchange" else []
        children = plan.children()
        return own + [e for k in range(children.size()) for e in exchanges(children.apply(k))]

    for name, value in (("adaptive.enabled", "false"), ("autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        sales = sample_landing.sales(spark, f"{TESTDATA}/sf0.001", sample_config().with_(broadcast_rows=0))
        found = exchanges(sales._jdf.queryExecution().executedPlan())
        dealt = [{e.apply(k).name() for k in range(e.size())} for e in found]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    of_lines = [names for names in dealt if "l_linenumber" in names]
    assert len(of_lines) == 3
    assert set.union(*of_lines) == {
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "p_brand", "n_nationkey", "n_name"}


ALONE = ("growth_annual_cagr", "customer_new_vs_returning", "page_exec_region_matrix",
         "measure_customers_by_segment", "page_customer_acquisition")


def test_invoice_table_is_not_built_for_sums_by_customer_or_region(spark):
    wh = sample_warehouse(spark, f"{TESTDATA}/sf0.001", sample_config().with_(tail_days=118))
    alone = {name: registry.operators()[name](wh) for name in ALONE}
    found = {name: (df.dtypes, df.collect()) for name, df in alone.items()}
    assert all(rows for _, rows in found.values()) and not wh.has("fact_invoices")
    wh.fact_invoices
    for name in ALONE:
        again = registry.operators()[name](wh)
        assert (again.dtypes, again.collect()) == found[name], name
