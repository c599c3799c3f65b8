"""The whole build from CSV files, the gate, the layout and the plans."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from compare import TESTDATA
from shopstar import schemas
from shopstar.config import RetailConfig, sample_config
from shopstar.operators import fact as fact_ops, layout, measures, quality, signals
from shopstar.plans.warehouse import TABLES, Warehouse, run_pipeline, sample_warehouse
from shopstar.sources import landing, store


@pytest.fixture(scope="module")
def wh(spark):
    return sample_warehouse(spark, f"{TESTDATA}/sf0.01")


def write_csv(folder, name, text):
    (folder / f"{name}.csv").write_text(text)


@pytest.fixture()
def csv_folder(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write_csv(folder, "branches", "branch_code,city,region,opened_date,size_factor\n"
              "A,yangon,Yangon,2019-01-01,1.00\nB,\"mandalay\",Mandalay,2020-06-01,0.80\n")
    write_csv(folder, "products", "sku,product_line,product_name,base_price,margin_pct\n"
              "s1,Line,One,10.00,20\ns2,Line,\"Two, large\",20.00,30\ns3,Other,Three,30.00,10\n")
    write_csv(folder, "customers", "customer_id,signup_date,gender,home_branch,home_city\n"
              "C1,2019-02-01,female,a,yangon\nC2,,male,b,mandalay\n")
    header = ",".join(schemas.SALES_LANDING.names) + "\n"
    line = ("{inv},{no},a,YANGON,{cust},,Male,s1,Line,One,\"{price}\",{qty},0.05,,,{day},10:00:00,"
            "cash,,20,,{rating}\n")
    rows = [
        dict(inv="i1", no=1, cust="C1", price="$1,000.00", qty=2, day="2019-03-01", rating="9.0"),
        dict(inv="i1", no=1, cust="C1", price="$1,000.00", qty=2, day="2019-03-01", rating="9.0"),
        dict(inv="i2", no=1, cust="", price="10.00", qty=1, day="2019-03-02", rating=""),
        dict(inv="i3", no=1, cust="C9", price="10.00", qty=1, day="2020-03-02", rating="5.0"),
        dict(inv="i4", no=1, cust="C1", price="10.00", qty=-1, day="2020-03-02", rating="5.0"),
    ]
    write_csv(folder, "sales", header + "".join(line.format(**r) for r in rows))
    return folder


def test_from_csv_to_fact(spark, csv_folder, tmp_path):
    wh = Warehouse(spark, landing.read_landing(spark, str(csv_folder)), str(tmp_path / "wh"), RetailConfig())
    with pytest.raises(quality.QualityGateError, match="missing trading days"):
        run_pipeline(wh, control_copy=True)
    assert set(wh.timings) == {*TABLES, "fact_sales_flat"}
    rows = wh.fact_sales.orderBy("sale_id").collect()
    assert [r.sale_id for r in rows] == [1, 2, 3]
    assert [r.customer_key for r in rows] == [1, -1, -1]
    assert rows[0].total_amount == Decimal("2100.0000")
    assert wh.dim_customer.filter("customer_id = 'C2'").first().cohort_month is None
    assert wh.dim_product.filter("sku = 'S2'").first().product_name == "Two, large"
    reasons = {r.reject_reason: r.rows_rejected
               for r in quality.reject_counts(wh.stg_sales_rejects).collect()}
    assert reasons == {"DUPLICATE_LINE": 1, "NON_POSITIVE_QUANTITY": 1}
    audit = {r.table_name: r.row_count for r in wh.load_audit.collect() if r.step_name != "enrich"}
    assert audit["raw.sales_landing"] == 5 and audit["marts.fact_sales"] == 3


def test_quotes_within_quotes(spark, tmp_path):
    head = "customer_id,signup_date,gender,home_branch,home_city\n"
    (tmp_path / "q.csv").write_text(head + '"a ""b"", c","x\\",,"",d\n')
    (tmp_path / "n.csv").write_text(head + '"a\nb",x,y,z,d\n')
    read = landing.read_landing_csv
    assert [tuple(r)[:2] for r in read(spark, str(tmp_path / "q.csv"), schemas.CUSTOMERS_LANDING).collect()] == [
        ('a "b", c', "x\\")]
    rows = read(spark, str(tmp_path / "n.csv"), schemas.CUSTOMERS_LANDING, line_breaks=True).collect()
    assert [r.customer_id for r in rows] == ["a\nb"]


def test_files_with_other_columns_fail(spark, tmp_path):
    bad = tmp_path / "x.csv"
    bad.write_text("customer_id,gender,signup_date,home_branch,home_city\n1,2,3,4,5\n")
    with pytest.raises(Exception):
        landing.read_landing_csv(spark, str(bad), schemas.CUSTOMERS_LANDING).collect()


def test_invariants(wh):
    n = {t: wh.table(t).count() for t in ("sales_landing", "stg_sales_rejects", "fact_sales")}
    assert n["sales_landing"] == n["stg_sales_rejects"] + n["fact_sales"] == 56290
    ids = wh.fact_sales.agg(F.min("sale_id"), F.max("sale_id"), F.countDistinct("sale_id")).first()
    assert tuple(ids) == (1, n["fact_sales"], n["fact_sales"])
    sizes = [r["count"] for r in wh.customer_rfm.groupBy("f_score").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == wh.rfm_base.count() == 1337


def test_gate(wh):
    with pytest.raises(quality.QualityGateError, match="2 assertion"):
        quality.dq_gate(wh.dq_results)
    assert quality.dq_gate(wh.dq_results.filter("status = 'PASS'")) == 16
    with pytest.raises(RuntimeError):
        signals.assert_signals(signals.signal_report(wh))


def test_out_of_window_rows_stop_the_load(wh):
    from datetime import date

    with pytest.raises(fact_ops.OutOfWindowError):
        fact_ops.assert_no_default_partition(
            wh.fact_sales, wh.cfg.with_(window_end=date(2001, 1, 1)))


def test_a_failed_load_keeps_its_trail(spark, tmp_path, wh, monkeypatch):
    """Hops are noted as they end, each with its own time."""
    from shopstar.plans.warehouse import Warehouse, run_pipeline

    def stop(*_):
        raise fact_ops.OutOfWindowError("stopped")

    monkeypatch.setattr(fact_ops, "assert_no_default_partition", stop)
    stopped = Warehouse(spark, wh.landing, str(tmp_path), wh.cfg)
    with pytest.raises(fact_ops.OutOfWindowError):
        run_pipeline(stopped)
    trail = stopped.audit_trail().orderBy("audit_id").collect()
    assert [r.step_name for r in trail] == ["extract", "reject", "clean", *["dimensions"] * 5]
    assert len({r.loaded_at for r in trail}) == len(trail)


def test_both_layouts_answer_alike(wh):
    flat = wh.fact_sales_flat
    for name, run in layout.QUERIES.items():
        a, b = run(wh, wh.fact_sales), run(wh, flat)
        assert a.count() > 0, name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert layout.layout_parity(wh.fact_sales, flat).first().same_content == 1


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_filter_prunes_folders(wh):
    text = plan(layout.month_by_branch(wh.fact_sales, wh.cfg.bench))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "sale_month" in filters and "2000-07-01" in filters
    assert "ReadSchema: struct<sale_date:date,branch_key:int,total_amount:decimal(12,4)>" in text


def test_customer_lookup_reaches_the_scan(wh):
    text = plan(layout.customer_history(wh.fact_sales, wh.cfg.bench))
    assert "EqualTo(customer_key,700)" in text


def test_ranks_need_no_single_task_over_detail_rows(spark, wh):
    """The window over partition counts is the only single-partition step."""
    df = fact_ops.number_rows(wh.stg_sales_sorted, "sale_id")
    text = plan(df)
    assert "rowsBetween" not in text
    single = text.split("SinglePartition")
    assert len(single) <= 3
    for after in single[1:]:
        assert "HashAggregate" in after.split("\n", 2)[1]


def test_measure_guards(wh):
    with pytest.raises(KeyError):
        measures.measures(wh, ["no_such_measure"])
    with pytest.raises(KeyError):
        measures.measures(wh, ["invoices"], ["no_such_column"])


def test_period_measures_by_month_are_those_of_the_trend(wh):
    names = [*measures.PERIODS, "revenue_ly", "revenue_yoy_pct", "profit_yoy_pct"]
    got = measures.done(measures.measures(wh, names, ["year_month"])).collect()
    want = measures.time_measures(wh).select("year_month", *names).collect()
    assert sorted(got) == sorted(want)


def test_periods_end_with_the_last_date_chosen(wh):
    """A weekday slicer only sets the last date; the period itself holds all days."""
    row = measures.measures(
        wh, ["total_revenue", "revenue_ytd"],
        filters={"year_month": "2000-05", "day_name": "Monday"}).first()
    days = wh.fact_sales.filter("sale_date between '2000-01-01' and '2000-05-29'")
    assert row.revenue_ytd == pytest.approx(float(days.agg({"total_amount": "sum"}).first()[0]))
    assert row.total_revenue < row.revenue_ytd


def test_every_measure_takes_any_context(wh):
    """All measures, by a fact column and a segment, under slicers of every table."""
    names = [*measures.MEASURES, *measures.LAST_YEAR, *measures.PERIODS,
             *measures.CUSTOMER, "new_customers"]
    df = measures.measures(
        wh, names, ["sale_hour", "value_band", "home_city", "quarter_name"],
        {"region": ["Asia", "Europe"], "activity_status": ["Active", "Dormant"], "is_weekend": True})
    assert set(names) <= set(df.columns)
    assert df.count() > 0


def test_segment_revenue_replaces_the_segment_of_its_context(wh):
    rows = measures.measures(wh, ["champions_revenue", "champions_pct"], ["rfm_segment"]).collect()
    plain = measures.measures(wh, ["champions_revenue", "champions_pct"]).first()
    assert {(r.champions_revenue, r.champions_pct) for r in rows} == {
        (plain.champions_revenue, plain.champions_pct)}


def test_slicers_prune_months_and_do_not_change_shares(wh):
    """A calendar slicer reaches the month folders; parts add up to the whole."""
    by_year = measures.measures(wh, ["total_revenue"], ["year_number"]).collect()
    some = measures.measures(
        wh, ["total_revenue"], ["year_number"], {"year_number": [1999, 2000]})
    assert "dynamicpruning" in plan(some)
    got = {r.year_number: r.total_revenue for r in some.collect()}
    assert got == {r.year_number: r.total_revenue for r in by_year if r.year_number in (1999, 2000)}
    whole = measures.done(measures.measures(wh, ["total_revenue"])).first().total_revenue
    assert abs(sum(r.total_revenue for r in by_year) - whole) < 0.01


def test_segments_cover_all_scored_customers(wh):
    grid = measures.measures(wh, ["active_customers"], ["rfm_segment"]).collect()
    assert sum(r.active_customers for r in grid) == wh.rfm_base.count()


def test_month_zero_is_everyone(wh):
    from shopstar.operators import semantic

    long = semantic.cohort_retention_long(wh.cohort_counts, wh.cfg)
    assert long.filter("month_index = 0 and retention_pct <> 100").count() == 0


def test_shared_folder(spark):
    folder = store.shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_sample_parameters_are_the_only_difference():
    assert sample_config().min_pair_baskets == RetailConfig().min_pair_baskets == 200


def test_line_breaks_reach_the_reader(spark, csv_folder):
    """A quoted field over two lines, through the entry point's own reader."""
    (csv_folder / "products.csv").write_text(
        "sku,product_line,product_name,base_price,margin_pct\ns1,Line,\"One\nmore\",10.00,20\n")
    rows = landing.read_landing(spark, str(csv_folder), line_breaks=True).products.collect()
    assert [(r.product_name, r.margin_pct) for r in rows] == [("One\nmore", "20")]
    with pytest.raises(Exception):
        landing.read_landing(spark, str(csv_folder)).products.collect()


def test_scratch_tables_go_when_a_build_ends(spark, csv_folder, tmp_path):
    wh = Warehouse(spark, landing.read_landing(spark, str(csv_folder)), str(tmp_path / "wh"), RetailConfig())
    run_pipeline(wh, control_copy=True, gate=False)
    spool = tmp_path / "wh" / "spool"
    assert [p.name for p in spool.iterdir()] == []
    kept = wh.spool(wh.dim_branch, "by_hand")
    assert kept.count() == 3 and [p.name.split("-")[0] for p in spool.iterdir()] == ["by_hand"]
    wh.clear_spool()
    assert [p.name for p in spool.iterdir()] == []
    shares = wh.sku_shares.orderBy("place").collect()
    assert [r.place for r in shares] == [1] and shares[0].running == shares[0].total


def test_control_copy_is_a_heap(wh):
    """The same rows as the month layout, in no order that a scan could use."""
    flat = wh.fact_sales_flat
    assert flat.count() == wh.fact_sales.count()
    file = F.input_file_name()
    spread = flat.groupBy(file.alias("f")).agg(
        F.min("sale_month").alias("lo"), F.max("sale_month").alias("hi"), F.count("*").alias("n")).collect()
    assert all(r.lo.year == 1995 and r.hi.year == 2001 for r in spread if r.n > 500)


def test_bloom_filters_on_both_keys(spark, tmp_path):
    """Row groups with too many keys for a dictionary carry a filter for both keys and for nothing else."""
    given = {"invoice_id": F.format_string("%011d", "id"), "customer_key": F.col("id") * 7919, "sale_id": F.col("id"),
             "sale_date": F.lit("2021-05-03"), "sale_month": F.lit("2021-05-01"), "customer_type": F.lit("Normal"),
             "gender": F.lit("Male"), "sale_time": F.lit("10:00:00")}
    fact = spark.range(0, 200_000, 1, 1).select(*[
        given.get(c, F.lit(1)).cast(t).alias(c) for c, t in schemas.FACT_COLUMNS.items()])
    written = store.write_fact_partitioned(fact, str(tmp_path / "fact"), by_date=True)
    path = spark._jvm.org.apache.hadoop.fs.Path(written.inputFiles()[0])
    source = spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration())
    reader = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        filters = {c.getPath().toDotString() for c in columns if c.getBloomFilterOffset() > 0}
    finally:
        reader.close()
    assert filters == {"invoice_id", "customer_key"}
    assert written.filter("invoice_id = '00000000077'").count() == 1
