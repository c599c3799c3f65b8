"""One key with a large part of all rows: salted paths give the plain result."""

import pytest
from pyspark.sql import functions as F

from shopstar.config import sample_config
from shopstar.functions import skew
from shopstar.operators import clean
from shopstar.sources.store import write_table

CFG = sample_config().with_(skew_min_rows=1, broadcast_rows=0)


def landing_with_hot_line(spark, tmp_path):
    """A third of the rows share one line key, half of those being exact copies."""
    n = F.col("id")
    hot = n % 3 == 0
    rows = spark.range(0, 3000, 1, 6).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("i"), (n % 1000).cast("string"))).alias("invoice_id"),
        F.lit("1").alias("line_no"),
        F.when(hot & (n % 2 == 0), "2000-01-05").otherwise(
            F.date_add(F.lit("2000-01-01").cast("date"), (n % 40).cast("int")).cast("string")).alias("date"),
        F.when(hot & (n % 2 == 0), 7).otherwise(n % 11).alias("l_partkey"),
        F.lit(1).alias("l_suppkey"), F.lit("1.00").alias("unit_price"), F.lit("1").alias("quantity"))
    return write_table(rows, str(tmp_path / "landing"))


def test_hot_key_is_found_and_bounded(spark, tmp_path):
    df = landing_with_hot_line(spark, tmp_path)
    hot = skew.find_hot_buckets(df, clean.LINE_KEY, CFG)
    assert len(hot.ids) == 1 and hot.salts >= 2
    calm = df.filter("invoice_id <> 'hot'")
    assert not skew.find_hot_buckets(calm, clean.LINE_KEY, CFG)


def test_dedupe_with_hot_line(spark, tmp_path):
    df = landing_with_hot_line(spark, tmp_path)
    spool = lambda d, name: write_table(d, str(tmp_path / name))
    plain = clean.dedupe_lines(df, CFG, spool, skew.HotBuckets((), 1))
    salted = clean.dedupe_lines(df, CFG, spool)
    assert salted.columns == plain.columns
    assert salted.count() == df.count()
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    assert salted.filter("not is_duplicate").count() == df.select(*clean.LINE_KEY).distinct().count()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_with_hot_and_missing_keys(spark, tmp_path, how):
    n = F.col("id")
    many = write_table(spark.range(0, 5000, 1, 5).select(
        n.alias("pos"),
        F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.lit(None)).otherwise(
            (n % 50).cast("string")).alias("key")), str(tmp_path / "many"))
    one = spark.range(40).select(n.cast("string").alias("key"), n.alias("value")).union(
        spark.sql("select 'hot', 99L"))
    assert skew.find_hot_buckets(many, ["key"], CFG)
    salted = skew.lookup(many, one, ["key"], CFG, "pos", how)
    plain = many.join(one, "key", how)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_large_lookup_side_is_not_broadcast(spark, tmp_path):
    many = spark.range(100).withColumn("pos", F.col("id"))
    small = skew.lookup(many, spark.range(10), ["id"], sample_config(), "pos")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = skew.lookup(many, spark.range(10), ["id"], CFG, "pos")
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
