"""Global ranks without a single-task window."""

import pytest
from pyspark.sql import Window as W, functions as F

from shopstar.functions import ranking
from shopstar.operators import rfm
from shopstar.sources.store import write_table


def spooler(tmp_path):
    return lambda df, name: write_table(df, str(tmp_path / name))


@pytest.mark.parametrize("parts", ["1", "3", "8"])
def test_row_number_is_dense_whatever_the_partitions(spark, tmp_path, parts):
    """Two thirds of the rows tie on the leading value."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 17).alias("v"),
        (F.col("id") * 7919 % 2000).alias("k"))
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = ranking.global_row_number(df, [F.desc("v"), F.asc("k")], "rn", spooler(tmp_path))
        want = df.withColumn("rn", F.row_number().over(
            W.orderBy(F.desc("v"), "k")).cast("bigint"))
        assert got.select("v", "k", "rn").exceptAll(want).count() == 0
        assert got.agg(F.countDistinct("rn")).first()[0] == 2000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_ntile_formula(spark):
    """Equal to the built-in for all small N and k."""
    sizes = spark.range(1, 41).select(F.col("id").alias("n"))
    rows = sizes.select("n", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("r"))
    for k in (1, 2, 3, 5, 10, 11):
        both = rows.select(
            F.ntile(k).over(W.partitionBy("n").orderBy("r")).alias("want"),
            ranking.tile(F.col("r"), F.col("n"), k).alias("got"))
        assert both.filter("want <> got or got is null").count() == 0


def test_rank_per_group(spark, tmp_path):
    df = spark.range(900).select((F.col("id") % 3).alias("g"), (F.col("id") * 31 % 900).alias("k"))
    stored = spooler(tmp_path)(ranking.range_sorted(df, F.asc("g"), F.asc("k")), "groups")
    got = ranking.number_rows(stored, "rn", ["g"]).select("g", "k", "rn")
    want = df.withColumn("rn", F.row_number().over(W.partitionBy("g").orderBy("k")).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and got.count() == 900


def test_scores_with_ties_and_few_customers(spark, tmp_path):
    def base(rows):
        return spark.createDataFrame(
            rows, "customer_key bigint, recency_days int, frequency bigint, monetary bigint"
        ).withColumn("monetary", F.col("monetary").cast("decimal(22,4)"))

    ties = base([(k, 10, 1, 5) for k in range(1, 12)])
    scores = {r.customer_key: r for r in rfm.rfm_score(ties, spooler(tmp_path)).collect()}
    assert [scores[k].f_score for k in range(1, 12)] == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert [scores[k].r_score for k in range(1, 12)] == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]

    few = base([(1, 30, 1, 5), (2, 20, 2, 4), (3, 10, 3, 3)])
    got = {r.customer_key: (r.r_score, r.f_score, r.m_score)
           for r in rfm.rfm_score(few, spooler(tmp_path)).collect()}
    assert got == {1: (1, 1, 3), 2: (2, 2, 2), 3: (3, 3, 1)}


def test_segment_rules(spark):
    cases = {
        (5, 4, 4): "Champions", (3, 3, 3): "Loyal", (4, 2, 3): "Promising",
        (3, 2, 2): "Needs Attention", (2, 4, 4): "At Risk", (2, 3, 3): "Hibernating",
        (1, 1, 2): "Lost", (2, 1, 1): "Others", (4, 3, 4): "Loyal",
    }
    rows = [(i, *k) for i, k in enumerate(cases)]
    scores = spark.createDataFrame(rows, "customer_key int, r_score int, f_score int, m_score int")
    base = scores.select("customer_key", F.lit(1).alias("frequency"))
    got = {r.customer_key: r.rfm_segment for r in rfm.rfm_segment(base, scores).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
