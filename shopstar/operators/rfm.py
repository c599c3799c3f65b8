"""Recency, frequency and monetary scores of identified customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopstar.functions.ranking import Spool, number_rows, range_sorted, tile
from shopstar.operators.common import identified

# Scores run from 1 to 5.
SCORES = 5
METRICS = ("r_score", "f_score", "m_score")
# Of sums over a customer, whether lines or sums of lines were added up.
SPEND = "decimal(32,4)"


def rfm_base(fact: DataFrame) -> DataFrame:
    """One row per customer, recency counted to the latest sale of all."""
    as_of = fact.agg(F.max("sale_date").alias("as_of")).scalar()
    return (
        fact.filter(identified())
        .groupBy("customer_key")
        .agg(
            F.max("sale_date").alias("last_purchase"),
            F.countDistinct("invoice_id").alias("frequency"),
            F.sum("total_amount").cast(SPEND).alias("monetary"),
            F.sum("gross_profit").cast(SPEND).alias("profit"),
            F.min("sale_date").alias("first_purchase"),
        )
        .select(
            "customer_key", "last_purchase",
            F.datediff(as_of, "last_purchase").alias("recency_days"),
            "frequency", "monetary", "profit", "first_purchase",
            F.datediff("last_purchase", "first_purchase").alias("tenure_days"),
        )
    )


def rfm_score(base: DataFrame, spool: Spool) -> DataFrame:
    """Quintiles of all three metrics from one range sort; customer_key settles ties.

    A shorter recency earns the higher score, hence the minus sign. The place by
    spend, best first, comes from the same sort and is kept as monetary_rank, so
    that shares of the best customers need no sort of their own.
    """
    wide = "decimal(38,4)"
    values = (
        (-F.col("recency_days")).cast(wide),
        F.col("frequency").cast(wide),
        F.col("monetary").cast(wide),
        (-F.col("monetary")).cast(wide),
    )
    metric = F.explode(F.array(*(
        F.struct(F.lit(i).alias("metric"), v.alias("value")) for i, v in enumerate(values))))
    long = base.select("customer_key", metric.alias("m")).select("customer_key", "m.*")
    stored = spool(
        range_sorted(long, F.asc("metric"), F.asc("value"), F.asc("customer_key")), "rfm_ranks")
    scored = number_rows(stored, "rank", ["metric"]).withColumn(
        "score", tile(F.col("rank"), F.col("_total"), SCORES))
    return scored.groupBy("customer_key").agg(
        *(F.max(F.when(F.col("metric") == i, F.col("score"))).alias(name)
          for i, name in enumerate(METRICS)),
        F.max(F.when(F.col("metric") == len(METRICS), F.col("rank"))).alias("monetary_rank"))


def rfm_segment(base: DataFrame, scores: DataFrame) -> DataFrame:
    """Ordered rules: a narrower segment is tested before a wider one.

    Fixed values: names and bounds of the segments.
    """
    r = F.col("r_score")
    fm = (F.col("f_score") + F.col("m_score")) / F.lit(2.0)
    segment = (
        F.when((r >= 4) & (fm >= 4), "Champions")
        .when((r >= 3) & (fm >= 3), "Loyal")
        .when((r >= 4) & (fm < 3), "Promising")
        .when((r == 3) & (fm < 3), "Needs Attention")
        .when((r <= 2) & (fm >= 4), "At Risk")
        .when((r <= 2) & (fm >= 3), "Hibernating")
        .when(r == 1, "Lost")
        .otherwise("Others")
    )
    kept = [c for c in scores.columns if c not in ("customer_key", *METRICS)]
    return base.join(scores, "customer_key").select(
        *base.columns, *METRICS, fm.alias("fm_score"), segment.alias("rfm_segment"), *kept)


def dim_customer_rfm(rfm: DataFrame) -> DataFrame:
    """Names and bounds of the value bands and activity states."""
    days = F.col("recency_days")
    return rfm.select(
        "customer_key", "rfm_segment", *METRICS, "fm_score", "recency_days",
        F.col("frequency").alias("lifetime_orders"),
        F.round("monetary", 2).alias("lifetime_revenue"),
        F.round("profit", 2).alias("lifetime_profit"),
        "first_purchase", "last_purchase", "tenure_days",
        F.when(F.col("m_score") == 5, "High value").when(F.col("m_score") >= 3, "Mid value")
        .otherwise("Low value").alias("value_band"),
        F.when(days <= 90, "Active").when(days <= 180, "Cooling").when(days <= 365, "Lapsing")
        .otherwise("Dormant").alias("activity_status"),
    )
