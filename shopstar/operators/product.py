"""Category, assortment and basket analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.ranking import Spool, running_totals
from shopstar.functions.scalar import all_rows, dbl, mean, money, pct, ratio, rnd
from shopstar.operators.common import in_years, line_count, rated_count, rating_total, with_calendar
from shopstar.operators.semantic import pair_measures


def by_product(fact: DataFrame, *sums: Column) -> DataFrame:
    """Aggregate on the key first: only one row per product meets the dimension."""
    return fact.groupBy("product_key").agg(*sums)


def line_performance(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    per_product = by_product(
        fact,
        line_count(fact).alias("items"), F.sum("quantity").alias("units"),
        F.sum("total_amount").alias("rev"), F.sum("gross_profit").alias("profit"),
        F.sum("gross_sales").alias("gross"),
        rating_total(fact).alias("rating_sum"), rated_count(fact).alias("rated"))
    lines = per_product.join(
        dim_product.select("product_key", "product_line"), "product_key"
    ).groupBy("product_line").agg(
        *(F.sum(c).alias(c) for c in
          ("items", "units", "rev", "profit", "gross", "rating_sum", "rated")))
    c = F.col
    return lines.select(
        "product_line",
        c("items").alias("line_items"),
        c("units").alias("units_sold"),
        money(c("rev")).alias("revenue"),
        pct(c("rev"), F.sum("rev").over(all_rows())).alias("pct_revenue"),
        money(c("profit")).alias("gross_profit"),
        pct(c("profit"), F.sum("profit").over(all_rows())).alias("pct_profit"),
        pct(c("profit"), c("gross")).alias("margin_pct"),
        rnd(ratio(c("rating_sum"), c("rated")), 2).alias("avg_rating"),
        F.rank().over(W.orderBy(F.desc("rev"))).alias("revenue_rank"),
        F.rank().over(W.orderBy(F.desc("profit"))).alias("profit_rank"),
    ).orderBy(F.desc("revenue"), "product_line")


def sku_shares(fact: DataFrame, dim_product: DataFrame, cfg: RetailConfig, spool: Spool) -> DataFrame:
    """Revenue per SKU with place, running share and class; a SKU counts by where it ends."""
    skus = by_product(
        fact, F.sum("total_amount").alias("rev"), F.sum("gross_profit").alias("prof"),
        F.sum("quantity").alias("units"),
    ).join(dim_product, "product_key")
    ranked = running_totals(skus, [F.desc("rev"), F.asc("sku")], "rev", spool)
    share = ratio(F.col("running"), F.col("total"))
    return ranked.withColumn("cum_share", share).withColumn(
        "abc_class",
        F.when(F.col("cum_share") <= cfg.abc_a, "A").when(F.col("cum_share") <= cfg.abc_b, "B")
        .otherwise("C"))


def abc_skus(shares: DataFrame) -> DataFrame:
    return shares.select(
        F.col("place").alias("revenue_rank"), "sku", "product_name", "product_line",
        money(F.col("rev")).alias("revenue"),
        money(F.col("prof")).alias("profit"),
        "units",
        rnd(F.lit(100.0) * F.col("cum_share"), 1).alias("cumulative_pct"),
        "abc_class",
    ).orderBy("revenue_rank")


def abc_summary(shares: DataFrame) -> DataFrame:
    classes = shares.groupBy("abc_class").agg(
        F.count("*").alias("skus"), F.sum("rev").alias("rev"), F.sum("prof").alias("prof"))

    def share(c: str) -> Column:
        return pct(F.col(c), F.sum(c).over(all_rows()))

    return classes.select(
        "abc_class", "skus", share("skus").alias("pct_of_skus"),
        money(F.col("rev")).alias("revenue"), share("rev").alias("pct_of_revenue"),
        money(F.col("prof")).alias("profit"), share("prof").alias("pct_of_profit"),
    ).orderBy("abc_class")


def with_all(items: DataFrame, figures: DataFrame, item: str) -> DataFrame:
    """Every item, also one that has no figures; a NULL item meets a NULL one."""
    named = figures.withColumnRenamed(item, "_item")
    return items.join(named, items[item].eqNullSafe(named["_item"]), "left").drop("_item")


def yearly_shares(sums: DataFrame, item: str, years: tuple[int, ...]) -> DataFrame:
    """Share of `item` within each year, one column per chosen year.

    `sums` holds one row per (yr, item) with its revenue.
    """
    share = F.lit(100.0) * dbl(F.col("revenue")) / dbl(
        F.sum("revenue").over(W.partitionBy("yr")))
    return (
        sums.withColumn("share", share)
        .groupBy(item).pivot("yr", list(years))
        .agg(F.max("share").alias("share"), F.max("revenue").alias("rev"))
    )


def mix_shift(fact: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
              cfg: RetailConfig) -> DataFrame:
    """Shares of three years, of which only the sales are read; all lines ever sold are shown."""
    first, _, last = cfg.share_years
    names = dim_product.select("product_key", "product_line")
    sums = (
        with_calendar(in_years(fact, cfg.share_years), dim_date, "year_number")
        .groupBy("year_number", "product_key").agg(F.sum("total_amount").alias("revenue"))
        .join(names, "product_key")
        .groupBy(F.col("year_number").alias("yr"), "product_line")
        .agg(F.sum("revenue").alias("revenue"))
    )
    sold = fact.select("product_key").distinct().join(names, "product_key").select("product_line").distinct()
    c = F.col
    return with_all(sold, yearly_shares(sums, "product_line", cfg.share_years), "product_line").select(
        "product_line",
        *(rnd(c(f"{y}_share"), 1).alias(f"share_{y}") for y in cfg.share_years),
        rnd(c(f"{last}_share") - c(f"{first}_share"), 1).alias("share_change_pts"),
        rnd(F.lit(100.0) * (ratio(c(f"{last}_rev"), c(f"{first}_rev")) - 1), 1)
        .alias("revenue_growth_pct"),
    ).orderBy(F.desc("share_change_pts"), "product_line")


def top_affinities(pairs: DataFrame, dim_product: DataFrame, cfg: RetailConfig) -> DataFrame:
    def label(s: str) -> Column:
        return F.concat(f"name_{s}", F.lit(" ("), f"line_{s}", F.lit(")"))

    return pair_measures(pairs, dim_product, cfg.min_pair_baskets).select(
        label("a").alias("product_a"), label("b").alias("product_b"),
        "baskets_together", "support_pct",
        F.col("confidence_a_pct").alias("confidence_a_to_b_pct"),
        F.col("confidence_b_pct").alias("confidence_b_to_a_pct"),
        "lift",
        F.when(F.col("line_a") != F.col("line_b"), "cross-category")
        .otherwise("within-category").alias("pair_type"),
    ).orderBy(F.desc("lift"), F.desc("baskets_together"), "product_a", "product_b").limit(
        cfg.top_pairs)


def cross_category(line_pairs: DataFrame, cfg: RetailConfig) -> DataFrame:
    """The pairs of lines whose products are bought together most."""
    return (
        line_pairs.select("line_a", "line_b", F.col("n").alias("baskets_together"))
        .orderBy(F.desc("baskets_together"), "line_a", "line_b").limit(cfg.top_line_pairs))


def basket_size(fact: DataFrame) -> DataFrame:
    baskets = fact.groupBy("invoice_id").agg(
        line_count(fact).alias("lines_in_basket"),
        F.sum("total_amount").alias("value"),
        F.sum("gross_profit").alias("profit"),
    )
    sizes = baskets.groupBy("lines_in_basket").agg(
        F.count("*").alias("invoices"),
        rnd(mean(F.col("value")), 2).alias("avg_basket_value"),
        rnd(mean(F.col("profit")), 2).alias("avg_basket_profit"),
        F.sum("value").alias("rev"),
    )
    return sizes.select(
        "lines_in_basket", "invoices",
        pct(F.col("invoices"), F.sum("invoices").over(all_rows())).alias("pct_of_invoices"),
        "avg_basket_value", "avg_basket_profit",
        money(F.col("rev")).alias("total_revenue"),
        pct(F.col("rev"), F.sum("rev").over(all_rows())).alias("pct_of_revenue"),
    ).orderBy("lines_in_basket")


def price_bands(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    per_product = by_product(
        fact, F.count("*").alias("n"), F.sum("quantity").alias("units"),
        F.sum("total_amount").alias("rev"), F.sum("gross_profit").alias("prof"),
        F.sum("gross_sales").alias("gross"), F.sum("unit_price").alias("price_sum"),
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rated"))
    return (
        per_product.join(dim_product.filter(F.col("price_band") != "Unknown"), "product_key")
        .groupBy("price_band").agg(
            F.countDistinct("sku").alias("skus"),
            F.sum("units").alias("units"),
            money(F.sum("rev")).alias("revenue"),
            money(F.sum("prof")).alias("profit"),
            pct(F.sum("prof"), F.sum("gross")).alias("margin_pct"),
            rnd(ratio(F.sum("price_sum"), F.sum("n")), 2).alias("avg_unit_price"),
            rnd(ratio(F.sum("rating_sum"), F.sum("rated")), 2).alias("avg_rating"))
        .orderBy(F.desc("revenue"), "price_band")
    )


def lines_by_segment(fact: DataFrame, rfm: DataFrame, dim_product: DataFrame,
                     cfg: RetailConfig) -> DataFrame:
    """Product lines bought by three segments; index over 100: champions buy more of it.

    Sales are first summed per customer and product, which is what meets the
    customer-sized segment table.
    """
    segments = ["Champions", "Loyal", "At Risk"]
    sums = fact.groupBy("customer_key", "product_key").agg(F.sum("total_amount").alias("revenue"))
    chosen = rfm.filter(F.col("rfm_segment").isin(*segments)).select("customer_key", "rfm_segment")
    pivoted = (
        sums.join(chosen, "customer_key")
        .join(dim_product.select("product_key", "product_line"), "product_key")
        .groupBy("product_line").pivot("rfm_segment", segments).agg(F.sum("revenue"))
    )
    c = F.col
    champions = c("Champions")
    every = sum((F.coalesce(c(s), F.lit(0)) for s in segments[1:]),
                F.coalesce(champions, F.lit(0)))
    index = F.lit(100.0) * ratio(champions, F.sum(champions).over(all_rows())) / ratio(
        every, F.sum(every).over(all_rows()))
    return pivoted.select(
        "product_line",
        money(champions).alias("champions_rev"),
        money(c("Loyal")).alias("loyal_rev"),
        money(c("At Risk")).alias("at_risk_rev"),
        rnd(index, 0).alias("champion_index"),
    ).orderBy(F.desc("champion_index"), "product_line")
