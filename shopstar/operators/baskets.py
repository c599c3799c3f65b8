"""Which products are bought together: baskets as bit masks, pairs of frequent products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.ranking import Spool
from shopstar.functions.skew import lookup, row_count
from shopstar.operators.dims import UNKNOWN_KEY

# Keys of pair_counts: the row (ALL, ALL) counts baskets, (a, a) baskets with a,
# and (a, b) with a < b baskets with both.
ALL_BASKETS = -2
_BITS = 64


def _width(cfg: RetailConfig) -> int:
    return min(cfg.basket_block, _BITS)


def _block(width: int) -> Column:
    """Dense keys -1, 1..N become slots 0, 1..N, and slots become blocks of bits."""
    return F.floor(F.greatest(F.col("product_key"), F.lit(0)) / width).cast("int")


def _bit(width: int) -> Column:
    return F.expr(f"shiftleft(1L, cast(greatest(product_key, 0) % {width} as int))")


def product_bits(dim_product: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Products with their block and bit in the masks."""
    width = _width(cfg)
    return dim_product.withColumns({"block": _block(width), "bit": _bit(width)})


def _key(slot: str) -> Column:
    return F.when(F.col(slot) == 0, UNKNOWN_KEY).otherwise(F.col(slot)).cast("int")


def basket_masks(fact: DataFrame, cfg: RetailConfig) -> DataFrame:
    """(invoice_id, block, mask): the products of a basket, one bit each.

    One shuffle with map-side combine; however many lines an invoice has, it is a
    few numbers.
    """
    width = _width(cfg)
    return fact.groupBy("invoice_id", _block(width).alias("block")).agg(
        F.bit_or(_bit(width)).alias("mask"))


def _slots(mask: Column, block: Column, width: int) -> Column:
    """Product slots whose bit is set in a mask."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.getbit(mask, i) == 1)
    return F.transform(bits, lambda i: i + block * width)


def _shape_pairs(shapes: DataFrame, width: int) -> DataFrame:
    """(a, b) with a < b of every mask, weighted by the baskets that have it."""
    items = shapes.select("n", _slots(F.col("mask"), F.col("block"), width).alias("items"))
    later = F.slice("items", F.col("i") + 2, F.size("items") - F.col("i") - 1)
    return items.select("n", "items", F.posexplode("items").alias("i", "a")).select(
        "n", "a", F.explode(later).alias("b"))


def _pairs_across(masks: DataFrame, cfg: RetailConfig, spool: Spool) -> DataFrame:
    """Pairs of products that lie in different blocks of the catalogue.

    The blocks of an invoice meet by a join. Those of an invoice with very many
    are dealt into sides, and every pair of sides meets under a key of its own,
    so no task gets more than twice `basket_side` blocks of one invoice at once.
    """
    width = _width(cfg)
    counted = masks.withColumn("_blocks", F.count("*").over(W.partitionBy("invoice_id"))).filter(
        F.col("_blocks") > 1)
    sides = F.ceil(F.col("_blocks") / cfg.basket_side).cast("int")
    dealt = counted.withColumn("side", F.pmod(F.xxhash64("block"), sides).cast("int")).select(
        "*", F.explode(F.sequence(F.lit(0), sides - 1)).alias("_other"))
    stored = spool(dealt.select(
        "invoice_id", F.least("side", "_other").alias("low"), F.greatest("side", "_other").alias("high"),
        "side", "block", "mask"), "basket_sides")

    def half(s: str) -> DataFrame:
        return stored.select(
            "invoice_id", "low", "high", *[F.col(c).alias(f"{c}_{s}") for c in ("side", "block", "mask")])

    once = (F.col("side_a") != F.col("side_b")) | (F.col("low") == F.col("high"))
    both = half("a").join(half("b"), ["invoice_id", "low", "high"]).filter(
        (F.col("block_a") < F.col("block_b")) & once)
    shapes = both.groupBy("block_a", "mask_a", "block_b", "mask_b").agg(F.count("*").alias("n"))
    return shapes.select(
        "n", "block_b", "mask_b",
        F.explode(_slots(F.col("mask_a"), F.col("block_a"), width)).alias("a"),
    ).select("n", "a", F.explode(_slots(F.col("mask_b"), F.col("block_b"), width)).alias("b"))


def _met(masks: DataFrame, blocks: DataFrame, cfg: RetailConfig) -> DataFrame:
    """`masks` with the columns that `blocks`, a table of the catalogue, holds for their block."""
    placed = masks.withColumn("_at", F.xxhash64(*masks.columns))
    return lookup(placed, blocks, ["block"], cfg, "_at", "inner", masks, blocks).drop("_at")


def pair_counts(fact: DataFrame, dim_product: DataFrame, cfg: RetailConfig, spool: Spool,
                min_baskets: int = 1, masks: DataFrame | None = None) -> DataFrame:
    """How many baskets hold each product, and each pair of products.

    Pairs in fewer than `min_baskets` baskets are left out. Such a pair needs two
    products that are each in as many, so the others are cut out of the masks
    before any pair is formed; a block of the catalogue without a frequent product
    takes no further part. Equal masks are counted, and pairs are formed once per
    distinct mask and not per invoice. `masks` is the stored result of
    basket_masks, if there is one.
    """
    width = _width(cfg)
    if masks is None:
        masks = spool(basket_masks(fact, cfg), "basket_masks")
    shapes = spool(masks.groupBy("block", "mask").agg(F.count("*").alias("n")), "basket_shapes")
    single = spool(
        shapes.select("n", F.explode(_slots(F.col("mask"), F.col("block"), width)).alias("a"))
        .groupBy("a").agg(F.sum("n").alias("n")), "basket_items")
    frequent = spool(
        single.filter(F.col("n") >= min_baskets)
        .select(F.col("a").alias("product_key")).groupBy(_block(width).alias("block"))
        .agg(F.bit_or(_bit(width)).alias("_frequent")), "frequent_items")

    def pruned(df: DataFrame) -> DataFrame:
        both = F.col("mask").bitwiseAND(F.col("_frequent"))
        return _met(df, frequent, cfg).withColumn("mask", both).drop("_frequent").filter(F.col("mask") != 0)

    pairs = _shape_pairs(
        pruned(shapes).groupBy("block", "mask").agg(F.sum("n").alias("n")), width)
    if row_count(dim_product) > width:
        pairs = pairs.unionByName(_pairs_across(pruned(masks), cfg, spool))
        total = masks.select("invoice_id").distinct().agg(F.count("*").alias("n"))
    else:
        total = shapes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    counted = pairs.groupBy(_key("a").alias("key_a"), _key("b").alias("key_b")).agg(
        F.sum("n").alias("n")).filter(F.col("n") >= min_baskets)
    every = total.select(F.lit(ALL_BASKETS).alias("key_a"), F.lit(ALL_BASKETS).alias("key_b"), "n")
    return counted.unionByName(
        single.select(_key("a").alias("key_a"), _key("a").alias("key_b"), "n")).unionByName(every)


def line_pair_counts(masks: DataFrame, dim_product: DataFrame, cfg: RetailConfig,
                     spool: Spool) -> DataFrame:
    """(line_a, line_b, n): pairs of products of two lines in the same basket, over all baskets.

    A basket with p products of one line and q of another holds p * q such pairs,
    so it is cut down to its number of products per line, and no pair of products
    is formed. Baskets with equal numbers are counted first.
    """
    width = _width(cfg)
    lines = spool(
        dim_product.filter(F.col("product_line").isNotNull())
        .groupBy(_block(width).alias("block"), "product_line")
        .agg(F.bit_or(_bit(width)).alias("_own"))
        .groupBy("block").agg(F.collect_list(F.struct("product_line", "_own")).alias("_lines")),
        "line_masks")
    one_block = row_count(dim_product) <= width
    base, basket = (masks.groupBy("block", "mask").agg(F.count("*").alias("n")), "mask") if one_block else (
        masks.withColumn("n", F.lit(1).cast("bigint")), "invoice_id")
    held = F.filter(
        F.transform("_lines", lambda x: F.struct(
            x["product_line"].alias("line"),
            F.bit_count(x["_own"].bitwiseAND(F.col("mask"))).cast("bigint").alias("items"))),
        lambda x: x["items"] > 0)
    if one_block:
        sizes = _met(spool(base, "line_shapes"), lines, cfg).select("n", F.array_sort(held).alias("items"))
    else:
        sizes = (
            _met(base, lines, cfg).select(basket, F.explode(held).alias("x"))
            .groupBy(basket, F.col("x.line").alias("line")).agg(F.sum("x.items").alias("items"))
            .groupBy(basket).agg(F.array_sort(F.collect_list(F.struct("line", "items"))).alias("items"))
            .withColumn("n", F.lit(1).cast("bigint")))
    shapes = sizes.filter(F.size("items") > 1).groupBy("items").agg(F.sum("n").alias("n"))
    later = F.slice("items", F.col("i") + 2, F.size("items") - F.col("i") - 1)
    return (
        shapes.select("n", "items", F.posexplode("items").alias("i", "a"))
        .select("n", "a", F.explode(later).alias("b"))
        .groupBy(F.col("a.line").alias("line_a"), F.col("b.line").alias("line_b"))
        .agg(F.sum(F.col("n") * F.col("a.items") * F.col("b.items")).alias("n")))
