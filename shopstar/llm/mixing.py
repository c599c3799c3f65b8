"""Mixing sources to target weights by pivotal rounding of copy probabilities."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from shopstar.functions.ranking import number_rows, range_sorted
from shopstar.llm.tables import Spool, aside, beside, restored
from shopstar.llm.text import WORD, row_id, whole


@dataclass(frozen=True)
class Mix:
    """weights go round over the sources in their order; share is of all sizes.

    leaf_rows: documents that are rounded in one task, on average. fan_in:
    residuals that meet in one task of the reduction tree.
    """

    weights: Sequence[int] = (5, 2, 1)
    share: float = 1.5
    most_copies: int = 2
    leaf_rows: int = 4_000
    fan_in: int = 64
    seed: int = 17


# An item of the rounding: a row (by hash, and its number among equal ones), its
# size, and the fraction of a copy that is still open.
ITEM = "rank long, node long, r1 long, r2 long, nth int, size long, part double, up int"


def sized(docs: DataFrame) -> DataFrame:
    """Adds size, the number of words, and _r1 and _r2, which identify the row."""
    r1, r2 = row_id("doc_id", "source", "text")
    return docs.withColumns({
        "size": F.regexp_count(whole(), F.lit(WORD)).cast("bigint"), "_r1": r1, "_r2": r2})


def source_targets(docs: DataFrame, mix: Mix, spool: Spool) -> DataFrame:
    """(source, rank, source_size, target, n_docs), a row per source.

    The sources are numbered by partition-wise sorting. Targets are shared out
    by weight; what would pass most_copies times a source's size is shared again
    among the others until nothing does. Only sums reach the driver.
    """
    sums = docs.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = number_rows(
        spool.write(range_sorted(sums, F.asc_nulls_last("source")), "sources-sorted"), "rank")
    weights = F.array(*[F.lit(w) for w in mix.weights])
    sources = spool.write(
        ranked.drop("_total").withColumn(
            "weight", F.element_at(weights, (F.pmod(F.col("rank") - 1, F.lit(len(mix.weights))) + 1).cast("int"))),
        "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    most = F.col("source_size") * mix.most_copies
    level, above = 0.0, None
    while True:
        capped = most < F.col("weight") * F.lit(level)
        held, free, n = sources.agg(
            F.coalesce(F.sum(F.when(capped, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
            F.count_if(capped)).first()
        if n == above or not free:
            break
        above, level = n, (mix.share * total - held) / free
    target = F.when(capped, most.cast("double")).otherwise(
        (F.lit(mix.share * total) - F.lit(float(held))) * F.col("weight") / F.lit(float(free or 1)))
    return sources.withColumn("target", F.least(target, most.cast("double"))).drop("weight")


def pivotal(part: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Rounds fractions of copies so that the sum of part * size hardly changes.

    Two open items at a time: words move from one to the other until one of the
    two is 0 or 1; which way is drawn so that neither fraction changes on
    average. At most one item stays open.
    """
    part = part.astype(float).copy()
    draws = draw.random(len(part))
    held = -1
    for i in range(len(part)):
        if held >= 0:
            a, b, p, q = float(size[held]), float(size[i]), part[held], part[i]
            to_held, to_next = min(a * (1 - p), b * q), min(a * p, b * (1 - q))
            if draws[i] * (to_held + to_next) < to_next:
                p, q = p + to_held / a, q - to_held / b
            else:
                p, q = p - to_next / a, q + to_next / b
            part[held], part[i] = (round(x) if abs(x - round(x)) < 1e-9 else x for x in (p, q))
        if 0 < part[i] < 1:
            held = i
        elif held >= 0 and not 0 < part[held] < 1:
            held = -1
    return part


def _rounder(seed: int):
    """A function that rounds the items of one node; `up` is null where one stays open."""

    def rounded(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(  # large ones first, so that a small one is left open
            ["size", "r1", "r2", "nth"], ascending=[False, True, True, True], kind="stable")
        first = items.iloc[0]
        draw = np.random.default_rng([seed, int(first["rank"]), int(first["node"]), len(items)])
        part = pivotal(items["part"].to_numpy(), items["size"].to_numpy(), draw)
        up = np.where((part > 0) & (part < 1), np.nan, part)
        return items.assign(part=part, up=pd.array(up).astype("Int32"))

    return rounded


def mix_sources(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """`docs` (of sized()) with source_size, target and copies.

    Every document gets the whole copies that its source's target asks for, and
    the fraction left over is rounded pivotally: within leaves of about
    leaf_rows documents, chosen by hash, then among the one open document that a
    leaf can leave, fan_in leaves at a time, up to the root, where the last one
    is drawn. So the words taken from a source miss its target by less than one
    document. The result depends on the rows only, not on how they are stored.

    A null source is one of its own, the last. Null and empty texts have size 0:
    they add nothing and take their nearest number of copies. Equal rows are
    told apart by number, so a repeated row is rounded like another document.
    """
    spool = Spool(docs.sparkSession, "mixing")
    targets = spool.write(source_targets(docs, mix, spool), "targets")
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    leaves = F.ceil(F.col("n_docs") / F.lit(mix.leaf_rows))
    rows = docs.groupBy("_r1", "_r2", "source", "size").agg(F.count("*").alias("_n"))
    items = spool.write(
        rows.join(targets.withColumnRenamed("source", "_from"), F.col("source").eqNullSafe(F.col("_from")))
        .withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
        .select(
            "rank", F.pmod(F.xxhash64(F.lit("leaf"), "_r1", "nth"), leaves).alias("node"),
            F.col("_r1").alias("r1"), F.col("_r2").alias("r2"), "nth", "size", "source_size", "target",
            F.floor(rate + 1e-12).cast("int").alias("base"),
            F.greatest(rate - F.floor(rate + 1e-12), F.lit(0.0)).alias("part")),
        "items")
    columns = [c.split()[0] for c in ITEM.split(", ")][:-1]
    unsettled = items.filter("size > 0 and part > 0").select(columns)
    nodes = items.agg(F.max("node")).first()[0] or 0
    settled, step = [], 0
    while True:
        done = spool.write(
            unsettled.groupBy("rank", "node").applyInPandas(_rounder(mix.seed + step), ITEM),
            f"round-{step}")
        settled.append(done.filter("up is not null"))
        unsettled = done.filter("up is null").select(
            *(F.floor(F.col("node") / mix.fan_in).alias("node") if c == "node" else F.col(c)
              for c in columns))
        step += 1
        if nodes == 0:
            break
        nodes //= mix.fan_in
    last = F.pmod(F.xxhash64(F.lit(mix.seed), "r1", "nth"), F.lit(1 << 30)) / F.lit(1 << 30)
    settled.append(unsettled.withColumn("up", (last < F.col("part")).cast("int")))
    up = reduce(DataFrame.unionByName, [s.select("r1", "r2", "nth", "up") for s in settled])
    # Lists by row, not by number, so that documents are shuffled once for both steps below.
    chosen = (
        items.join(up, ["r1", "r2", "nth"], "left")
        .withColumn("copies", F.col("base") + F.coalesce("up", F.round("part").cast("int")))
        .groupBy(F.col("r1").alias("_r1"), F.col("r2").alias("_r2"))
        .agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"),
             F.array_sort(F.collect_list(F.struct("nth", "copies"))).alias("_all")))

    def work(own: DataFrame) -> DataFrame:
        numbered = own.withColumn(
            "_nth", F.row_number().over(W.partitionBy("_r1", "_r2").orderBy("size")))
        return numbered.join(chosen, ["_r1", "_r2"]).withColumn(
            "copies", F.element_at("_all", F.col("_nth"))["copies"])

    return beside(docs, ["_r1", "_r2", "size"], ["source_size", "target", "copies"], work).drop("_r1", "_r2")


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: every row of `docs` as often as it is taken, with its own columns."""
    own = sized(aside(docs, "doc_id", "source", "text"))
    taken = mix_sources(own, mix).filter("copies > 0")
    return restored(taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs)
