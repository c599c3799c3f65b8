"""Ways to work on keys of which one may hold a large part of all rows."""

from __future__ import annotations

import math
from dataclasses import dataclass
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from shopstar.config import RetailConfig

BUCKETS = 1 << 16

_row_counts: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def row_count(stored: DataFrame) -> int:
    """Rows of a stored table, counted once per frame; Parquet footers answer it."""
    if stored not in _row_counts:
        _row_counts[stored] = stored.count()
    return _row_counts[stored]


def is_small(stored: DataFrame, cfg: RetailConfig) -> bool:
    """Small enough to be sent to every executor or to pass through one task."""
    return row_count(stored) <= cfg.broadcast_rows


def task_count(spark: SparkSession, rows: int, cfg: RetailConfig) -> int:
    """Tasks for a shuffle of so many rows: those of the session, or more if each would hold over task_rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / cfg.task_rows))


def dealt(df: DataFrame, keys: list[str], rows: int, cfg: RetailConfig) -> DataFrame:
    """Deal `rows` rows by `keys`, so that a task's share does not grow with the input.

    A fixed number of tasks is neither too low for a large input nor merged
    afterwards; small inputs are left to adaptive execution.
    """
    if rows < cfg.skew_min_rows:
        return df.repartition(*keys)
    return df.repartition(task_count(df.sparkSession, rows, cfg), *keys)


def spans(stored: DataFrame, unit: Column, cfg: RetailConfig) -> list[tuple[object, object, int]]:
    """Consecutive spans (first, last, rows) of the values of `unit`, each of about slice_rows rows or of one value.

    There are none if one shuffle may hold all rows. `unit` is the day or the month of a sale, so that what is counted here grows
    with the calendar and not with the sales.
    """
    total = row_count(stored)
    if total <= cfg.slice_rows:
        return []
    most = total / math.ceil(total / cfg.slice_rows)
    found: list[tuple[object, object, int]] = []
    for value, n in stored.groupBy(unit.alias("unit")).agg(F.count("*").alias("n")).orderBy("unit").collect():
        if found and found[-1][2] + n <= most * 1.05:
            first, _, rows = found.pop()
            found.append((first, value, rows + n))
        else:
            found.append((value, value, n))
    return found


@dataclass(frozen=True)
class HotBuckets:
    """Hash buckets that hold a hot key, and over how many salts to spread them."""

    ids: tuple[int, ...]
    salts: int

    def __bool__(self) -> bool:
        return bool(self.ids)


def key_bucket(keys: list[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def find_hot_buckets(df: DataFrame, keys: list[str], cfg: RetailConfig) -> HotBuckets:
    """Find buckets that exceed a fair share of one shuffle partition, or the rows of one task.

    The count is by a fixed number of hash buckets, so it reads the key columns
    only and combines on the map side to at most BUCKETS rows per task. The
    share bounds the result: there are at most 1/share hot buckets, which is
    what reaches the driver. It steers the layout of later shuffles and never
    the result.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(key_bucket([F.col(k) for k in keys]).alias("bucket")).agg(
        F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy())
    share = F.greatest(
        F.least(F.lit(1.0 / max(parts, 1)), F.lit(float(cfg.task_rows)) / F.col("total")), F.lit(4.0 / BUCKETS))
    hot = (
        counts.withColumn("total", total).withColumn("share", F.col("total") * share)
        .filter((F.col("total") >= cfg.skew_min_rows) & (F.col("n") > F.col("share")))
        .collect()
    )
    if not hot:
        return HotBuckets((), 1)
    salts = max(math.ceil(r["n"] / r["share"]) for r in hot)
    return HotBuckets(tuple(sorted(r["bucket"] for r in hot)), max(2, salts))


def salted(keys: list[Column], hot: HotBuckets, position: Column) -> Column:
    """Salt for the many side: spread in hot buckets, zero everywhere else.

    The salt follows a row number and not the content, so identical copies are
    spread as well. The row number must be the same on every attempt of a task:
    a stored column, or the position in a scan of stored files.
    """
    return F.when(
        key_bucket(keys).isin(*hot.ids), F.pmod(position, F.lit(hot.salts)),
    ).otherwise(F.lit(0)).cast("bigint")


def lookup(many: DataFrame, one: DataFrame, keys: list[str], cfg: RetailConfig,
           position: str, how: str = "left", scan: DataFrame | None = None,
           bound: DataFrame | None = None) -> DataFrame:
    """Join each row of `many` to the one row of `one` with the same keys.

    A lookup side of checked size is broadcast. A larger one is joined by
    shuffle; keys that are hot on the many side are salted there and their
    lookup rows repeated once per salt. `position` names a stable row number in
    `many`; `scan` is the stored table that its keys come from, if not `many`;
    `bound` the stored table that `one` is taken from, whose rows are counted.
    """
    if is_small(one if bound is None else bound, cfg):
        return many.join(F.broadcast(one), keys, how)
    hot = find_hot_buckets(many if scan is None else scan, keys, cfg)
    if not hot:
        return many.join(one, keys, how)
    cols = [F.col(k) for k in keys]
    left = many.withColumn("_salt", salted(cols, hot, F.col(position)))
    last = F.when(key_bucket(cols).isin(*hot.ids), hot.salts - 1).otherwise(0).cast("bigint")
    right = one.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
