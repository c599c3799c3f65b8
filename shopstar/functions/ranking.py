"""Global ranking without pulling all rows into one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

Spool = Callable[[DataFrame, str], DataFrame]

# monotonically_increasing_id keeps the partition above bit 33 and the position
# inside the partition below it.
_POSITION_BITS = 33


def range_sorted(df: DataFrame, *order: Column, tasks: int | None = None, after: int = 0) -> DataFrame:
    """Range partition and sort by `order`, numbering rows in `_pos`, in `tasks` parts if given.

    `after` is the number of parts that rows before these were sorted into, where a
    table is sorted slice by slice.

    The range bounds are drawn over the whole order, so one heavy leading value
    (a busy date, a common frequency) is split over many partitions. `order`
    has to be unique per row. The frame must be written before `_pos` is used.
    """
    return (
        (df.repartitionByRange(tasks, *order) if tasks else df.repartitionByRange(*order))
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id() + F.lit(after << _POSITION_BITS))
    )


def number_rows(stored: DataFrame, name: str, group: list[str] | None = None) -> DataFrame:
    """Turn the stored `_pos` of range_sorted into a dense 1..N row number.

    One count per written partition gives the offsets: a small table whose size
    is the number of partitions (times groups), never the number of rows. With
    `group`, its columns must lead the order and numbering restarts per group.
    """
    group = group or []
    part = F.shiftright("_pos", _POSITION_BITS)
    counts = stored.groupBy(*group, part.alias("_part")).agg(
        F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *group, "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
        F.sum("_n").over(W.partitionBy(*group)).alias("_total"),
    )
    keyed = stored.withColumn("_part", part)
    return (
        keyed.join(F.broadcast(offsets), [*group, "_part"])
        .withColumn(name, F.col("_pos") + F.col("_offset") + F.lit(1))
        .drop("_part", "_pos", "_offset")
    )


def tile(rank: Column, total: Column, k: int) -> Column:
    """NTILE(k) from a dense rank and the number of rows."""
    small = F.floor(total / F.lit(k))
    extra = F.pmod(total, F.lit(k))
    edge = extra * (small + 1)
    return (
        F.when(rank <= edge, F.ceil(rank / (small + 1)))
        .otherwise(extra + F.ceil(F.try_divide(rank - edge, small)))
        .cast("int")
    )


def global_row_number(df: DataFrame, order: list[Column], name: str, spool: Spool) -> DataFrame:
    """ROW_NUMBER over the whole frame through one range shuffle."""
    stored = spool(range_sorted(df, *order), name)
    return number_rows(stored, name).drop("_total")


def global_ntile(df: DataFrame, order: list[Column], k: int, name: str, spool: Spool) -> DataFrame:
    """NTILE(k) over the whole frame through one range shuffle."""
    stored = spool(range_sorted(df, *order), name)
    ranked = number_rows(stored, "_rank")
    return ranked.withColumn(name, tile(F.col("_rank"), F.col("_total"), k)).drop("_rank", "_total")


def running_totals(df: DataFrame, order: list[Column], value: str, spool: Spool) -> DataFrame:
    """Adds `place`, `running` and `total` of `value` in a unique order.

    Every written partition sums its own rows and adds the sum of the partitions
    before it.
    """
    stored = spool(range_sorted(df, *order), f"running_{value}")
    part = F.shiftright("_pos", _POSITION_BITS)
    sums = stored.groupBy(part.alias("_part")).agg(
        F.count("*").alias("_n"), F.min("_pos").alias("_first"), F.sum(value).alias("_sum"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        F.sum("_sum").over(W.partitionBy()).alias("total"),
    )
    own = W.partitionBy("_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    return (
        stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        .withColumns({
            "place": (F.col("_pos") + F.col("_offset") + 1).cast("int"),
            "running": F.sum(value).over(own) + F.col("_before"),
        })
        .drop("_part", "_pos", "_offset", "_before")
    )
