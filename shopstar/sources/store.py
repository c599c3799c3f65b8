"""Stored tables: three layers of Parquet below one shared folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopstar.schemas import FACT_COLUMNS, assert_schema

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which driver and executors share."""
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        raise RuntimeError(
            f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    return folder.rstrip("/")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one; a missing folder is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


# While tables are built: the shuffle files of a job are removed as it ends, not when the
# driver happens to collect its garbage; the stored layers are packed more tightly, and read
# in smaller pieces, so that a task still has as many rows.
SPARING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}
READ_BYTES = "spark.sql.files.maxPartitionBytes"
MOST_READ_BYTES = 32 << 20


@contextmanager
def sparing_disk(spark: SparkSession) -> Iterator[None]:
    """Jobs inside leave no shuffle files behind and write small tables; the session's settings come back after."""
    read_bytes = min(MOST_READ_BYTES, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    settings = SPARING | {READ_BYTES: str(read_bytes)}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def write_table(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_slices(slices: Iterable[DataFrame], path: str) -> DataFrame:
    """One table of frames of the same columns, written one after the other."""
    schema = None
    for k, part in enumerate(slices):
        part.write.mode("append" if k else "overwrite").parquet(path)
        schema, spark = part.schema, part.sparkSession
    return spark.read.schema(schema).parquet(path)


def write_fact_flat(fact: DataFrame, path: str) -> DataFrame:
    """The control copy: the same rows without month folders and in no order, as a plain heap would hold them."""
    heap = fact.repartition(F.xxhash64(F.lit("heap"), "sale_id"))
    return write_table(heap, path)


def write_invoices(invoices: DataFrame, path: str) -> DataFrame:
    """The invoice table by months, so that calendar slicers skip folders; busy months take several tasks.

    `invoices` should be stored: a range shuffle reads its input twice.
    """
    order = ["sale_month", "invoice_id", "branch_key", "sale_date"]
    (
        invoices.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode("overwrite").partitionBy("sale_month").parquet(path)
    )
    return invoices.sparkSession.read.schema(invoices.schema).parquet(path)


def write_index(fact: DataFrame, key: str, path: str) -> DataFrame:
    """(key, sale_month) of all sales, sorted by key over all files, so that a lookup opens one of them."""
    pairs = fact.select(key, "sale_month").distinct()
    return write_table(pairs.repartitionByRange(key, "sale_month").sortWithinPartitions(key, "sale_month"), path)


def write_fact_partitioned(
        fact: DataFrame, path: str, by_date: bool = False, months: Sequence[tuple] = ()) -> DataFrame:
    """One folder per month; inside, rows sorted by customer and invoice.

    `by_date` says that the rows still come in runs of dates, as the clean table
    is stored: then every task holds a few months, a busy month is spread over
    several tasks already, and each only sorts its own rows. Otherwise a range
    shuffle over the whole sort order does this. The sort keeps the min/max of a
    Parquet row group narrow for lookups of one customer. Which row groups can hold
    an invoice or a customer is told by their dictionaries, or by Bloom filters
    where there are too many keys for one.

    `months` are spans (first, last, rows) of months to be dealt one after the other.
    """
    assert_schema(fact, FACT_COLUMNS, "fact_sales")
    order = ["sale_month", "customer_key", "invoice_id", "line_no"]
    parts = [fact.filter(F.col("sale_date").between(first, F.last_day(F.lit(last)))) for first, last, _ in months]
    for k, part in enumerate(parts or [fact]):
        dealt = part if by_date else part.repartitionByRange(*order)
        writer = dealt.sortWithinPartitions(*order).write.mode("append" if k else "overwrite").partitionBy("sale_month")
        for column in ("invoice_id", "customer_key"):
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path)
    return fact.sparkSession.read.schema(fact.schema).parquet(path)


def write_cube(cube: DataFrame, path: str) -> DataFrame:
    """One folder per level and year; large ones are written by several tasks."""
    order = ["level", "sale_year", "sale_date", "key"]
    (
        cube.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode("overwrite").partitionBy("level", "sale_year").parquet(path)
    )
    return cube.sparkSession.read.schema(cube.schema).parquet(path)


def date_range(fact: DataFrame, first: Column, last: Column) -> DataFrame:
    """Sales from `first` to `last`; the month bound is what prunes folders."""
    if "sale_year" in fact.columns:  # a cube, stored by years
        fact = fact.filter(F.col("sale_year").between(F.year(first), F.year(last)))
    return fact.filter(
        F.col("sale_date").between(first, last)
        & F.col("sale_month").between(F.trunc(first, "month"), last)
    )
