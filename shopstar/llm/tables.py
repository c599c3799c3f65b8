"""Reading the corpus tables and storing intermediate ones."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopstar.sources.store import remove_folder, shared_folder, write_table


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def beside(docs: DataFrame, needed: Sequence[str], added: Sequence[str],
           work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`docs` with the columns that `work` adds to a frame of the `needed` ones.

    All other columns travel in one struct, so their names cannot clash with
    those that `work` uses; an own column that has the name of an added one is
    replaced.
    """
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    others = [c for c in docs.columns if c not in needed]
    done = work(docs.select(
        *needed, F.struct(*[F.col(quoted(c)) for c in others] or [F.lit(0).alias("none")]).alias("_beside")))
    return done.select(
        *[F.col(c) if c in needed else F.col("_beside").getField(c).alias(c)
          for c in docs.columns if c not in added],
        *added)


def aside(docs: DataFrame, *needed: str) -> DataFrame:
    """The `needed` columns, and all others in a struct _own."""
    others = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c not in needed]
    return docs.select(*needed, F.struct(*others or [F.lit(0).alias("none")]).alias("_own"))


def restored(df: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of `docs` from a frame made of aside(), some of them changed."""
    at_top = set(df.columns) - {"_own"}
    own = set(df.schema["_own"].dataType.fieldNames())
    return df.select(*[
        changed[c].alias(c) if c in changed
        else F.col("_own").getField(c).alias(c) if c in own or c not in at_top else F.col(c)
        for c in docs.columns])


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


class Spool:
    """Intermediate tables of one operator call, on storage that all executors share.

    A stored table cuts lineage: when an executor is lost, later steps read it
    again instead of repeating what led to it. Folders are never reused.
    """

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/corpus/{operator}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return write_table(df, self.path(name))

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        for name in names:
            remove_folder(self.spark, self.path(name))
