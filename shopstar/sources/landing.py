"""Readers of the delivered files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shopstar import schemas


@dataclass(frozen=True)
class Landing:
    """The four delivered tables, all columns text."""

    sales: DataFrame
    customers: DataFrame
    products: DataFrame
    branches: DataFrame


def read_landing_csv(spark: SparkSession, path: str, schema: StructType,
                     line_breaks: bool = False) -> DataFrame:
    """Read a delivered CSV with header as text; unquoted empty fields become NULL.

    Columns are matched by position; the check of the header against the
    declared names makes a file in another column order fail instead of load.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("quote", '"').option("escape", '"')
        .option("multiLine", line_breaks)
        .csv(path)
    )


def write_landing_csv(rows: DataFrame, path: str) -> None:
    """Deliver rows as read_landing_csv takes them: a header, quotes doubled, blanks kept."""
    (
        rows.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_landing(spark: SparkSession, folder: str, line_breaks: bool = False) -> Landing:
    """The four files of a delivery.

    With `line_breaks`, quoted fields may span lines; a file is then read by one
    task as a whole, so large deliveries should come as many files.
    """
    def read(name: str, schema: StructType) -> DataFrame:
        return read_landing_csv(spark, f"{folder}/{name}.csv", schema, line_breaks)

    return Landing(
        sales=read("sales", schemas.SALES_LANDING),
        customers=read("customers", schemas.CUSTOMERS_LANDING),
        products=read("products", schemas.PRODUCTS_LANDING),
        branches=read("branches", schemas.BRANCHES_LANDING),
    )
