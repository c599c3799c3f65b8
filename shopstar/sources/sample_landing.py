"""Projects the supplied star tables into the dirty text shape of the landing files.

Only expressions that any SQL engine evaluates alike are used, so that the
same landing rows can be rebuilt elsewhere for comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.skew import lookup
from shopstar.schemas import SALES_LANDING
from shopstar.sources.landing import Landing


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def _code(c: Column) -> Column:
    return F.concat(F.lit("B"), _two(c))


def _customer_code(c: Column) -> Column:
    return F.concat(F.lit("CUST-"), F.lpad(c.cast("string"), 7, "0"))


def _proper(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 100)))


def _opened(nation: Column) -> Column:
    """Stores 20 to 24 open on 1 June of 1996 to 2000, the others on day one."""
    return F.when(nation < 20, F.make_date(F.lit(1995), F.lit(1), F.lit(1))).otherwise(
        F.make_date(nation - 24 + 2000, F.lit(6), F.lit(1)))


def _by_priority(priority: Column, wallet: str, card: str, cash: str) -> Column:
    return (
        F.when(priority.isin("1", "2"), wallet)
        .when(priority.isin("3", "4"), card)
        .otherwise(cash)
    )


def _orders(orders: DataFrame) -> DataFrame:
    key, buyer = F.col("o_orderkey"), F.col("o_custkey")
    priority = F.substring("o_orderpriority", 1, 1)
    anonymous = (F.pmod(key, F.lit(2)) == 0) | (F.pmod(buyer, F.lit(10)) == 0)
    day = F.to_date("o_orderdate")
    return orders.select(
        key.alias("l_orderkey"),
        day.alias("day"),
        day.cast("string").alias("date"),
        F.when(~anonymous, _customer_code(buyer)).alias("customer_id"),
        F.when(anonymous, "Normal").otherwise("Member").alias("kind"),
        F.when(F.pmod(buyer, F.lit(2)) == 0, "Female").otherwise("Male").alias("gender"),
        F.concat(
            (F.pmod(key * 7, F.lit(11)) + 10).cast("string"), F.lit(":"),
            _two(F.pmod(key * 3, F.lit(60))), F.lit(":00")).alias("time"),
        _by_priority(priority, "Ewallet", "Credit card", "Cash").alias("paid"),
        _by_priority(priority, "E-Wallet", "CREDIT CARD", "Cash ").alias("paid_60"),
        _by_priority(priority, "e wallet", "CREDIT CARD", "Cash ").alias("paid_61"),
        _by_priority(priority, "EWALLET", "creditcard", "Cash ").alias("paid_62"),
    )


def _parts(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")


def _of_part() -> dict[str, Column]:
    line = F.pmod(F.substring("p_brand", 7, 10).cast("int"), F.lit(6))
    return {
        "product_sku": F.upper("p_brand"),
        "product_line": F.concat(F.lit("Line "), line.cast("string")),
        "product_name": F.col("p_brand"),
        "gross_margin_pct": (F.lit(12) + line * 4).cast("string"),
    }


def _stores(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    return supplier.join(nation, F.col("s_nationkey") == key).select(
        F.col("s_suppkey").alias("l_suppkey"), key, "n_name")


def _of_store() -> dict[str, Column]:
    key = F.col("n_nationkey")
    return {"branch": _code(key), "city": _proper(F.col("n_name")), "opened": _opened(key)}


def sales(spark: SparkSession, sf_dir: str, cfg: RetailConfig) -> DataFrame:
    """One landing row per order line, with planted defects.

    While the sides are too large to be sent everywhere, each join deals the lines
    anew. So the texts of an order are worked out on its side and joined last, and
    of parts and suppliers only what their texts are made of travels with a line.
    The columns l_partkey and l_suppkey ride along to settle ties between copies
    of a line.
    """
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    scan = read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = scan.withColumn("_row", F.monotonically_increasing_id())
    for one, key in (
        (_parts(read("part")), "l_partkey"),
        (_stores(read("supplier"), read("nation")), "l_suppkey"),
        (_orders(read("orders")), "l_orderkey"),
    ):
        lines = lookup(lines, one, [key], cfg, "_row", "inner", scan)
    c = F.col
    lines = lines.withColumns(_of_part() | _of_store()).filter(c("day") >= c("opened")).withColumns({
        "cents": F.floor(c("l_extendedprice") * 100.0 / c("l_quantity") + 0.5).cast("bigint"),
        "k": F.pmod(c("l_orderkey") * 7 + c("l_linenumber") * 13 + c("l_partkey"), F.lit(1000)),
        "rt": F.pmod(c("l_partkey") * 13 + c("l_orderkey") * 7 + c("l_linenumber"), F.lit(91)),
        "units": c("l_quantity").cast("int").cast("string"),
    }).withColumns({
        "whole": F.floor(c("cents") / 100).cast("bigint"),
        "point": F.concat(F.lit("."), _two(F.pmod(c("cents"), F.lit(100)))),
    })

    k, whole = c("k"), c("whole")
    plain = F.concat(whole.cast("string"), c("point"))
    grouped = F.when(
        whole >= 1000,
        F.concat(F.floor(whole / 1000).cast("string"), F.lit(","),
                 F.lpad(F.pmod(whole, F.lit(1000)).cast("string"), 3, "0"), c("point")),
    ).otherwise(plain)
    nothing = F.lit(None).cast("string")
    row = {
        "invoice_id": c("l_orderkey").cast("string"),
        "line_no": c("l_linenumber").cast("string"),
        "city": F.when(k == 20, F.upper("city"))
        .when(k == 21, F.concat(F.lit("  "), F.lower("city")))
        .when(k.between(22, 25), F.concat(F.lit(" "), c("city"), F.lit(" ")))
        .otherwise(c("city")),
        "customer_type": F.when(k == 40, "").when(k == 41, "NULL").when(k == 42, "n/a")
        .when(k.between(43, 44), "unknown").otherwise(c("kind")),
        "unit_price": F.when(k.between(50, 53), F.concat(F.lit("$"), grouped)).otherwise(plain),
        "quantity": F.when(k.between(10, 13), F.concat(F.lit("-"), c("units"))).otherwise(c("units")),
        "tax_pct": F.lit("0.05"),
        "tax_amount": nothing,
        "total": nothing,
        "date": F.when(k == 30, "1900-01-01").when(k == 31, "15/03/1998").when(k == 32, nothing)
        .when(k == 33, "1998-02-30").otherwise(c("date")),
        "payment": F.when(k == 60, c("paid_60")).when(k == 61, c("paid_61"))
        .when(k == 62, c("paid_62")).otherwise(c("paid")),
        "cogs": nothing,
        "gross_income": nothing,
        "rating": F.when(k >= 8, F.concat(
            (F.floor(c("rt") / 10) + 1).cast("string"), F.lit("."),
            F.pmod(c("rt"), F.lit(10)).cast("string"))),
    }
    return lines.select(
        *(row.get(name, c(name)).alias(name) for name in SALES_LANDING.names),
        "l_partkey", "l_suppkey")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return (
        spark.read.parquet(f"{sf_dir}/customer.parquet")
        .join(spark.read.parquet(f"{sf_dir}/nation.parquet"), nation == F.col("n_nationkey"))
        .select(
            _customer_code(key).alias("customer_id"),
            F.date_add(F.lit("1995-01-01").cast("date"), F.pmod(key, F.lit(365)).cast("int"))
            .cast("string").alias("signup_date"),
            F.when(F.pmod(key, F.lit(2)) == 0, "Female").otherwise("Male").alias("gender"),
            _code(nation).alias("home_branch"),
            _proper(F.col("n_name")).alias("home_city"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    bn = F.substring("p_brand", 7, 10).cast("int")
    tenths = bn * 35 + 100
    return (
        spark.read.parquet(f"{sf_dir}/part.parquet").select("p_brand").distinct()
        .select(
            F.upper("p_brand").alias("sku"),
            F.concat(F.lit("Line "), F.pmod(bn, F.lit(6)).cast("string")).alias("product_line"),
            F.col("p_brand").alias("product_name"),
            F.concat(F.floor(tenths / 10).cast("string"), F.lit("."),
                     F.pmod(tenths, F.lit(10)).cast("string"), F.lit("0")).alias("base_price"),
            (F.lit(12) + F.pmod(bn, F.lit(6)) * 4).cast("string").alias("margin_pct"),
        )
    )


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    nk = F.col("n_nationkey")
    return (
        spark.read.parquet(f"{sf_dir}/nation.parquet")
        .join(spark.read.parquet(f"{sf_dir}/region.parquet"),
              F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _code(nk).alias("branch_code"),
            _proper(F.col("n_name")).alias("city"),
            F.col("r_name").alias("region"),
            _opened(nk).cast("string").alias("opened_date"),
            F.concat(F.floor((nk * 7 % 50 + 70) / 100).cast("string"), F.lit("."),
                     _two((nk * 7 % 50 + 70) % 100)).alias("size_factor"),
        )
    )


def sample_landing(spark: SparkSession, sf_dir: str, cfg: RetailConfig) -> Landing:
    return Landing(
        sales=sales(spark, sf_dir, cfg),
        customers=customers(spark, sf_dir),
        products=products(spark, sf_dir),
        branches=branches(spark, sf_dir),
    )
