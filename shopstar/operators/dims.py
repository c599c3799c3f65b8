"""The five dimensions. All but the calendar start with an Unknown member, key -1."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.ranking import Spool, global_ntile, global_row_number
from shopstar.functions.scalar import date_number, initcap_words

UNKNOWN_KEY = -1

# Natural keys that must be unique, as a lookup by them may not repeat a sale.
NATURAL_KEYS = {
    "dim_branch": "branch_code",
    "dim_product": "sku",
    "dim_customer_static": "customer_id",
    "dim_payment": "payment_method",
}


class DuplicateKeyError(RuntimeError):
    """A dimension holds the same natural key twice."""


def assert_unique(dim: DataFrame, key: str) -> None:
    twice = dim.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1).take(3)
    if twice:
        raise DuplicateKeyError(f"{key} not unique: {[r[key] for r in twice]}")


def sales_bounds(stg_sales: DataFrame, cfg: RetailConfig) -> DataFrame:
    """One row: first and last sale, or the reporting window if there is none."""
    return stg_sales.agg(
        F.coalesce(F.min("sale_date"), F.lit(cfg.window_start)).alias("first_day"),
        F.coalesce(F.max("sale_date"), F.lit(cfg.window_end)).alias("last_day"),
    )


def days_between(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    return bounds.select(F.explode(F.sequence(first, last)).alias("full_date"))


def is_promo_day(day: Column, cfg: RetailConfig) -> Column:
    """Campaigns recur each year and do not run over a year end."""
    def inside(month: int, first: int, span: int) -> Column:
        start = F.make_date(F.year(day), F.lit(month), F.lit(first))
        return (day >= start) & (day < F.date_add(start, span))

    return reduce(Column.__or__, (inside(*w) for w in cfg.promo_windows), F.lit(False))


def dim_date(bounds: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Full calendar years from the year before the first sale to two after the last."""
    first = F.make_date(F.year("first_day") - 1, F.lit(1), F.lit(1))
    last = F.make_date(F.year("last_day") + 2, F.lit(12), F.lit(31))
    d = F.col("full_date")
    weekday = F.weekday(d) + 1
    return days_between(bounds, first, last).select(
        date_number(d).alias("date_key"),
        d,
        F.day(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "E").alias("day_abbr"),
        (weekday >= 6).alias("is_weekend"),
        F.weekofyear(d).alias("week_of_year"),
        F.format_string("%04d-W%02d", F.extract(F.lit("YEAROFWEEK"), d), F.weekofyear(d))
        .alias("iso_year_week"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_abbr"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.quarter(d).alias("quarter_number"),
        F.format_string("%04d-Q%d", F.year(d), F.quarter(d)).alias("quarter_name"),
        F.year(d).alias("year_number"),
        F.dayofyear(d).alias("day_of_year"),
        F.month(d).isin(11, 12).alias("is_holiday_season"),
        is_promo_day(d, cfg).alias("is_promo_window"),
    )


def with_unknown(members: DataFrame, **values) -> DataFrame:
    """Put the Unknown member first; columns not given are NULL in it."""
    spark = members.sparkSession
    row = spark.range(1).select(*(
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in members.schema))
    return row.unionByName(members)


def dim_branch(branches: DataFrame, cfg: RetailConfig, spool: Spool) -> DataFrame:
    size = F.col("size_factor").try_cast("decimal(4,2)")
    code = F.upper(F.trim("branch_code"))
    city = initcap_words(F.trim("city"))
    keyed = global_row_number(branches, [F.asc("branch_code")], "branch_key", spool)
    members = keyed.select(
        F.col("branch_key").cast("int").alias("branch_key"),
        code.alias("branch_code"),
        F.concat(F.lit("Branch "), code, F.lit(" - "), city).alias("branch_name"),
        city.alias("city"),
        initcap_words(F.trim("region")).alias("region"),
        F.col("opened_date").try_cast("date").alias("opened_date"),
        size.alias("size_factor"),
        F.when(size < cfg.small_below, "Small").when(size < cfg.medium_below, "Medium")
        .otherwise("Large").alias("size_band"),
        F.lit(True).alias("is_active"),
    )
    return with_unknown(
        members, branch_key=UNKNOWN_KEY, branch_code="UNK", branch_name="Unknown Branch",
        city="Unknown", region="Unknown", size_band="Unknown", is_active=False)


def dim_product(products: DataFrame, cfg: RetailConfig, spool: Spool) -> DataFrame:
    price = F.col("base_price").try_cast("decimal(10,2)")
    keyed = global_row_number(products, [F.asc("sku")], "product_key", spool)
    thirds = global_ntile(keyed, [price.asc_nulls_last(), F.asc("sku")], 3, "third", spool)
    members = thirds.select(
        F.col("product_key").cast("int").alias("product_key"),
        F.upper(F.trim("sku")).alias("sku"),
        F.trim("product_name").alias("product_name"),
        F.trim("product_line").alias("product_line"),
        price.alias("base_price"),
        F.col("margin_pct").try_cast("decimal(6,4)").alias("margin_pct"),
        F.when(F.col("third") == 1, "Budget").when(F.col("third") == 2, "Mid")
        .otherwise("Premium").alias("price_band"),
    )
    return with_unknown(
        members, product_key=UNKNOWN_KEY, sku="UNKNOWN", product_name="Unknown Product",
        product_line="Unknown", price_band="Unknown")


def dim_payment(stg_sales: DataFrame, cfg: RetailConfig, spool: Spool) -> DataFrame:
    method = F.col("payment_method")
    found = spool(stg_sales.select("payment_method").distinct(), "payment_methods")
    keyed = global_row_number(found, [F.asc("payment_method")], "payment_key", spool)
    members = keyed.select(
        F.col("payment_key").cast("int").alias("payment_key"),
        "payment_method",
        F.when(method == "Cash", "Cash").when(method == "Credit card", "Card")
        .when(method == "Ewallet", "Digital").otherwise("Other").alias("payment_group"),
    )
    return with_unknown(
        members, payment_key=UNKNOWN_KEY, payment_method="Unknown", payment_group="Unknown")


def dense_key(customers: DataFrame, spool: Spool) -> DataFrame:
    """Surrogate keys 1..N in customer id order, without a single-task sort."""
    return global_row_number(customers, [F.asc("customer_id")], "customer_key", spool)


def dim_customer_static(customers: DataFrame, spool: Spool) -> DataFrame:
    members = dense_key(customers, spool).select(
        "customer_key",
        F.trim("customer_id").alias("customer_id"),
        initcap_words(F.trim("gender")).alias("gender"),
        F.col("signup_date").try_cast("date").alias("signup_date"),
        F.upper(F.trim("home_branch")).alias("home_branch_code"),
        initcap_words(F.trim("home_city")).alias("home_city"),
        F.lit(True).alias("is_member"),
    )
    return with_unknown(
        members, customer_key=UNKNOWN_KEY, customer_id="ANONYMOUS", is_member=False)


def customer_activity(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("customer_key") != UNKNOWN_KEY).groupBy("customer_key").agg(
        F.min("sale_date").alias("first_purchase_date"),
        F.max("sale_date").alias("last_purchase_date"),
    )


def customer_enrich(static: DataFrame, fact: DataFrame) -> DataFrame:
    """Adds observed behaviour; members without a purchase keep NULLs."""
    return static.join(customer_activity(fact), "customer_key", "left").select(
        "customer_key", "customer_id", "gender", "signup_date", "home_branch_code", "home_city",
        "first_purchase_date", "last_purchase_date",
        F.trunc("first_purchase_date", "month").alias("cohort_month"),
        "is_member",
    )


def never_activated(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.filter(
        F.col("is_member") & F.col("first_purchase_date").isNull()
    ).agg(F.count("*").alias("never_activated"))
