"""Views of single cleaning, key and calendar steps over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopstar.config import RetailConfig
from shopstar.functions import scalar as s
from shopstar.operators import clean, dims
from shopstar.operators.dims import UNKNOWN_KEY



def _values(landed: DataFrame, *by) -> DataFrame:
    return landed.groupBy(*by).agg(F.count("*").alias("n"))


def try_to_date(landed: DataFrame) -> DataFrame:
    return _values(landed, "date").select(
        "date", s.try_to_date(F.col("date")).alias("parsed"), "n")


def parse_iso_date(landed: DataFrame) -> DataFrame:
    return _values(landed, "date").select(
        "date", s.parse_iso_date(F.col("date")).alias("parsed"), "n")


def try_to_numeric(landed: DataFrame) -> DataFrame:
    return _values(landed, "unit_price").select(
        "unit_price", s.dbl(s.try_to_numeric(F.col("unit_price"))).alias("parsed"), "n")


def parse_time(landed: DataFrame) -> DataFrame:
    return _values(landed, "time").select(
        "time", s.parse_time(F.col("time")).alias("parsed"), "n")


def dedupe_lines(normalised: DataFrame) -> DataFrame:
    """Which delivered line was kept and which ones were set aside."""
    return normalised.select(
        "invoice_id", s.dbl(F.col("line_no")).alias("line_no"), "product_sku", "branch_code",
        "source_date", "source_unit_price", "source_quantity",
        F.col("is_duplicate").cast("int").alias("is_duplicate"))


def trim_to_null(landed: DataFrame) -> DataFrame:
    def filled(c: str):
        return F.count(s.trim_to_null(F.col(c))).alias(c)

    return landed.groupBy("branch").agg(
        F.count("*").alias("n"), filled("invoice_id"), filled("customer_id"), filled("rating"))


def conform_codes(landed: DataFrame) -> DataFrame:
    return _values(landed, F.upper(F.trim("branch")).alias("branch_code"),
                   F.upper(F.trim("product_sku")).alias("product_sku"))


def conform_city_gender(landed: DataFrame) -> DataFrame:
    return _values(landed, "city", "gender").select(
        F.col("city").alias("delivered"),
        s.initcap_words(F.trim("city")).alias("city"),
        s.initcap_words(F.trim("gender")).alias("gender"), "n")


def derive_customer_type(landed: DataFrame) -> DataFrame:
    return _values(landed, F.col("customer_type").alias("delivered"),
                   clean.derive_customer_type(F.col("customer_id")).alias("customer_type"))


def flag_type_repaired(landed: DataFrame) -> DataFrame:
    return _values(landed, F.col("customer_type").alias("delivered")).select(
        "delivered", clean.flag_type_repaired(F.col("delivered")).cast("int").alias("repaired"),
        "n")


def normalise_payment(landed: DataFrame) -> DataFrame:
    return _values(landed, "payment").select(
        F.col("payment").alias("delivered"),
        s.normalise_payment(F.col("payment")).alias("payment_method"), "n")


def parse_numerics(landed: DataFrame) -> DataFrame:
    """Per branch: how many texts of each numeric column parse, and their sum."""
    parsed = landed.select("branch", *(
        s.try_to_numeric(F.col(src)).alias(dst) for src, dst in clean.NUMERIC_COLUMNS.items()))
    aggs = []
    for c in clean.NUMERIC_COLUMNS.values():
        aggs += [F.count(c).alias(f"{c}_parsed"), s.dbl(F.sum(c)).alias(f"{c}_sum")]
    return parsed.groupBy("branch").agg(*aggs)


def classify_reject(normalised: DataFrame) -> DataFrame:
    return _values(normalised, F.coalesce("reject_reason", F.lit("CLEAN")).alias("reason"))


def clean_sales(stg_sales: DataFrame) -> DataFrame:
    money = ("unit_price", "gross_sales", "tax_amount", "total_amount", "cogs", "gross_profit",
             "gross_margin_pct", "rating")
    return stg_sales.withColumns({
        **{c: s.dbl(F.col(c)) for c in money},
        "customer_type_was_repaired": F.col("customer_type_was_repaired").cast("int"),
    })


def single_pass_split(normalised: DataFrame) -> DataFrame:
    bad = F.col("reject_reason").isNotNull()
    return normalised.groupBy("branch_code").agg(
        F.count("*").alias("delivered"),
        F.count(F.when(~bad, 1)).alias("clean"),
        F.count(F.when(bad, 1)).alias("rejected"))


def generated_series(fact: DataFrame, stg_sales: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Every month from the first to the last sale, with its lines, also if none."""
    bounds = dims.sales_bounds(stg_sales, cfg)
    months = bounds.select(F.explode(F.sequence(
        F.trunc("first_day", "month"), F.trunc("last_day", "month"),
        F.expr("interval 1 month"))).alias("sale_month"))
    lines = fact.groupBy("sale_month").agg(F.count("*").alias("lines"))
    return months.join(lines, "sale_month", "left").select(
        "sale_month", F.coalesce("lines", F.lit(0)).alias("lines")).orderBy("sale_month")


def promo_windows(fact: DataFrame, cfg: RetailConfig) -> DataFrame:
    """The declared campaigns with the sales that fell on their days."""
    days = fact.groupBy("sale_date").agg(
        F.count("*").alias("lines"), F.sum("total_amount").alias("rev"))
    windows = F.explode(F.array(*(
        F.struct(F.lit(m).alias("month"), F.lit(d).alias("first_day"), F.lit(n).alias("span"))
        for m, d, n in cfg.promo_windows))).alias("w")
    start = F.make_date(F.year("sale_date"), F.col("w.month"), F.col("w.first_day"))
    inside = (F.col("sale_date") >= start) & (
        F.col("sale_date") < F.date_add(start, F.col("w.span")))
    return days.select("*", windows).filter(inside).groupBy("w.month", "w.first_day", "w.span").agg(
        F.count("*").alias("days"), F.sum("lines").alias("lines"),
        s.dbl(F.sum("rev")).alias("revenue")).orderBy("month", "first_day")


def promo_days(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sales days with their campaign flag."""
    days = fact.groupBy("date_key").agg(F.count("*").alias("lines"))
    return days.join(F.broadcast(dim_date), "date_key").select(
        "date_key", F.col("is_promo_window").cast("int").alias("is_promo_window"), "lines")


def calendar(dim_date: DataFrame) -> DataFrame:
    flags = ("is_weekend", "is_holiday_season", "is_promo_window")
    return dim_date.withColumns({c: F.col(c).cast("int") for c in flags})


def branches(dim_branch: DataFrame) -> DataFrame:
    return dim_branch.withColumns({
        "size_factor": s.dbl(F.col("size_factor")), "is_active": F.col("is_active").cast("int")})


def products(dim_product: DataFrame) -> DataFrame:
    return dim_product.withColumns({
        c: s.dbl(F.col(c)) for c in ("base_price", "margin_pct")})


def customers(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.withColumn("is_member", F.col("is_member").cast("int"))


def global_rank(fact: DataFrame) -> DataFrame:
    return fact.select("sale_id", "sale_date", "sale_time", "invoice_id", "line_no")


def resolve_keys(fact: DataFrame) -> DataFrame:
    """Lines per resolved store, product and payment key, and those left unknown."""
    return fact.groupBy("branch_key", "product_key", "payment_key").agg(
        F.count("*").alias("lines"),
        F.count(F.when(F.col("customer_key") == UNKNOWN_KEY, 1)).alias("anonymous_lines"),
        F.sum("customer_key").alias("customer_key_sum"))


def fact_rows(fact: DataFrame) -> DataFrame:
    money = ("unit_price", "gross_sales", "tax_amount", "total_amount", "cogs", "gross_profit",
             "rating")
    return fact.drop("sale_month").withColumns({c: s.dbl(F.col(c)) for c in money})


def outside_window(fact: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Rows in and out of the declared months, per month."""
    inside = F.col("sale_date").between(F.lit(cfg.window_start), F.lit(cfg.window_end))
    return fact.groupBy("sale_month").agg(
        F.count(F.when(inside, 1)).alias("rows_inside"),
        F.count(F.when(~inside, 1)).alias("rows_outside"))


def rfm_rows(rfm: DataFrame) -> DataFrame:
    return rfm.withColumns({
        c: s.dbl(F.col(c))
        for c in ("monetary", "profit", "lifetime_revenue", "lifetime_profit", "fm_score")
        if c in rfm.columns})
