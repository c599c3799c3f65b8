"""Repair, classify, deduplicate and split the landed sales lines."""

from __future__ import annotations

import math
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shopstar.config import RetailConfig
from shopstar.functions.ranking import Spool
from shopstar.functions.scalar import (
    initcap_words, normalise_payment, numeric_text, parse_iso_date, parse_time, trim_to_null, try_to_numeric)
from shopstar.functions.skew import HotBuckets, dealt, find_hot_buckets, key_bucket, row_count, salted
from shopstar.schemas import MARGIN, MONEY_2, MONEY_4, PRICE, RATING, WIDE

LINE_KEY = ["invoice_id", "line_no"]

# Source spellings that stand for a missing customer type.
MISSING_TYPES = ("", "null", "n/a", "unknown")
PAYMENT_METHODS = ("Cash", "Credit card", "Ewallet")

# All numeric source columns; the clean table needs only the first four, as money
# is recomputed from price, quantity and margin.
NUMERIC_COLUMNS = {
    "line_no": "line_no",
    "unit_price": "unit_price",
    "quantity": "quantity",
    "gross_margin_pct": "gross_margin_pct",
    "tax_amount": "tax_amount",
    "total": "total_amount",
    "cogs": "cogs",
    "gross_income": "gross_profit",
}
NEEDED_NUMBERS = ("line_no", "unit_price", "quantity", "gross_margin_pct")
# Those parsed with the texts, so that the generated code of either part stays short.
EARLY_NUMBERS = ("line_no", "gross_margin_pct")


def _first_flag(df: DataFrame, keys: list[str], cfg: RetailConfig) -> Column:
    order = [F.asc_nulls_last("date"), *(F.asc_nulls_last(c) for c in cfg.dedupe_ties)]
    return F.row_number().over(W.partitionBy(*keys).orderBy(*order)) > 1


def dedupe_lines(landed: DataFrame, cfg: RetailConfig, spool: Spool,
                 hot: HotBuckets | None = None,
                 prepare: Callable[[DataFrame], DataFrame] = lambda lines: lines) -> DataFrame:
    """Mark all but the first copy of each (invoice_id, line_no) in `is_duplicate`.

    Ordinary keys need one shuffle. Lines whose key holds a large part of the
    file are first settled within salted sub-groups; only the winner of each
    sub-group, at most one per salt, is then compared over the whole key.
    `prepare` adds columns to every line between the shuffle and the sort.
    """
    if hot is None:
        hot = find_hot_buckets(landed, LINE_KEY, cfg)
    rows = row_count(landed)
    if not hot:
        lines = prepare(dealt(landed, LINE_KEY, rows, cfg))
        return lines.withColumn("is_duplicate", _first_flag(lines, LINE_KEY, cfg))
    key = [F.col(k) for k in LINE_KEY]
    is_hot = key_bucket(key).isin(*hot.ids)
    calm = prepare(dealt(landed.filter(~is_hot), LINE_KEY, rows, cfg))
    calm = calm.withColumn("is_duplicate", _first_flag(calm, LINE_KEY, cfg))
    spread = landed.withColumn("_row", F.monotonically_increasing_id()).filter(is_hot)
    spread = spread.withColumn("_salt", salted(key, hot, F.col("_row"))).drop("_row")
    spread = prepare(dealt(spread, [*LINE_KEY, "_salt"], rows, cfg))
    partial = spool(
        spread.withColumn("is_duplicate", _first_flag(spread, [*LINE_KEY, "_salt"], cfg))
        .drop("_salt"), "dedupe_partial")
    winners = partial.filter(~F.col("is_duplicate")).drop("is_duplicate")
    winners = winners.withColumn("is_duplicate", _first_flag(winners, LINE_KEY, cfg))
    return calm.unionByName(partial.filter("is_duplicate")).unionByName(winners)


def derive_customer_type(customer_id: Column) -> Column:
    """Membership follows from the presence of an id; the source value is ignored."""
    return F.when(trim_to_null(customer_id).isNotNull(), "Member").otherwise("Normal")


def flag_type_repaired(customer_type: Column) -> Column:
    return F.lower(F.trim(F.coalesce(customer_type, F.lit("")))).isin(*MISSING_TYPES)


def conformed_city() -> Column:
    return initcap_words(F.trim("city"))


def is_dirty() -> Column:
    """Any visible defect in the delivered text, duplicates aside.

    The city comes first: what is always evaluated, Spark shares with the conformed city.
    """
    def absent(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    return (
        (absent("city") != F.coalesce(conformed_city(), F.lit("")))
        | (absent("rating") == "")
        | absent("quantity").startswith("-")
        | ~absent("customer_type").isin("Member", "Normal")
        | absent("unit_price").contains("$") | absent("unit_price").contains(",")
        | ~absent("payment").isin("Ewallet", "Credit card", "Cash")
        | ~absent("date").rlike(r"^\d{4}-\d{2}-\d{2}$")
    )


def number_is_oversize(text: Column, number: Column) -> Column:
    """A number in the delivered text that is too large to be parsed; only texts that gave none are looked at again."""
    return F.when(
        number.isNull() & text.isNotNull(), numeric_text(text).try_cast("double").isNotNull()).otherwise(False)


def rating_is_oversize(text: Column) -> Column:
    """Text of a rating that its column cannot hold."""
    return F.when(
        text.try_cast(RATING).isNull() & text.isNotNull(), text.try_cast(WIDE).isNotNull()).otherwise(False)


def stored_values(cfg: RetailConfig) -> Column:
    """What the clean table stores for the numbers of a typed line, NULL where a value does not fit.

    Money is recomputed from price, quantity and margin with all their decimals
    and rounded once.
    """
    c = F.col
    # Cut to the digits that fit anyway, so that products keep their decimals.
    gross = c("unit_price").try_cast("decimal(26,18)") * c("quantity").try_cast("decimal(28,18)")
    margin = c("gross_margin_pct").try_cast(MARGIN) * F.lit(Decimal("0.01"))
    one, tax = F.lit(Decimal(1)), F.lit(cfg.tax_rate)
    values = {
        "line_no": (F.round("line_no"), "int"),
        "quantity": (F.round("quantity"), "int"),
        "unit_price": (F.round("unit_price", 2), PRICE),
        "gross_sales": (F.round(gross, 2), MONEY_2),
        "tax_amount": (F.round(gross * tax, 4), MONEY_4),
        "total_amount": (F.round(gross * (one + tax), 4), MONEY_4),
        "cogs": (F.round(gross * (one - margin), 2), MONEY_2),
        "gross_profit": (F.round(gross * margin, 4), MONEY_4),
        "gross_margin_pct": (c("gross_margin_pct"), MARGIN),
    }
    return F.struct(*[value.try_cast(kind).alias(name) for name, (value, kind) in values.items()])


def does_not_fit() -> Column:
    """A delivered or computed number of a typed line would overflow its column."""
    def lost(name: str, *made_of: str) -> Column:
        there = reduce(Column.__and__, (F.col(m).isNotNull() for m in made_of))
        return there & F.col(f"stored.{name}").isNull()

    found = F.col("is_oversize")
    for name in NEEDED_NUMBERS:
        found = found | lost(name, name)
    for name in ("gross_sales", "tax_amount", "total_amount"):
        found = found | lost(name, "stored.unit_price", "stored.quantity")
    for name in ("cogs", "gross_profit"):
        found = found | lost(name, "stored.unit_price", "stored.quantity", "stored.gross_margin_pct")
    return found


def conformed(landed: DataFrame) -> DataFrame:
    """Adds conformed texts, marks and two numbers of each line, named `_new_...`; what was delivered stays."""
    new = {
        "invoice_id": trim_to_null(F.col("invoice_id")),
        "branch_code": F.upper(F.trim("branch")),
        "city": conformed_city(),
        "customer_id": trim_to_null(F.col("customer_id")),
        "customer_type": derive_customer_type(F.col("customer_id")),
        "customer_type_was_repaired": flag_type_repaired(F.col("customer_type")),
        "gender": initcap_words(F.trim("gender")),
        "product_sku": F.upper(F.trim("product_sku")),
        "product_line": F.trim("product_line"),
        "product_name": F.trim("product_name"),
        "sale_date": parse_iso_date(F.col("date")),
        "sale_time": parse_time(F.col("time")),
        "payment_method": normalise_payment(F.col("payment")),
        "rating": trim_to_null(F.col("rating")).try_cast(RATING),
        "is_dirty": is_dirty(),
        **{c: try_to_numeric(F.col(c)) for c in EARLY_NUMBERS},
    }
    new["is_oversize"] = reduce(
        Column.__or__, (number_is_oversize(F.col(c), new[c]) for c in EARLY_NUMBERS),
        rating_is_oversize(trim_to_null(F.col("rating"))))
    return landed.select("*", *[value.alias(f"_new_{name}") for name, value in new.items()])


def typed(marked: DataFrame) -> DataFrame:
    """Typed and conformed columns; raw text of the disputed ones is kept.

    The texts come from `conformed`, so that the generated code of either part
    stays below the size up to which the JVM compiles a method.
    """
    new = lambda *names: [F.col(f"_new_{n}").alias(n) for n in names]
    late = {c: try_to_numeric(F.col(c)) for c in NEEDED_NUMBERS if c not in EARLY_NUMBERS}
    oversize = reduce(
        Column.__or__, (number_is_oversize(F.col(c), n) for c, n in late.items()), F.col("_new_is_oversize"))
    return marked.select(
        *new("invoice_id", "branch_code", "city", "customer_id", "customer_type",
             "customer_type_was_repaired", "gender", "product_sku", "product_line", "product_name"),
        *[late[c].alias(c) if c in late else F.col(f"_new_{c}").alias(c) for c in NEEDED_NUMBERS],
        *new("sale_date", "sale_time", "payment_method", "rating"),
        F.col("date").alias("source_date"),
        F.col("quantity").alias("source_quantity"),
        F.col("unit_price").alias("source_unit_price"),
        *new("is_dirty"),
        "is_duplicate",
        oversize.alias("is_oversize"),
    )


def classify_reject(cfg: RetailConfig) -> Column:
    """The first reason that applies, to the values as stored; NULL for a good line."""
    c = F.col
    return (
        F.when(c("is_duplicate"), "DUPLICATE_LINE")
        .when(c("invoice_id").isNull(), "MISSING_INVOICE_ID")
        # Not in the original list either: such a line would stop the load.
        .when(does_not_fit(), "VALUE_OUT_OF_RANGE")
        .when(c("line_no").isNull(), "MISSING_LINE_NO")
        .when(c("sale_date").isNull(), "INVALID_DATE")
        .when(~c("sale_date").between(F.lit(cfg.window_start), F.lit(cfg.window_end)),
              "DATE_OUT_OF_RANGE")
        .when(c("quantity").isNull(), "INVALID_QUANTITY")
        .when(c("stored.quantity") <= 0, "NON_POSITIVE_QUANTITY")
        .when(c("unit_price").isNull(), "INVALID_UNIT_PRICE")
        .when(c("stored.unit_price") <= 0, "NON_POSITIVE_UNIT_PRICE")
        .when(c("sale_time").isNull(), "INVALID_TIME")
        # Not in the original list: without a margin, cost and profit are unknown.
        .when(c("gross_margin_pct").isNull(), "INVALID_MARGIN")
    )


def by_line_key(landed: DataFrame, cfg: RetailConfig) -> list[DataFrame]:
    """The lines in slices of about slice_rows; those of one key stay together."""
    n = math.ceil(row_count(landed) / cfg.slice_rows)
    if n < 2:
        return [landed]
    return [landed.filter(F.pmod(F.xxhash64(*LINE_KEY), F.lit(n)) == k) for k in range(n)]


def normalise(landed: DataFrame, cfg: RetailConfig, spool: Spool, hot: HotBuckets | None = None) -> DataFrame:
    marked = dedupe_lines(landed, cfg, spool, hot, conformed)
    return typed(marked).withColumn("stored", stored_values(cfg)).withColumn(
        "reject_reason", classify_reject(cfg))


def quarantine(normalised: DataFrame) -> DataFrame:
    return normalised.filter(F.col("reject_reason").isNotNull()).select(
        "invoice_id",
        F.col("stored.line_no").alias("line_no"),
        "branch_code",
        "reject_reason",
        "source_date",
        "source_quantity",
        "source_unit_price",
        F.current_timestamp().alias("rejected_at"),
    )


def clean_sales(normalised: DataFrame) -> DataFrame:
    """Good lines with their stored values; money is recomputed, not taken from the file."""
    stored = lambda *names: [F.col(f"stored.{n}").alias(n) for n in names]
    return normalised.filter(F.col("reject_reason").isNull()).select(
        "invoice_id",
        *stored("line_no"),
        "branch_code", "city", "customer_id", "customer_type", "customer_type_was_repaired",
        "gender", "product_sku", "product_line", "product_name",
        "sale_date", "sale_time",
        F.substring("sale_time", 1, 2).cast("int").alias("sale_hour"),
        "payment_method",
        *stored("quantity", "unit_price", "gross_sales", "tax_amount", "total_amount", "cogs",
                "gross_profit", "gross_margin_pct"),
        "rating",
    )


SALE_ORDER = ("sale_date", "sale_time", "invoice_id", "line_no")
