"""Hand-made landing rows: each reject reason, repairs and awkward numbers."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopstar import schemas
from shopstar.config import RetailConfig
from shopstar.functions import scalar as s
from shopstar.operators import clean, quality
from shopstar.sources.store import write_table

GOOD = {
    "invoice_id": "123-45-6789", "line_no": "1", "branch": "a", "city": " YANGON ",
    "customer_id": "CUST-000001", "customer_type": "unknown", "gender": "female",
    "product_sku": " ele-001", "product_line": "Electronic accessories",
    "product_name": "Cable", "unit_price": "$1,234.50", "quantity": "2", "tax_pct": "0.05",
    "date": "2022-05-06", "time": "10:05:00", "payment": "E-Wallet",
    "gross_margin_pct": "20.0", "rating": "9.1",
}


def landed(spark, *changes):
    rows = []
    for i, change in enumerate(changes):
        row = {**GOOD, "invoice_id": f"inv-{i}", **change}
        rows.append(tuple(row.get(c) for c in schemas.SALES_LANDING.names))
    return spark.createDataFrame(rows, schemas.SALES_LANDING)


def spooler(tmp_path):
    return lambda df, name: write_table(df, str(tmp_path / name))


def normalised(spark, tmp_path, *changes, cfg=RetailConfig()):
    return clean.normalise(landed(spark, *changes), cfg, spooler(tmp_path))


def test_reasons_in_order_of_precedence(spark, tmp_path):
    cases = [
        ({}, None),
        ({"invoice_id": "  "}, "MISSING_INVOICE_ID"),
        ({"line_no": "x"}, "MISSING_LINE_NO"),
        ({"date": "15/03/2022"}, "INVALID_DATE"),
        ({"date": None}, "INVALID_DATE"),
        ({"date": "2022-02-30"}, "INVALID_DATE"),
        ({"date": "1900-01-01"}, "DATE_OUT_OF_RANGE"),
        ({"quantity": "abc"}, "INVALID_QUANTITY"),
        ({"quantity": "-3"}, "NON_POSITIVE_QUANTITY"),
        ({"quantity": "0"}, "NON_POSITIVE_QUANTITY"),
        ({"unit_price": ""}, "INVALID_UNIT_PRICE"),
        ({"unit_price": "--1"}, "INVALID_UNIT_PRICE"),
        ({"unit_price": "0.00"}, "NON_POSITIVE_UNIT_PRICE"),
        ({"time": "25:00:00"}, "INVALID_TIME"),
        ({"time": "9:00:00"}, "INVALID_TIME"),
        ({"gross_margin_pct": None}, "INVALID_MARGIN"),
        ({"date": "2031-07-14", "quantity": "-1"}, "DATE_OUT_OF_RANGE"),
        ({"line_no": "", "time": "x"}, "MISSING_LINE_NO"),
        ({"unit_price": "500000000"}, "VALUE_OUT_OF_RANGE"),
        ({"quantity": "3000000000"}, "VALUE_OUT_OF_RANGE"),
        ({"line_no": "5000000000"}, "VALUE_OUT_OF_RANGE"),
        ({"line_no": "99999999999999"}, "VALUE_OUT_OF_RANGE"),
        ({"unit_price": "99999999", "quantity": "2000"}, "VALUE_OUT_OF_RANGE"),
        ({"gross_margin_pct": "200000"}, "VALUE_OUT_OF_RANGE"),
        ({"rating": "100.5"}, "VALUE_OUT_OF_RANGE"),
        ({"unit_price": "1" + "0" * 25}, "VALUE_OUT_OF_RANGE"),
        ({"unit_price": "1.2.3"}, "INVALID_UNIT_PRICE"),
        ({"quantity": "0.4"}, "NON_POSITIVE_QUANTITY"),
        ({"unit_price": "0.004"}, "NON_POSITIVE_UNIT_PRICE"),
    ]
    out = normalised(spark, tmp_path, *(
        {**change, "product_name": str(i)} for i, (change, _) in enumerate(cases)))
    got = {int(r["product_name"]): r["reject_reason"] for r in out.collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(cases)}


def test_repairs(spark, tmp_path):
    stg = clean.clean_sales(normalised(
        spark, tmp_path, {}, {"customer_id": " ", "customer_type": "Member"}))
    a, b = stg.orderBy("invoice_id").collect()
    assert (a.branch_code, a.city, a.gender, a.product_sku) == ("A", "Yangon", "Female", "ELE-001")
    assert (a.customer_type, a.customer_type_was_repaired) == ("Member", True)
    assert (b.customer_type, b.customer_id, b.customer_type_was_repaired) == ("Normal", None, False)
    assert (a.payment_method, a.sale_hour, a.quantity) == ("Ewallet", 10, 2)
    assert a.unit_price == Decimal("1234.50") and a.gross_sales == Decimal("2469.00")
    assert a.tax_amount == Decimal("123.4500") and a.total_amount == Decimal("2592.4500")
    assert a.cogs == Decimal("1975.20") and a.gross_profit == Decimal("493.8000")


def test_numbers_are_rounded_once(spark, tmp_path):
    """Against exact arithmetic: half away from zero, from all decimals of the delivered numbers."""
    from decimal import ROUND_HALF_UP

    cases = [("1.00495", "1", "12.345678"), ("10.00", "2.49996", "20"), ("2.00495", "2.4", "12.345678"),
             ("$1,234.567891", "3", "33.333333333"), ("0.00500", "7", "-5.5"), ("19.99", "3", "100")]
    out = clean.clean_sales(normalised(spark, tmp_path, *(
        {"unit_price": p, "quantity": q, "gross_margin_pct": m} for p, q, m in cases)))
    rows = {int(r.invoice_id[4:]): r for r in out.collect()}
    assert len(rows) == len(cases)
    for i, (price, quantity, margin) in enumerate(cases):
        p, q, m = Decimal(price.strip("$").replace(",", "")), Decimal(quantity), Decimal(margin) / 100
        to = lambda x, places: x.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)
        r = rows[i]
        assert (r.unit_price, r.quantity, r.gross_margin_pct) == (to(p, 2), int(to(q, 0)), m * 100)
        assert (r.gross_sales, r.tax_amount, r.total_amount) == (
            to(p * q, 2), to(p * q * Decimal("0.05"), 4), to(p * q * Decimal("1.05"), 4))
        assert (r.cogs, r.gross_profit) == (to(p * q * (1 - m), 2), to(p * q * m, 4))
    assert (rows[0].unit_price, rows[1].quantity) == (Decimal("1.00"), 2)


def test_duplicates_are_set_aside_not_dropped(spark, tmp_path):
    rows = [{"invoice_id": "x", "date": d} for d in (None, "2022-05-07", "2022-05-06")]
    rows += [{"invoice_id": None, "line_no": "7"}] * 2
    out = normalised(spark, tmp_path, *rows)
    assert out.count() == 5
    kept = out.filter("not is_duplicate").collect()
    assert {(r["source_date"], r["reject_reason"]) for r in kept} == {
        ("2022-05-06", None), ("2022-05-06", "MISSING_INVOICE_ID")}


@pytest.mark.parametrize("text,value", [
    ("(5)", "5"), ("1e5", "15"), ("abc", None), ("--1", None), ("", None), ("$1,234.50", "1234.5"),
    (" 12 ", "12"), ("-7", "-7"), ("1.2.3", None)])
def test_numbers(spark, text, value):
    got = spark.range(1).select(s.try_to_numeric(F.lit(text)).alias("v")).first().v
    assert got == (None if value is None else Decimal(value))


@pytest.mark.parametrize("text,want", [
    ("o'neil mc-donald", "O'Neil Mc-Donald"), ("NEW  YORK", "New  York"), ("nation_7", "Nation_7"),
    ("4TH street", "4th Street")])
def test_initcap(spark, text, want):
    assert spark.range(1).select(s.initcap_words(F.lit(text)).alias("v")).first().v == want


@pytest.mark.parametrize("text,want", [
    ("e wallet", "Ewallet"), ("E-Wallet", "Ewallet"), ("CREDIT CARD", "Credit card"),
    ("Cash ", "Cash"), ("gift card", "Gift Card"), (None, None)])
def test_payment(spark, text, want):
    col = F.lit(text).cast("string")
    assert spark.range(1).select(s.normalise_payment(col).alias("v")).first().v == want


def test_empty_landing(spark, tmp_path):
    empty = spark.createDataFrame([], schemas.SALES_LANDING)
    out = clean.normalise(empty, RetailConfig(), spooler(tmp_path))
    assert out.count() == 0 and clean.clean_sales(out).count() == 0


def test_split_keeps_every_row(spark, tmp_path):
    out = normalised(spark, tmp_path, {}, {"quantity": "-1"}, {"date": "x"}, {})
    n = clean.clean_sales(out).count() + clean.quarantine(out).count()
    assert n == out.count() == 4
    by_reason = {r.reject_reason: r.rows_rejected
                 for r in quality.reject_counts(clean.quarantine(out)).collect()}
    assert by_reason == {"NON_POSITIVE_QUANTITY": 1, "INVALID_DATE": 1}
