"""Declared schemas. Landing columns are all text so that bad values survive."""

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column order of the delivered files.
SALES_LANDING = _text(
    "invoice_id", "line_no", "branch", "city", "customer_id", "customer_type",
    "gender", "product_sku", "product_line", "product_name", "unit_price",
    "quantity", "tax_pct", "tax_amount", "total", "date", "time", "payment",
    "cogs", "gross_margin_pct", "gross_income", "rating",
)
CUSTOMERS_LANDING = _text("customer_id", "signup_date", "gender", "home_branch", "home_city")
PRODUCTS_LANDING = _text("sku", "product_line", "product_name", "base_price", "margin_pct")
BRANCHES_LANDING = _text("branch_code", "city", "region", "opened_date", "size_factor")

MONEY_2 = T.DecimalType(12, 2)
MONEY_4 = T.DecimalType(12, 4)
PRICE = T.DecimalType(10, 2)
RATING = T.DecimalType(3, 1)
MARGIN = T.DecimalType(23, 18)
# Numbers as delivered; they are rounded once, to the scale of their column.
PARSED = T.DecimalType(38, 18)
WIDE = T.DecimalType(38, 4)  # tells a rating that does not fit from text that is none

FACT_COLUMNS = {
    "sale_id": "bigint",
    "invoice_id": "string",
    "line_no": "int",
    "sale_date": "date",
    "date_key": "int",
    "sale_time": "string",
    "sale_hour": "int",
    "branch_key": "int",
    "product_key": "int",
    "customer_key": "bigint",
    "payment_key": "int",
    "customer_type": "string",
    "gender": "string",
    "quantity": "int",
    "unit_price": "decimal(10,2)",
    "gross_sales": "decimal(12,2)",
    "tax_amount": "decimal(12,4)",
    "total_amount": "decimal(12,4)",
    "cogs": "decimal(12,2)",
    "gross_profit": "decimal(12,4)",
    "rating": "decimal(3,1)",
    "sale_month": "date",
}


def assert_schema(df, expected: dict[str, str], what: str) -> None:
    actual = dict(df.dtypes)
    if actual != expected:
        wrong = {c: (actual.get(c), expected.get(c))
                 for c in {*actual, *expected} if actual.get(c) != expected.get(c)}
        raise ValueError(f"{what}: columns differ from the declared schema: {wrong}")
