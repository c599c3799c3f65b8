"""Column helpers shared by all operators. Everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, Window as W, WindowSpec, functions as F
from pyspark.sql.types import DataType

from shopstar.schemas import PARSED

_WORD_MARK = "\u0001 "


def trim_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def try_to_date(c: Column) -> Column:
    """Text to date, NULL where the text is no date."""
    return c.try_cast("date")


def parse_iso_date(c: Column) -> Column:
    """Only a full yyyy-MM-dd text is read as a date."""
    t = F.trim(c)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), try_to_date(t))


def parse_time(c: Column) -> Column:
    """A valid HH:mm:ss text, else NULL. Kept as text: Spark stores no time of day."""
    t = F.trim(c)
    return F.when(t.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"), t)


def numeric_text(c: Column) -> Column:
    """Drop everything but digits, point and minus."""
    return F.regexp_replace(c, r"[^0-9.\-]", "")


def try_to_numeric(c: Column, kind: DataType = PARSED) -> Column:
    """The number in a text with all its decimals; NULL if there is none."""
    return numeric_text(c).try_cast(kind)


def initcap_words(c: Column) -> Column:
    """Capitalise after every character that is neither letter nor digit.

    Spark's initcap restarts a word only after white space, so a marked space
    is put behind the other separators and taken out again afterwards.
    """
    marked = F.regexp_replace(c, r"([^\p{L}\p{N}\s])", "$1" + _WORD_MARK)
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))


def normalise_payment(c: Column) -> Column:
    """Fold spelling variants of the three known methods."""
    letters = F.regexp_replace(F.lower(F.trim(c)), "[^a-z]", "")
    return (
        F.when(letters == "ewallet", "Ewallet")
        .when(letters == "creditcard", "Credit card")
        .when(letters == "cash", "Cash")
        .otherwise(initcap_words(F.trim(c)))
    )


def date_number(day: Column) -> Column:
    """A date as the number yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def dbl(c: Column) -> Column:
    return c.cast("double")


def ratio(num: Column, den: Column) -> Column:
    """num / den as doubles, NULL when den is zero."""
    return F.try_divide(dbl(num), dbl(den))


def rnd(c: Column, places: int) -> Column:
    """Round a double half away from zero, spelt out so that ties are stable.

    Adding zero turns a negative zero into a plain one.
    """
    scale = F.lit(float(10**places))
    return F.signum(c) * dbl(F.floor(F.abs(c) * scale + F.lit(0.5))) / scale + F.lit(0.0)


def pct(num: Column, den: Column, places: int = 1) -> Column:
    return rnd(F.try_divide(F.lit(100.0) * dbl(num), dbl(den)), places)


def growth_pct(now: Column, before: Column, places: int = 1) -> Column:
    return pct(now - before, before, places)


def mean(c: Column) -> Column:
    """Exact sum over count; Spark's avg of a decimal would round the quotient."""
    return ratio(F.sum(c), F.count(c))


def money(c: Column, places: int = 0) -> Column:
    """Round an exact decimal and hand it out as a double."""
    return dbl(F.round(c, places))


def all_rows() -> WindowSpec:
    """Window over the whole frame; for aggregated rows only."""
    return W.partitionBy()
