"""Named measures over the star schema, under any grouping and any slicers.

Ratios are built from summed parts. Slicers filter before aggregation; shares
of everything are taken against the unsliced total. Three kinds of measures
read the grouping and the slicers (their context) in a way of their own:

* periods (year to date, last month, trailing months) end with the last date
  that the calendar columns leave, and then take whole periods;
* segment revenue replaces what the context says about the columns it tests;
* customer figures follow columns of the customer tables only, new customers
  calendar columns too, by the date of the first purchase.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shopstar.functions.ranking import running_totals
from shopstar.functions.scalar import all_rows, date_number, dbl, growth_pct, mean, pct, ratio, rnd
from shopstar.functions.skew import is_small, lookup
from shopstar.operators.aggregates import INVOICE_GRAIN, sales, stored_sales
from shopstar.operators.branch import is_peak
from shopstar.operators.common import (
    FIRST_OF, identified, invoice_count, line_count, low_rated_count, rated_count)

# Which dimension a report column comes from, and its key in the fact.
DIMENSIONS = {
    "dim_date": ("date_key", (
        "year_number", "quarter_number", "quarter_name", "month_number", "month_name", "month_abbr",
        "year_month", "month_start_date", "week_of_year", "iso_year_week", "day_of_month",
        "day_of_week", "day_name", "is_weekend", "is_holiday_season", "is_promo_window", "full_date")),
    "dim_branch": ("branch_key", ("branch_code", "branch_name", "city", "region", "size_band")),
    "dim_product": ("product_key", ("sku", "product_name", "product_line", "price_band")),
    "dim_payment": ("payment_key", ("payment_method", "payment_group")),
    "dim_customer": ("customer_key", ("home_city", "home_branch_code", "gender", "cohort_month", "is_member")),
    "dim_customer_rfm": ("customer_key", (
        "rfm_segment", "r_score", "f_score", "m_score", "activity_status", "value_band")),
}
CALENDAR = set(DIMENSIONS["dim_date"][1])
SEGMENT = set(DIMENSIONS["dim_customer_rfm"][1])
MEMBER = set(DIMENSIONS["dim_customer"][1])
REPORT = {c for _, own in DIMENSIONS.values() for c in own}

_rev = "total_amount"


def _amount_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.col(_rev)))


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _at_risk() -> Column:
    return F.col("rfm_segment").isin("At Risk", "Hibernating") & (F.col("m_score") >= 4)


def base_measures(cfg, frame: DataFrame, counted_by: tuple[str, ...] | None = None) -> dict[str, Column]:
    """Measures that are one aggregate expression over the rows of `frame`.

    These are sales lines, or rows of the invoice table. `counted_by` names the
    columns that the invoices are counted by, if the table has marks for them.
    """
    total = F.sum(_rev)
    invoices = F.countDistinct("invoice_id") if counted_by is None else invoice_count(frame, *counted_by)
    peak = is_peak(cfg)

    def rating(cond: Column | None = None) -> Column:
        part = lambda c: F.col(c) if cond is None else F.when(cond, F.col(c))
        if "rated" in frame.columns:
            return ratio(F.sum(part("rating_sum")), F.sum(part("rated")))
        return mean(part("rating"))

    return {
        "total_revenue": dbl(total),
        "gross_profit": dbl(F.sum("gross_profit")),
        "gross_margin_pct": pct(F.sum("gross_profit"), F.sum("gross_sales"), 2),
        "invoices": invoices,
        "line_items": line_count(frame),
        "units_sold": F.sum("quantity"),
        "avg_basket_value": rnd(ratio(total, invoices), 2),
        "avg_rating": rnd(rating(), 3),
        "active_customers": F.countDistinct(F.when(identified(), F.col("customer_key"))),
        "champions_revenue": dbl(F.coalesce(
            _amount_if(F.col("rfm_segment") == "Champions"), F.lit(0))),
        "champions_pct": pct(_amount_if(F.col("rfm_segment") == "Champions"), total, 2),
        "revenue_at_risk": dbl(F.coalesce(_amount_if(_at_risk()), F.lit(0))),
        "peak_hour_revenue": dbl(_amount_if(peak)),
        "peak_hour_revenue_pct": pct(_amount_if(peak), total, 2),
        "peak_hour_rating": rnd(rating(peak), 3),
        "off_peak_rating": rnd(rating(~peak), 3),
        "rating_gap": rnd(rating(~peak) - rating(peak), 3),
        "detractor_pct": pct(low_rated_count(frame), rated_count(frame), 2),
        "revenue_per_trading_day": rnd(ratio(total, F.countDistinct("sale_date")), 2),
    }


MEASURES = (
    "total_revenue", "gross_profit", "gross_margin_pct", "invoices", "line_items", "units_sold",
    "avg_basket_value", "avg_rating", "active_customers", "champions_revenue", "champions_pct",
    "revenue_at_risk", "peak_hour_revenue", "peak_hour_revenue_pct", "peak_hour_rating",
    "off_peak_rating", "rating_gap", "detractor_pct", "revenue_per_trading_day")

# Report columns of which each value stands for one value of a column that invoices are marked by.
_MARKED_BY = {
    "year_number": "sale_year", "year_month": "sale_month", "month_start_date": "sale_month",
    "branch_code": "branch_key", "sale_hour": "sale_hour"}

# What a measure counts distinct values of. Two of these in one aggregate would
# repeat every row, so they are evaluated apart.
_DISTINCT = {
    "invoices": "invoice_id", "avg_basket_value": "invoice_id", "active_customers": "customer_key",
    "revenue_per_trading_day": "sale_date"}


def marked_by(columns: set[str]) -> tuple[str, ...] | None:
    """The columns that invoices are counted by in this context, if the invoice table marks them."""
    if not columns <= set(_MARKED_BY):
        return None
    keys = {_MARKED_BY[c] for c in columns}
    return next((by for by in FIRST_OF if set(by) == keys), None)


# Customer columns that single measures need beyond grouping and slicers.
_NEEDS = {
    "champions_revenue": ("rfm_segment",),
    "champions_pct": ("rfm_segment",),
    "revenue_at_risk": ("rfm_segment", "m_score"),
}
# Columns whose grouping and slicers a measure replaces by its own condition.
_REPLACES = {
    "champions_revenue": {"rfm_segment"},
    "revenue_at_risk": {"rfm_segment", "m_score"},
}
_ADDITIVE = (_rev, "gross_profit", "gross_sales", "quantity")
_FROM_SUMS = {
    "total_revenue", "gross_profit", "gross_margin_pct", "units_sold", "active_customers",
    "revenue_ly", "revenue_yoy_pct", "profit_yoy_pct", *_NEEDS}


def sales_frame(wh, columns: set[str], months_ahead: int = 0, per_customer: bool = False,
                keys: Sequence[str] = (), counted: bool = False) -> DataFrame:
    """Sales with the report columns asked for; only their dimensions are joined.

    With `months_ahead`, calendar columns are those of the date so many months
    later, which puts last year's sales under this year's label. `per_customer`
    sums the additive columns per customer, `keys` and other dimension keys
    first: one row of those meets the customer-sized table, not every line.
    `counted` says that invoices will be counted, for which the invoice table is built.
    """
    # The invoice table does unless products, payments or other columns of a line are asked for.
    apart = columns - REPORT | columns & {*DIMENSIONS["dim_product"][1], *DIMENSIONS["dim_payment"][1]}
    if apart <= set(INVOICE_GRAIN):
        source = wh.fact_invoices if counted else stored_sales(wh)
    else:
        source = wh.fact_sales
    frame = source.withColumn("_at", F.xxhash64("invoice_id"))
    if months_ahead:
        later = date_number(F.add_months("sale_date", months_ahead))
        frame = frame.withColumn("date_key", later)
    if per_customer:
        frame = frame.groupBy(*dict.fromkeys(("customer_key", *keys, *(
            key for key, own in DIMENSIONS.values() if columns & set(own))))).agg(
            *[F.sum(c).alias(c) for c in _ADDITIVE])
    for table, (key, own) in DIMENSIONS.items():
        wanted = sorted(columns & set(own))
        if not wanted:
            continue
        stored = wh.table(table)
        how = "left" if table == "dim_customer_rfm" else "inner"
        if per_customer:
            frame = frame.join(stored.select(key, *wanted), key, how)
        elif table == "dim_date":
            # The month joins along, so that a calendar slicer skips month folders.
            month = F.add_months("month_start_date", -months_ahead).alias("sale_month")
            frame = frame.join(
                F.broadcast(stored.select(key, month, *wanted)), [key, "sale_month"])
        else:
            frame = lookup(frame, stored.select(key, *wanted), [key], wh.cfg, "_at", how,
                           source, stored)
    return frame


def _sums_suffice(names: Sequence[str], columns: set[str]) -> bool:
    """Sums per customer answer these measures under these columns."""
    return bool(columns & SEGMENT) and columns <= REPORT and set(names) <= _FROM_SUMS


def _sliced(frame: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """A slicer holds one value or a list of chosen values."""
    for column, value in filters.items():
        chosen = value if isinstance(value, (list, tuple, set)) else [value]
        frame = frame.filter(F.col(column).isin(*chosen))
    return frame


def _without(context: Mapping[str, object], gone: set[str]) -> dict[str, object]:
    return {c: v for c, v in context.items() if c not in gone}


def _beside(out: DataFrame, other: DataFrame, by: Sequence[str]) -> DataFrame:
    """The columns of `other` beside the groups of `out`; a NULL label meets a NULL label."""
    added = [c for c in other.columns if c not in by]
    if not by:
        row = other.select(F.struct(*added)).scalar()
        return out.withColumn("_row", row).select("*", "_row.*").drop("_row")
    named = other.select(*[F.col(c).alias(f"_by_{c}") for c in by], *added)
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    return out.join(named, same, "left").drop(*[f"_by_{c}" for c in by])


def measures(wh, names: Sequence[str], by: Sequence[str] = (),
             filters: Mapping[str, object] | None = None) -> DataFrame:
    """Evaluate measures for every group that has sales under the slicers.

    `by` and the keys of `filters` are report columns (DIMENSIONS) or columns of
    the fact. The result holds the groups, the measures and `_rev`, the revenue.
    """
    filters, by = dict(filters or {}), list(by)
    context = {*by, *filters}
    known = {*MEASURES, *LAST_YEAR, *PERIODS, *CUSTOMER, "new_customers"}
    if unknown := set(names) - known:
        raise KeyError(f"no such measure: {sorted(unknown)}")
    if unknown := context - REPORT - set(wh.fact_sales.columns):
        raise KeyError(f"no such report column: {sorted(unknown)}")
    apart = {n for n in names if _REPLACES.get(n, set()) & context}
    if "champions_pct" in names and context & SEGMENT:
        apart.add("champions_pct")
    out = _sales(wh, [n for n in names if n not in {*apart, *PERIODS, *CUSTOMER, "new_customers"}],
                 by, filters)

    def replaced(name: str, gone: set[str], alias: str) -> tuple[DataFrame, list[str]]:
        groups = [c for c in by if c not in gone]
        part = _sales(wh, [name], groups, _without(filters, gone))
        return part.select(*groups, F.col(name).alias(alias)), groups

    for n in sorted(apart - {"champions_pct"}):
        out = _beside(out, *replaced(n, _REPLACES[n], n))
    if "champions_pct" in apart:
        out = _beside(out, *replaced("champions_revenue", {"rfm_segment"}, "_best"))
        out = _beside(out, *replaced("total_revenue", SEGMENT, "_whole"))
        out = out.withColumn("champions_pct", pct(F.col("_best"), F.col("_whole"), 2))
    if periods := [n for n in names if n in PERIODS]:
        out = _beside(out, _periods(wh, periods, by, filters), by)
    if figures := [n for n in names if n in CUSTOMER]:
        out = _beside(out, *_customers(wh, figures, by, filters))
    if "new_customers" in names:
        out = _beside(out, *_new_customers(wh, by, filters))
        out = out.withColumn("new_customers", F.coalesce("new_customers", F.lit(0)))
    return out.select(*by, *names, "_rev")


def _sales(wh, names: Sequence[str], by: Sequence[str], filters: Mapping[str, object]) -> DataFrame:
    """Measures that are one aggregate over sales, and against last year; adds `_rev`."""
    yearly = [n for n in names if n in LAST_YEAR]
    plain = [n for n in names if n in MEASURES]
    columns = {*by, *filters, *(c for n in plain for c in _NEEDS.get(n, ()))}
    folded = _sums_suffice(names, columns)
    counted = any(_DISTINCT.get(n) == "invoice_id" for n in plain)

    def sums(months_ahead: int, chosen: Sequence[str], extra: Sequence[Column]) -> DataFrame:
        frame = _sliced(sales_frame(wh, columns, months_ahead, folded, counted=counted), filters)
        by_marks = marked_by(columns) if "lines" in frame.columns else None
        base = base_measures(wh.cfg, frame, by_marks)
        return frame.groupBy(*by).agg(*[base[n].alias(n) for n in chosen], *extra)

    uncounted = marked_by(columns) is not None and not folded
    kinds = {n: _DISTINCT[n] for n in plain if n in _DISTINCT and not (uncounted and _DISTINCT[n] == "invoice_id")}
    first, *others = sorted(set(kinds.values())) or [None]
    now = [F.sum(_rev).alias("_rev"), *([F.sum("gross_profit").alias("_profit")] if yearly else [])]
    out = sums(0, [n for n in plain if kinds.get(n, first) == first], now)
    for kind in others:
        out = _beside(out, sums(0, [n for n in plain if kinds.get(n) == kind], []), by)
    if yearly:
        before = sums(12, [], [
            F.sum(_rev).alias("_rev_ly"), F.sum("gross_profit").alias("_profit_ly")])
        out = _beside(out, before, by).withColumns({n: LAST_YEAR[n]() for n in yearly})
    return out.select(*by, *names, "_rev")


LAST_YEAR: dict[str, Callable[[], Column]] = {
    "revenue_ly": lambda: dbl(F.col("_rev_ly")),
    "revenue_yoy_pct": lambda: growth_pct(F.col("_rev"), F.col("_rev_ly"), 2),
    "profit_yoy_pct": lambda: growth_pct(F.col("_profit"), F.col("_profit_ly"), 2),
}


def total_revenue_unsliced(wh) -> Column:
    return sales(wh).agg(F.sum(_rev)).scalar()


def revenue_share(wh) -> Column:
    """Part of all revenue, whatever the slicers."""
    return pct(F.col("_rev"), total_revenue_unsliced(wh), 2)


def dense_place() -> Column:
    """Rank among the selected groups, equal revenue sharing a place."""
    return F.dense_rank().over(W.orderBy(F.desc("_rev")))


def standing(wh, groups: DataFrame, bound: DataFrame) -> DataFrame:
    """Adds dense `place`, `running` revenue with ties included, and `total`.

    Groups of equal revenue share a level; a catalogue beyond the checked size
    sums the levels partition by partition instead of in one window.
    """
    if is_small(bound, wh.cfg):
        frame = W.orderBy(F.desc("_rev")).rangeBetween(W.unboundedPreceding, 0)
        return groups.withColumns({
            "place": dense_place(),
            "running": F.sum("_rev").over(frame),
            "total": F.sum("_rev").over(all_rows()),
        })
    levels = groups.groupBy("_rev").agg(F.sum("_rev").alias("level"))
    return groups.join(
        running_totals(levels, [F.desc("_rev")], "level", wh.spool).drop("level"),
        "_rev")


def done(df: DataFrame, *order: Column | str) -> DataFrame:
    return df.drop("_rev").orderBy(*order) if order else df.drop("_rev")


# --- measures that need more than one row of sales ---------------------------


def time_measures(wh) -> DataFrame:
    """Monthly revenue against earlier periods; months are matched by distance.

    Sales are read once and summed per day. Each day is then handed to the
    months whose last three or twelve months hold it, thirteen at the most.
    """
    c = F.col
    days = sales(wh).groupBy("date_key").agg(
        F.sum(_rev).alias("rev"), F.sum("gross_profit").alias("profit"))
    days = days.join(F.broadcast(wh.dim_date.select(
        "date_key", "full_date", "month_start_date")), "date_key")
    later = F.sequence(
        c("month_start_date"), F.add_months("month_start_date", 12), F.expr("interval 1 month"))
    spread = days.select("*", F.explode(later).alias("month"))
    end = F.last_day("month")
    own = c("month") == c("month_start_date")
    last3 = F.when(c("full_date") > F.add_months(end, -3), c("rev"))
    last12 = F.when(c("full_date") > F.add_months(end, -12), c("rev"))
    months = spread.groupBy("month").agg(
        F.sum(F.when(own, c("rev"))).alias("rev"),
        F.sum(F.when(own, c("profit"))).alias("profit"),
        rnd(mean(last3), 2).alias("revenue_3m_avg"),
        dbl(F.sum(last12)).alias("revenue_rolling_12m"),
    ).filter(c("rev").isNotNull())
    months = months.withColumn("no", F.year("month") * 12 + F.month("month"))
    line = W.orderBy("no")

    def ago(column: str, n: int) -> Column:
        return F.max(column).over(line.rangeBetween(-n, -n))

    ytd = F.sum("rev").over(W.partitionBy(F.year("month")).orderBy("no"))
    return months.withColumn("ytd", ytd).select(
        F.date_format("month", "yyyy-MM").alias("year_month"),
        dbl(c("rev")).alias("total_revenue"),
        dbl(ago("rev", 12)).alias("revenue_ly"),
        growth_pct(c("rev"), ago("rev", 12), 2).alias("revenue_yoy_pct"),
        dbl(c("ytd")).alias("revenue_ytd"),
        dbl(ago("ytd", 12)).alias("revenue_ly_ytd"),
        growth_pct(c("rev"), ago("rev", 1), 2).alias("revenue_mom_pct"),
        growth_pct(c("profit"), ago("profit", 12), 2).alias("profit_yoy_pct"),
        "revenue_3m_avg",
        "revenue_rolling_12m",
    ).orderBy("year_month")


# What a period measure sums: the dates of the context itself, those a month
# earlier, the year to its last date, that a year earlier, and trailing months.
_NOW, _MONTH_BEFORE, _TO_DATE, _TO_DATE_LY, _LAST_3, _LAST_12 = (1 << i for i in range(6))


def _day_if(span: int) -> Column:
    return F.when(F.col("_spans").bitwiseAND(span) != 0, F.col("_day"))


def _total(span: int) -> Column:
    return F.sum(_day_if(span))


PERIODS: dict[str, tuple[int, Callable[[], Column]]] = {
    "revenue_ytd": (_TO_DATE, lambda: dbl(_total(_TO_DATE))),
    "revenue_ly_ytd": (_TO_DATE_LY, lambda: dbl(_total(_TO_DATE_LY))),
    "revenue_mom_pct": (
        _NOW | _MONTH_BEFORE, lambda: growth_pct(_total(_NOW), _total(_MONTH_BEFORE), 2)),
    "revenue_3m_avg": (_LAST_3, lambda: rnd(mean(_day_if(_LAST_3)), 2)),
    "revenue_rolling_12m": (_LAST_12, lambda: dbl(_total(_LAST_12))),
}


def _spans(wh, labels: Sequence[str], filters: Mapping[str, object], wanted: int) -> DataFrame:
    """For each group of calendar labels the dates that its periods hold, as bits.

    A date is of the period a month or a year earlier if it falls into the
    period when moved by that; so the 29th of February belongs to the 28th. The
    table grows with the years of the calendar only.
    """
    calendar, c = wh.dim_date, F.col
    own = _sliced(calendar, filters).select(*labels, c("full_date").alias("_on"))
    ends = own.groupBy(*labels).agg(F.max("_on").alias("_end"))

    def back_to(first: Column) -> DataFrame:
        return ends.select(*labels, F.explode(F.sequence(first, "_end")).alias("_on"))

    def earlier(dates: DataFrame, months: int) -> DataFrame:
        moved = calendar.select(
            c("full_date").alias("_from"), F.add_months("full_date", months).alias("_on"))
        return dates.join(moved, "_on").select(*labels, c("_from").alias("_on"))

    def trailing(months: int) -> DataFrame:
        return back_to(F.date_add(F.add_months("_end", -months), 1))

    to_date = back_to(F.trunc("_end", "year"))
    dates = {
        _NOW: own, _MONTH_BEFORE: earlier(own, 1), _TO_DATE: to_date,
        _TO_DATE_LY: earlier(to_date, 12), _LAST_3: trailing(3), _LAST_12: trailing(12)}
    every = reduce(DataFrame.unionByName, [
        found.withColumn("_spans", F.lit(span)) for span, found in dates.items() if span & wanted])
    keys = calendar.select(
        c("full_date").alias("_on"), "date_key", c("month_start_date").alias("sale_month"))
    return every.groupBy(*labels, "_on").agg(F.bit_or("_spans").alias("_spans")).join(keys, "_on").drop("_on")


def _periods(wh, names: Sequence[str], by: Sequence[str], filters: Mapping[str, object]) -> DataFrame:
    """Period measures: sales summed per day, each day met by the periods that hold it."""
    labels = [c for c in by if c in CALENDAR]
    others = [c for c in by if c not in CALENDAR]
    own = _without(filters, CALENDAR)
    columns = {*others, *own}
    day = ["date_key", "sale_month"]
    frame = sales_frame(wh, columns, per_customer=_sums_suffice((), columns), keys=day)
    days = _sliced(frame, own).groupBy(*others, *day).agg(F.sum(_rev).alias("_day"))
    chosen = {c: v for c, v in filters.items() if c in CALENDAR}
    spans = _spans(wh, labels, chosen, reduce(lambda x, y: x | y, [PERIODS[n][0] for n in names]))
    return days.join(spans, day).groupBy(*by).agg(*[PERIODS[n][1]().alias(n) for n in names])


CUSTOMER: dict[str, Callable[[], Column]] = {
    "customer_lifetime_value": lambda: rnd(mean(F.col("lifetime_revenue")), 2),
    "repeat_customer_pct": lambda: pct(_count_if(F.col("lifetime_orders") > 1), F.count("*"), 2),
    "avg_days_since_purchase": lambda: rnd(mean(F.col("recency_days")), 2),
}


def _with_columns_of(wh, table: str, customers: DataFrame, columns: set[str]) -> DataFrame:
    """Customers with those report columns that another customer table has."""
    wanted = sorted(columns & set(DIMENSIONS[table][1]))
    if not wanted:
        return customers
    return customers.join(wh.table(table).select("customer_key", *wanted), "customer_key", "left")


def _customers(wh, names: Sequence[str], by: Sequence[str],
               filters: Mapping[str, object]) -> tuple[DataFrame, list[str]]:
    """Figures of scored customers, by and under columns of the customer tables."""
    groups = [c for c in by if c in SEGMENT | MEMBER]
    own = {c: v for c, v in filters.items() if c in SEGMENT | MEMBER}
    frame = _with_columns_of(wh, "dim_customer", wh.dim_customer_rfm, {*groups, *own})
    return _sliced(frame, own).groupBy(*groups).agg(
        *[CUSTOMER[n]().alias(n) for n in names]), groups


def _new_customers(wh, by: Sequence[str],
                   filters: Mapping[str, object]) -> tuple[DataFrame, list[str]]:
    """Customers by calendar columns of their first purchase, not of the sale."""
    ours = SEGMENT | MEMBER | CALENDAR
    groups = [c for c in by if c in ours]
    own = {c: v for c, v in filters.items() if c in ours}
    columns = {*groups, *own}
    firsts = wh.dim_customer.filter(F.col("first_purchase_date").isNotNull())
    frame = _with_columns_of(wh, "dim_customer_rfm", firsts, columns)
    if dates := sorted(columns & CALENDAR):
        days = wh.dim_date.select(F.col("full_date").alias("first_purchase_date"), *dates)
        frame = frame.join(F.broadcast(days), "first_purchase_date")
    return _sliced(frame, own).groupBy(*groups).agg(F.count("*").alias("new_customers")), groups


def customer_value(wh) -> DataFrame:
    """Lifetime value, share of repeat customers and mean days since purchase."""
    return _customers(wh, list(CUSTOMER), (), {})[0].select(
        "customer_lifetime_value", "repeat_customer_pct", "avg_days_since_purchase")


def new_customers(wh) -> DataFrame:
    """Customers by the year of their first purchase."""
    return _new_customers(wh, ["year_number"], {})[0]
