"""Every constant of the warehouse in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date
from decimal import Decimal


@dataclass(frozen=True)
class BenchPoints:
    """Literals used by the six timed layout queries and the covering scan."""

    month: date = date(2024, 7, 1)
    year: int = 2024
    customer_key: int = 17342
    invoice_date: date = date(2023, 6, 15)
    quarter_start: date = date(2024, 10, 1)
    branch_key: int = 5


@dataclass(frozen=True)
class SignalPoints:
    """What the signal checks look for in the loaded data."""

    dip_year: int = 2020
    rebound_year: int = 2021
    gaining_line: str = "Electronic accessories"
    losing_line: str = "Home and lifestyle"
    affinity_pair: tuple[str, str] = ("ELE-001", "ELE-003")


@dataclass(frozen=True)
class RetailConfig:
    window_start: date = date(2019, 1, 1)
    window_end: date = date(2024, 12, 31)
    tax_rate: Decimal = Decimal("0.05")

    # Recurring campaigns as (month, first day, number of days).
    promo_windows: tuple[tuple[int, int, int], ...] = (
        (11, 24, 4),
        (12, 26, 6),
        (1, 2, 5),
        (4, 13, 5),
        (7, 7, 3),
    )

    # Columns that settle which copy of a duplicated line is kept, after the
    # date. The default uses the delivered values, so the choice never depends
    # on the order in which files are read.
    dedupe_ties: tuple[str, ...] = (
        "unit_price", "quantity", "product_sku", "time", "branch",
        "customer_id", "payment", "gross_margin_pct", "rating", "city",
        "gender", "customer_type", "product_line", "product_name",
    )

    small_below: Decimal = Decimal("0.85")
    medium_below: Decimal = Decimal("1.05")
    abc_a: float = 0.80
    abc_b: float = 0.95
    season_peak: float = 115.0
    season_above: float = 100.0
    season_below: float = 92.0
    share_years: tuple[int, int, int] = (2019, 2021, 2024)
    rank_years: tuple[int, int, int] = (2019, 2022, 2024)
    cohort_cutoff: date = date(2024, 1, 1)
    cohort_months: tuple[int, ...] = (1, 2, 3, 6, 12, 24)
    retention_horizon: int = 24
    min_pair_baskets: int = 200
    top_pairs: int = 20
    top_line_pairs: int = 10
    peak_from: int = 18
    peak_to: int = 20
    rolling_days: int = 28
    tail_days: int = 120
    slicer_year: int = 2024
    slicer_region: str = "Yangon"
    slicer_lines: tuple[str, ...] = ("Electronic accessories", "Food and beverages")
    slicer_branch: str = "A"
    bench: BenchPoints = field(default_factory=BenchPoints)
    signals: SignalPoints = field(default_factory=SignalPoints)

    # Physical limits. A lookup table is broadcast only up to this row count;
    # beyond it the join shuffles, with hot keys spread over salted copies.
    broadcast_rows: int = 200_000
    # Below this many rows nothing can be hot enough to be worth salting.
    skew_min_rows: int = 5_000_000
    # From there on, no shuffle of sales lines leaves more rows than this to one task.
    task_rows: int = 500_000
    # Nor more than this to one shuffle of whole lines, whose files lie on local disks while it runs.
    slice_rows: int = 100_000_000
    # Baskets wider than this are counted in blocks of this many products.
    basket_block: int = 64
    # So many blocks of one basket meet as many others in one task.
    basket_side: int = 64

    def with_(self, **changes) -> "RetailConfig":
        return replace(self, **changes)


def sample_config() -> RetailConfig:
    """Parameters that fit the supplied 1995-2001 test tables."""
    return RetailConfig(
        window_start=date(1995, 1, 1),
        window_end=date(2001, 7, 31),
        dedupe_ties=("l_partkey", "l_suppkey", "unit_price", "quantity"),
        share_years=(1995, 1997, 2000),
        rank_years=(1995, 1997, 2000),
        cohort_cutoff=date(2000, 1, 1),
        slicer_year=2000,
        slicer_region="Asia",
        slicer_lines=("Line 1", "Line 2"),
        slicer_branch="B05",
        bench=BenchPoints(
            month=date(2000, 7, 1),
            year=2000,
            customer_key=700,
            invoice_date=date(1999, 6, 15),
            quarter_start=date(2000, 10, 1),
            branch_key=5,
        ),
        signals=SignalPoints(
            dip_year=1998,
            rebound_year=1999,
            gaining_line="Line 1",
            losing_line="Line 4",
            affinity_pair=("BRAND#1", "BRAND#3"),
        ),
    )
