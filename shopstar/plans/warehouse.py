"""Builds the warehouse tables in order and hands them to the operators."""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopstar import schemas
from shopstar.config import RetailConfig, sample_config
from shopstar.operators import aggregates, baskets, clean, dims, fact, product, quality, rfm, semantic
from shopstar.functions.ranking import range_sorted
from shopstar.functions.skew import find_hot_buckets, is_small, row_count, spans, task_count
from shopstar.sources import store
from shopstar.sources.landing import Landing, read_landing_csv, write_landing_csv
from shopstar.sources.sample_landing import sample_landing

RAW, STAGING, MARTS = "raw", "staging", "marts"

# Tables in build order with their layer.
TABLES = {
    "branches_landing": RAW,
    "products_landing": RAW,
    "customers_landing": RAW,
    "sales_landing": RAW,
    "normalised": STAGING,
    "stg_sales_rejects": STAGING,
    "stg_sales_sorted": STAGING,
    "dim_date": MARTS,
    "dim_branch": MARTS,
    "dim_product": MARTS,
    "dim_payment": MARTS,
    "dim_customer_static": MARTS,
    "fact_sales": MARTS,
    "fact_invoices": MARTS,
    "daily_cube": MARTS,
    "invoice_index": MARTS,
    "customer_index": MARTS,
    "dim_customer": MARTS,
    "rfm_base": STAGING,
    "customer_rfm": STAGING,
    "dim_customer_rfm": MARTS,
    "cohort_counts": MARTS,
    "basket_masks": STAGING,
    "pair_counts": MARTS,
    "line_pair_counts": MARTS,
    "sku_shares": MARTS,
    "load_audit": STAGING,
    "dq_results": STAGING,
}

# Tables that tell in which months a key has sales.
INDEXES = {"invoice_index": "invoice_id", "customer_index": "customer_key"}


class Warehouse:
    """Tables are written on first use and read back, which also cuts lineage."""

    def __init__(self, spark: SparkSession, landing: Landing, folder: str, cfg: RetailConfig):
        self.spark = spark
        self.landing = landing
        self.folder = folder
        self.cfg = cfg
        self.timings: dict[str, float] = {}
        self._built: dict[str, DataFrame] = {}
        self._noted: list[str] = []
        self._scratch: list[str] = []
        self._delivered = False
        self._lock = threading.RLock()

    def table(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._built:
                started = time.perf_counter()
                before = sum(self.timings.values())
                outer, self._scratch = self._scratch, []
                try:
                    with store.sparing_disk(self.spark):
                        self._built[name] = self._build(name)
                    self.clear_spool()
                finally:
                    self._scratch = outer + self._scratch
                self._note_hops(name)
                inner = sum(self.timings.values()) - before
                self.timings[name] = time.perf_counter() - started - inner
            return self._built[name]

    def has(self, name: str) -> bool:
        """Whether the table is stored already."""
        with self._lock:
            return name in self._built

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES or name == "fact_sales_flat":
            return self.table(name)
        raise AttributeError(name)

    @property
    def stg_sales(self) -> DataFrame:
        return self.stg_sales_sorted.drop("_pos")

    def _note_hops(self, name: str) -> None:
        """Write the audit rows of the steps that the table ends; a load that fails keeps them."""
        trail = f"{self.folder}/{STAGING}/load_trail"
        for audit_id, hop in enumerate(quality.HOPS, 1):
            if hop.after == name:
                if not self._noted:
                    store.remove_folder(self.spark, trail)
                path = f"{trail}/{audit_id:02d}"
                store.write_table(quality.hop_row(audit_id, self._built[name]), path)
                self._noted.append(path)

    def audit_trail(self) -> DataFrame:
        """The audit rows noted so far; there are some once the sales have landed."""
        return self.spark.read.parquet(*self._noted)

    def spool(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate table; every call gets a folder of its own.

        Those of a build are removed when its table is written, those of a query by
        clear_spool() when its result has been read.
        """
        path = f"{self.folder}/spool/{name}-{uuid.uuid4().hex}"
        self._scratch.append(path)
        with store.sparing_disk(self.spark):
            return store.write_table(df, path)

    def clear_spool(self) -> None:
        """Remove the intermediate tables written so far; frames that still read them can no longer be run."""
        while self._scratch:
            store.remove_folder(self.spark, self._scratch.pop())

    def landed_from_csv(self) -> DataFrame:
        """The landed sales, delivered once as CSV in the shared folder and read from there."""
        path = f"{self.folder}/{RAW}/sales_landing_csv"
        with self._lock:
            if not self._delivered:
                write_landing_csv(self.sales_landing.select(*schemas.SALES_LANDING.names), path)
                self._delivered = True
        return read_landing_csv(self.spark, path, schemas.SALES_LANDING)

    def _tasks(self, stored: DataFrame) -> int | None:
        """Tasks for a range shuffle of a large stored table, None to leave a smaller one to adaptive execution."""
        rows = row_count(stored)
        return None if rows < self.cfg.skew_min_rows else task_count(self.spark, rows, self.cfg)

    def _normalised_slices(self) -> Iterator[DataFrame]:
        slices = clean.by_line_key(self.sales_landing, self.cfg)
        hot = find_hot_buckets(self.sales_landing, clean.LINE_KEY, self.cfg)
        for lines in slices:
            yield clean.normalise(lines, self.cfg, self.spool, hot)

    def _sorted_slices(self) -> Iterator[DataFrame]:
        """The clean lines in their order, days after days where one shuffle would hold too many."""
        lines = clean.clean_sales(self.normalised)
        large = row_count(self.normalised) > self.cfg.slice_rows
        days = spans(lines, F.col("sale_date"), self.cfg) if large else []
        if not days:
            yield range_sorted(lines, *clean.SALE_ORDER, tasks=self._tasks(self.normalised))
        after = 0
        for first, last, rows in days:
            tasks = task_count(self.spark, rows, self.cfg)
            part = lines.filter(F.col("sale_date").between(first, last))
            yield range_sorted(part, *clean.SALE_ORDER, tasks=tasks, after=after)
            after += tasks

    def _path(self, name: str) -> str:
        return f"{self.folder}/{TABLES.get(name, MARTS)}/{name}"

    def _build(self, name: str) -> DataFrame:
        if name == "fact_sales":
            named = {d: self.table(d) for d in ("dim_branch", "dim_product", "dim_payment")}
            named["dim_customer"] = self.dim_customer_static
            df = fact.fact_sales(self.stg_sales_sorted, named, self.cfg)
            # Lookups by broadcast leave the rows in the order of the clean table.
            in_order = all(is_small(d, self.cfg) for d in named.values())
            months = [] if in_order else spans(self.stg_sales_sorted, F.trunc("sale_date", "month"), self.cfg)
            written = store.write_fact_partitioned(df, self._path(name), in_order, months)
            fact.assert_no_default_partition(written, self.cfg)
            return written
        if name == "normalised":
            return store.write_slices(self._normalised_slices(), self._path(name))
        if name == "stg_sales_sorted":
            return store.write_slices(self._sorted_slices(), self._path(name))
        if name == "fact_invoices":
            return store.write_invoices(self.spool(self._frame(name), name), self._path(name))
        if name in INDEXES:
            return store.write_index(self.fact_invoices, INDEXES[name], self._path(name))
        if name == "daily_cube":
            cube = aggregates.daily_cube(self.fact_sales, aggregates.stored_sales(self))
            return store.write_cube(cube, self._path(name))
        if name == "fact_sales_flat":
            return store.write_fact_flat(self.fact_sales, self._path(name))
        written = store.write_table(self._frame(name), self._path(name))
        if name in dims.NATURAL_KEYS:
            dims.assert_unique(written, dims.NATURAL_KEYS[name])
        return written

    def _frame(self, name: str) -> DataFrame:
        cfg = self.cfg
        frames: dict[str, Callable[[], DataFrame]] = {
            "branches_landing": lambda: self.landing.branches,
            "products_landing": lambda: self.landing.products,
            "customers_landing": lambda: self.landing.customers,
            "sales_landing": lambda: self.landing.sales,
            "stg_sales_rejects": lambda: clean.quarantine(self.normalised),
            "dim_date": lambda: dims.dim_date(dims.sales_bounds(self.stg_sales, cfg), cfg),
            "dim_branch": lambda: dims.dim_branch(
                self.branches_landing, cfg, self.spool),
            "dim_product": lambda: dims.dim_product(
                self.products_landing, cfg, self.spool),
            "dim_payment": lambda: dims.dim_payment(self.stg_sales, cfg, self.spool),
            "dim_customer_static": lambda: dims.dim_customer_static(
                self.customers_landing, self.spool),
            "fact_invoices": lambda: aggregates.fact_invoices(self.fact_sales, cfg),
            "dim_customer": lambda: dims.customer_enrich(
                self.dim_customer_static, aggregates.stored_sales(self)),
            "rfm_base": lambda: rfm.rfm_base(aggregates.stored_sales(self)),
            "customer_rfm": lambda: rfm.rfm_segment(
                self.rfm_base, rfm.rfm_score(self.rfm_base, self.spool)),
            "dim_customer_rfm": lambda: rfm.dim_customer_rfm(self.customer_rfm),
            "cohort_counts": lambda: semantic.cohort_counts(aggregates.stored_sales(self), self.dim_customer),
            "basket_masks": lambda: baskets.basket_masks(self.fact_sales, cfg),
            "pair_counts": lambda: baskets.pair_counts(
                self.fact_sales, self.dim_product, cfg, self.spool, cfg.min_pair_baskets, self.basket_masks),
            "line_pair_counts": lambda: baskets.line_pair_counts(
                self.basket_masks, self.dim_product, cfg, self.spool),
            "sku_shares": lambda: product.sku_shares(
                aggregates.sales(self, "product_key"), self.dim_product, cfg, self.spool),
            "load_audit": lambda: quality.append_audit(self),
            "dq_results": lambda: quality.run_checks(self),
        }
        return frames[name]()


def run_pipeline(wh: Warehouse, control_copy: bool = False, gate: bool = True) -> list[tuple[str, float]]:
    """Build everything in order; returns the five slowest steps.

    Results of the quality checks are written before the gate may raise.
    """
    for name in TABLES:
        wh.table(name)
    if control_copy:
        wh.table("fact_sales_flat")
    if gate:
        quality.dq_gate(wh.dq_results)
    return sorted(wh.timings.items(), key=lambda t: -t[1])[:5]


_open: dict[tuple, Warehouse] = {}
_open_lock = threading.Lock()


def sample_warehouse(spark: SparkSession, sf_dir: str, cfg: RetailConfig | None = None) -> Warehouse:
    """One warehouse per application and input folder, shared by all queries."""
    cfg = cfg or sample_config()
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), repr(cfg))
    with _open_lock:
        if key not in _open:
            digest = hashlib.sha256("|".join(key).encode()).hexdigest()[:16]
            folder = f"{store.shared_folder(spark)}/shopstar/{digest}"
            landing = sample_landing(spark, sf_dir, cfg)
            _open[key] = Warehouse(spark, landing, folder, cfg)
        return _open[key]
