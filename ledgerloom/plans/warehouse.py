"""The layered tables over a set of extracts, each built when first asked for.

What several jobs read (cleaned and landed tables, staged orders, facts, dimensions, marts) is written
once to the shared folder, so no mart recomputes the facts below it. The rest stays a plan.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.temporal import NTZ
from ledgerloom.operators import distinct, quality, rules
from ledgerloom.operators.asof import as_of
from ledgerloom.operators.latest import delivery_order
from ledgerloom.operators.scd2 import open_versions, scd2_apply, scd2_history, scd2_snapshots
from ledgerloom.params import Params
from ledgerloom.plans import checks, cleaning, core, marts, staging
from ledgerloom.sources import feed
from ledgerloom.sources.schemas import TABLES, TRACE
from ledgerloom.sources.store import Store, file_stamp

SCOPE = ("_batch_id",)
BUYER_CELLS = ("order_month", "sales_channel", "currency")
RESTORED_AT = "2001-12-03 02:00:00"
VERSION_COLUMNS = ("customer_id", "segment", "country", "acquisition_channel", "updated_at")


def _node(written: bool) -> Callable:
    def declare(build: Callable[[Warehouse], DataFrame]) -> property:
        name = build.__name__

        @wraps(build)
        def get(self: Warehouse) -> DataFrame:
            # a lock per node: jobs that do not depend on each other run side by side
            with self._locks_guard:
                lock = self._locks.setdefault(name, threading.RLock())
            with lock:
                if name not in self._built:
                    df = build(self)
                    self._built[name] = self._write(name, df) if written else df
                return self._built[name]

        return property(get)

    return declare


view = _node(written=False)
table = _node(written=True)


class Warehouse:
    """All tables of one set of extracts that carry a ``_batch_id``."""

    def __init__(
        self,
        extracts: Mapping[str, DataFrame],
        loaded_at: Mapping[str, str],
        store: Store,
        params: Params = Params(),
    ):
        self.extracts = extracts
        self.loaded_at = loaded_at
        self.store = store
        self.params = params
        self._built: dict[str, DataFrame] = {}
        self.observed: dict[str, quality.Counts] = {}
        self._locks: dict[str, threading.RLock] = {}
        self._locks_guard = threading.Lock()

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table; its column checks are counted on the way."""
        asked = checks.counted_by(name)
        if not asked:
            return self.store.write(name, df)
        scoped = ("_batch_id", tuple(sorted(self.loaded_at))) if "_batch_id" in df.columns and name in self.LANDED else ()
        df, counted = quality.counting(df, asked, *scoped)
        table = self.store.write(name, df)
        self.observed |= counted()
        return table

    @property
    def first_batch(self) -> str:
        return min(self.loaded_at)

    @property
    def last_batch(self) -> str:
        return max(self.loaded_at)

    # ---- cleaning: one job for all batches -------------------------------------------------

    @table
    def judged_fx_rates(self):
        return cleaning.judge_fx_rates(self.extracts["fx_rates"])

    @table
    def judged_products(self):
        return cleaning.judge_products(self.extracts["products"])

    @table
    def judged_customers(self):
        return cleaning.judge_customers(self.extracts["customers"])

    @table
    def unknown_customers(self):
        return cleaning.unknown_customers(self.extracts["orders"], self.settled_customers, SCOPE)

    @table
    def unknown_orders(self):
        return cleaning.unknown_orders(self.extracts["order_items"], self.settled_orders, SCOPE)

    @table
    def unknown_products(self):
        return cleaning.unknown_products(self.extracts["order_items"], self.settled_products, SCOPE)

    @table
    def judged_orders(self):
        self.build(("unknown_customers", "settled_fx_rates", "unknown_products"))
        return cleaning.judge_orders(
            self.extracts["orders"], self.settled_customers, self.settled_fx_rates, SCOPE, self.unknown_customers
        )

    @table
    def judged_order_items(self):
        return cleaning.judge_order_items(
            self.extracts["order_items"],
            self.settled_orders,
            self.settled_products,
            SCOPE,
            self.unknown_orders,
            self.unknown_products,
        )

    def judged(self, name: str) -> DataFrame:
        return getattr(self, f"judged_{name}")

    @table
    def settled_fx_rates(self):
        return self._settle("fx_rates")

    @table
    def settled_products(self):
        return self._settle("products")

    @table
    def settled_customers(self):
        return self._settle("customers")

    @table
    def settled_orders(self):
        return self._settle("orders")

    @table
    def settled_order_items(self):
        return self._settle("order_items")

    def _settle(self, name: str) -> DataFrame:
        return cleaning.settle(self.judged(name), name, SCOPE).drop("_src_pos")

    @table
    def filled_orders(self):
        """The orders that have accepted lines, whichever delivery of a line is kept.

        Lines of an order come together in the feed, so that a task sends an order about once.
        """
        return rules.accepted(self.judged_order_items).select(*SCOPE, "order_id").distinct()

    @table
    def clean_orders(self):
        return cleaning.split_empty_orders(self.settled_orders, self.filled_orders, SCOPE)[0]

    @view
    def empty_orders(self):
        return cleaning.split_empty_orders(self.settled_orders, self.filled_orders, SCOPE)[1]

    def clean(self, name: str) -> DataFrame:
        return self.clean_orders if name == "orders" else getattr(self, f"settled_{name}")

    def rejects(self, name: str) -> DataFrame:
        bad = rules.rejected(self.judged(name)).drop("_src_pos")
        return bad.unionByName(self.empty_orders) if name == "orders" else bad

    # ---- landed batches and staging --------------------------------------------------------

    def _stamped(self, df: DataFrame) -> DataFrame:
        stamps = F.create_map(*[F.lit(v) for pair in self.loaded_at.items() for v in pair])
        return df.withColumn("_loaded_at", F.element_at(stamps, F.col("_batch_id")).cast(NTZ))

    def raw(self, name: str, upto: str | None = None) -> DataFrame:
        """The append-only landing table, optionally as it was after batch ``upto``."""
        landed = self._stamped(self.clean(name))
        return landed if upto is None else landed.filter(F.col("_batch_id") <= upto)

    @table
    def stg_customers(self):
        return staging.stg_customers(self.raw("customers"))

    @table
    def stg_orders(self):
        """From the settled orders, so that facts do not wait for ``clean_orders`` to be written."""
        filled, _ = cleaning.split_empty_orders(self.settled_orders, self.filled_orders, SCOPE)
        return staging.stg_orders(self._stamped(filled))

    @table
    def stg_order_items(self):
        """From the judged lines: the newest of all batches is picked in the same step as the newest of its batch."""
        ok = self._stamped(rules.accepted(self.judged_order_items)).drop(*TRACE)
        return staging.stg_order_items(ok, delivery_order(ok, (*SCOPE, *cleaning.KEYS["order_items"])))

    @table
    def stg_products(self):
        return staging.stg_products(self.raw("products"))

    @table
    def stg_fx_rates(self):
        return staging.stg_fx_rates(self.raw("fx_rates"))

    # ---- facts and dimensions --------------------------------------------------------------

    @view
    def order_items_converted(self):
        self.build(("stg_order_items", "stg_orders", "stg_fx_rates", "stg_products"))
        return core.order_items_converted(
            self.stg_order_items, self.stg_orders, self.stg_fx_rates, self.stg_products
        )

    @table
    def fct_order_items(self):
        return self.order_items_converted

    @table
    def fct_orders(self):
        """Priced from the staged lines: cleaning has checked products, so an order needs none of their columns."""
        self.build(("stg_order_items", "stg_orders", "stg_fx_rates"))
        lines = core.priced_lines(self.stg_order_items, self.stg_orders, self.stg_fx_rates)
        return core.fct_orders(self.stg_orders, lines)

    @table
    def first_load_stg_orders(self):
        return staging.stg_orders(self.raw("orders", self.first_batch))

    @table
    def first_load_order_items(self):
        """The line fact as the first batch alone builds it."""
        first = self.first_batch
        return core.order_items_converted(
            staging.stg_order_items(self.raw("order_items", first)),
            self.first_load_stg_orders,
            staging.stg_fx_rates(self.raw("fx_rates", first)),
            staging.stg_products(self.raw("products", first)),
        )

    @table
    def first_load_orders(self):
        return core.fct_orders(self.first_load_stg_orders, self.first_load_order_items)

    @table
    def changed_orders(self):
        """Orders to reprocess. Both facts of the first load hold the same orders, so they share the delta."""
        return core.changed_orders(self.raw("orders"), self.first_load_orders, self.params)

    @table
    def changed_lines(self):
        return core.changed_lines(self.changed_orders, self.raw("order_items"), self.stg_fx_rates, self.stg_products)

    @view
    def fct_order_items_incremental(self):
        """The line fact after the following batches were taken in by the lookback upsert."""
        return core.fct_order_items_incremental(self.first_load_order_items, self.changed_lines)

    @view
    def fct_orders_incremental(self):
        delta = core.fct_orders(self.changed_orders, self.changed_lines)
        return core.fct_orders_incremental(self.first_load_orders, delta)

    @table
    def dim_customer(self):
        return core.dim_customer(self.stg_customers, self.fct_orders)

    @view
    def customer_snapshots(self):
        """Version history after one snapshot of all that has landed per batch."""
        landed = self.raw("customers").select("_batch_id", *VERSION_COLUMNS)
        return scd2_snapshots(landed, self.loaded_at, "_batch_id", "customer_id", "updated_at", complete=False)

    @view
    def daily_snapshots(self):
        """Version history after twelve daily snapshots."""
        first = self.clean("customers").filter(F.col("_batch_id") == self.first_batch)
        return scd2_snapshots(feed.daily_customers(first), feed.DAILY, "_batch_id", "customer_id", "updated_at")

    @view
    def crm_snapshots(self):
        """The same from the CRM deliveries themselves, in which customers go missing and then return unchanged."""
        history = None
        for batch in sorted(self.loaded_at):
            current = self.clean("customers").filter(F.col("_batch_id") == batch).select(*VERSION_COLUMNS)
            if history is None:
                history = open_versions(current, "customer_id", "updated_at")
            else:
                history = scd2_apply(history, current, "customer_id", "updated_at", self.loaded_at[batch])
        # a day later the missing ones are back as they were in the first delivery
        first = self.clean("customers").filter(F.col("_batch_id") == self.first_batch).select(*VERSION_COLUMNS)
        restored = current.unionByName(first.join(current.select("customer_id"), "customer_id", "left_anti"))
        return scd2_apply(history, restored, "customer_id", "updated_at", RESTORED_AT)

    @table
    def customer_versions(self):
        """The history rebuilt in one pass from everything that landed."""
        return scd2_history(
            self.raw("customers"),
            "customer_id",
            "updated_at",
            VERSION_COLUMNS,
            [F.col("_loaded_at").desc(), F.col("_batch_id").desc()],
            self.store,
        )

    @table
    def dim_customer_history(self):
        return core.dim_customer_history(self.customer_snapshots)

    @table
    def dim_product(self):
        return core.dim_product(self.stg_products)

    @table
    def dim_date(self):
        return core.dim_date(self.fct_orders, self.params)

    # ---- marts -----------------------------------------------------------------------------

    @table
    def monthly_revenue(self):
        return marts.monthly_revenue(self.fct_orders, self.dim_customer, self.dim_date)

    @table
    def placed_customers(self):
        base = marts.customer_base(self.fct_orders, self.dim_customer, self.params)
        return marts.placed_customers(base, self.store)

    @table
    def customer_ltv(self):
        return marts.customer_ltv(self.placed_customers)

    @table
    def rfm_segments(self):
        return marts.rfm_segments(self.placed_customers, self.store)

    @table
    def cohort_retention(self):
        return marts.cohort_retention(self.fct_orders, self.dim_customer)

    @table
    def retention_90d(self):
        return marts.retention_90d(self.fct_orders, self.params)

    @table
    def revenue_by_segment(self):
        return marts.revenue_by_segment(self.fct_orders, self.dim_customer)

    @table
    def revenue_by_category(self):
        return marts.revenue_by_category(self.fct_order_items)

    @table
    def customer_numbers(self):
        """A dense number for every customer, for sets of them."""
        everyone = self.dim_customer.select("customer_id").unionByName(self.fct_orders.select("customer_id"))
        return distinct.numbered(everyone, "customer_id", self.store)

    @table
    def buyer_sets(self):
        """Who bought, as sets, in the finest cells that buyers are counted by."""
        cells = [*BUYER_CELLS]
        bought = self.fct_orders.filter("is_revenue_order").select("customer_id", *cells).distinct()
        return distinct.sets(bought.join(self.customer_numbers, "customer_id"), "number", cells)

    @table
    def kpi_summary(self):
        return marts.kpi_summary(self.customer_ltv)

    @view
    def revenue_by_segment_as_of(self):
        attributed = as_of(
            self.fct_orders.filter("is_revenue_order").select(
                "customer_id", "order_id", "order_ts", "order_month", "net_revenue_usd"
            ),
            self.customer_versions,
            "customer_id",
            "order_ts",
            "order_id",
            "valid_from",
            ["segment"],
            self.store,
        )
        return marts.revenue_by_segment_as_of(attributed)

    CORE = ("dim_customer", "dim_customer_history", "dim_date", "dim_product", "fct_order_items", "fct_orders")
    ANALYTICS = (
        "cohort_retention",
        "customer_ltv",
        "kpi_summary",
        "monthly_revenue",
        "retention_90d",
        "revenue_by_category",
        "revenue_by_segment",
        "rfm_segments",
    )

    LANDED = tuple("clean_orders" if t == "orders" else f"settled_{t}" for t in TABLES)

    def build(self, names: Sequence[str] = (*LANDED, *CORE, *ANALYTICS), threads: int = 4) -> Warehouse:
        """Build tables, several at a time; one that another needs is built once and waited for."""
        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(lambda name: getattr(self, name), names))
        return self


_open: dict[tuple, Warehouse] = {}
_open_lock = threading.Lock()


def open_warehouse(spark: SparkSession, sf_dir: str, params: Params = Params()) -> Warehouse:
    """The warehouse over a folder of benchmark tables; rebuilt when a source file changed."""
    stamp = file_stamp(spark, feed.source_paths(sf_dir))
    key = (spark.sparkContext.applicationId, sf_dir, params, stamp)
    with _open_lock:
        if key not in _open:
            _open[key] = Warehouse(feed.extracts(spark, sf_dir), feed.BATCHES, Store.for_session(spark), params)
        return _open[key]
