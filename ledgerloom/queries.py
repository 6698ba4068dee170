"""Every query of the engine over a folder of benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType

from ledgerloom.functions.temporal import moment
from ledgerloom.operators.rules import REASON, rejected
from ledgerloom.operators.security import masked
from ledgerloom.plans import checks, core, marts, monitoring, pipeline
from ledgerloom.plans.cleaning import Cleaned, judge_order_items, judge_orders, settle
from ledgerloom.plans.measures import Measures
from ledgerloom.plans.warehouse import SCOPE, Warehouse, open_warehouse
from ledgerloom.sources import feed, lake
from ledgerloom.sources.catalog import Catalog
from ledgerloom.sources.extracts import SOURCES, read_extract, read_traced
from ledgerloom.sources.schemas import EXTRACT_COLUMNS, LANDED, LINE, TABLES
from ledgerloom.streaming.orders import folded_from_stream, latest_from_stream, once_from_stream

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-12-03 12:00:00"  # "now" for the queries over the derived feed
LOG_AS_OF = "2024-01-31 00:00:00"  # "now" for the queries over the run logs
REGIONAL_USER = "EMEA.Manager@example.com"  # addresses are compared in any case
EXECUTIVE = "executive@example.com"


def present(df: DataFrame) -> DataFrame:
    """Result types: decimals leave as double, whole numbers as bigint."""
    casts = {DecimalType: "double", IntegerType: "bigint"}
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(casts[type(f.dataType)]).alias(f.name) if type(f.dataType) in casts else f.name
            for f in df.schema
        ]
    )


def _on_warehouse(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(build(open_warehouse(spark, sf_dir)))


def _on_measures(build: Callable[[Measures], DataFrame], user: str | None = None, restricted: bool = True) -> Query:
    return lambda spark, sf_dir: present(build(Measures(open_warehouse(spark, sf_dir), spark, user, restricted)))


def _on_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(build(spark.read.parquet(f"{sf_dir}/events.parquet")))


def _node(name: str) -> Query:
    return _on_warehouse(lambda w: getattr(w, name))


def _cleaned(w: Warehouse) -> dict[str, Cleaned]:
    return {t: Cleaned(w.judged(t), w.clean(t), w.rejects(t)) for t in TABLES}


def _clean_tables(w: Warehouse) -> dict[str, DataFrame]:
    return {t: w.clean(t) for t in TABLES}


def _gate(w: Warehouse) -> DataFrame:
    clean = _clean_tables(w)  # they are written, and their columns counted, before the counts are asked for
    return checks.gate_checks(clean, SCOPE, _batches(w), checks.gate_counts(w.observed))


def _batches(w: Warehouse) -> DataFrame:
    return w.extracts["customers"].select(*SCOPE).distinct()


def _accounts(w: Warehouse) -> DataFrame:
    return checks.accounted(w.extracts, _cleaned(w), SCOPE)


def _raw_batch_replace(w: Warehouse) -> DataFrame:
    """Land both batches, the first one twice, and count what is there."""
    orders = w.clean("orders")
    path = w.store.path(w.store.unique("landing"))
    for batch in (w.first_batch, *sorted(w.loaded_at)):
        lake.replace_batch(orders.filter(F.col("_batch_id") == batch), path, batch)
    landed = lake.read_batches(w.store.spark, path, orders.schema)
    return landed.groupBy("_batch_id").agg(
        F.count("*").alias("rows"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("discount_pct").alias("discounts"),
    )


def _extract_round_trip(w: Warehouse, table: str) -> DataFrame:
    """The first delivery of an extract, written with its columns in another order and read again."""
    spec, columns = SOURCES[table], EXTRACT_COLUMNS[table]
    base = w.store.path(w.store.unique("extract"))
    rows = w.extracts[table].filter(F.col("_batch_id") == w.first_batch).select(*reversed(columns))
    if spec.format == "csv":
        lake.write_csv(rows, f"{base}/{spec.system}/{spec.file}")
    else:
        rows.write.option("ignoreNullFields", False).json(f"{base}/{spec.system}/{spec.file}")
    return read_extract(w.store.spark, base, table)


def _quarantine_round_trip(w: Warehouse) -> DataFrame:
    base = w.store.path(w.store.unique("quarantine"))
    pipeline.write_quarantine({"order_items": w.rejects("order_items")}, base, "b")
    return w.store.spark.read.options(header=True, escape='"').csv(f"{base}/rejects/order_items/batch_id=b")


def _unreadable_lines(w: Warehouse) -> DataFrame:
    """Lines of the first delivery broken on the way: orders cut at the end, order lines with a field too many."""
    spark, base = w.store.spark, w.store.path(w.store.unique("broken"))
    broken = F.col("order_id").endswith("7")

    def first(table: str) -> DataFrame:
        return w.extracts[table].filter(F.col("_batch_id") == w.first_batch).select(*EXTRACT_COLUMNS[table])

    line = F.to_json(F.struct(*EXTRACT_COLUMNS["orders"]), {"ignoreNullFields": "false"})
    cut = F.when(broken, F.left(line, F.length(line) - 1)).otherwise(line)
    first("orders").select(cut).write.text(f"{base}/erp/orders.jsonl")
    names = EXTRACT_COLUMNS["order_items"]
    fields = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in names])
    longer = F.when(broken, F.concat(fields, F.lit(",late"))).otherwise(fields)
    # one column by the name of the whole header
    plain = first("order_items").select(longer.alias(",".join(names)))
    plain.write.options(header=True, sep="\x01", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(
        f"{base}/erp/order_items.csv"
    )
    customers, rates, products = (w.clean(t).filter(F.col("_batch_id") == w.first_batch) for t in ("customers", "fx_rates", "products"))
    orders = judge_orders(read_traced(spark, base, "orders"), customers, rates)
    lines = judge_order_items(read_traced(spark, base, "order_items"), settle(orders, "orders"), products)
    parts = [rejected(j).select(F.lit(t).alias("table_name"), REASON, LINE) for t, j in (("orders", orders), ("order_items", lines))]
    return parts[0].unionByName(parts[1]).filter(F.col(LINE).isNotNull()).withColumnRenamed(LINE, "line")


def _staged_load(w: Warehouse) -> DataFrame:
    """Clean products staged under upper-case names and loaded twice as one batch."""
    base = w.store.path(w.store.unique("staged"))
    rows = w.raw("products", w.first_batch).drop("_batch_id")
    rows.toDF(*[c.upper() for c in rows.columns]).write.parquet(f"{base}/clean/batch_id=b")
    for _ in range(2):
        lake.load_staged(w.store.spark, f"{base}/clean", f"{base}/raw", LANDED["products"], "b")
    return lake.read_batches(w.store.spark, f"{base}/raw", LANDED["products"])


def _fact_in_folders(w: Warehouse) -> DataFrame:
    """The order fact of the first batch in month folders, updated in place by the delta of the next."""
    tables = Catalog(w.store.spark, w.store.path(w.store.unique("facts")))
    tables.replace("fct_orders", w.first_load_orders, "order_month", "order_id")
    delta = w.store.scratch(core.fct_orders(w.changed_orders, w.changed_lines), "delta")
    return tables.upsert("fct_orders", delta)


def _exported_customers(w: Warehouse) -> DataFrame:
    path = w.store.path(w.store.unique("export"))
    lake.write_csv(masked(w.dim_customer, "reporter"), path)
    back = w.store.spark.read.options(header=True, escape='"').csv(path)
    return back.select("customer_id", "full_name", "email", "country", "completed_orders")


def _dim_customer_masked(w: Warehouse) -> DataFrame:
    return masked(w.dim_customer, "reporter").select("customer_id", "email", "country")


def _time_intelligence(m: Measures) -> DataFrame:
    return m.time_intelligence()


QUERIES: dict[str, Query] = {
    # cleaning and quarantine
    **{f"clean_{t}": _on_warehouse(lambda w, t=t: w.clean(t)) for t in TABLES},
    **{f"rejects_{t}": _on_warehouse(lambda w, t=t: w.rejects(t)) for t in ("customers", "orders", "order_items")},
    "rejects_no_valid_items": _node("empty_orders"),
    "dedupe_counts": _on_warehouse(_accounts),
    # checks
    "dq_checks": _on_warehouse(_gate),
    "dq_relationships": _on_warehouse(
        # against the cleaned extracts before empty orders are taken out, so that there are orphans to count
        lambda w: checks.relationship_checks(
            {**_clean_tables(w), "orders": w.judged_orders, "order_items": w.judged_order_items}, SCOPE, _batches(w)
        )
    ),
    "dq_reconciliation": _on_warehouse(lambda w: checks.reconciliation(_accounts(w), SCOPE)),
    "dq_rejects_by_reason": _on_warehouse(
        lambda w: checks.rejects_by_reason({t: w.rejects(t) for t in TABLES}, SCOPE)
    ),
    "model_tests": _on_warehouse(checks.model_tests),
    "recon_order_totals": _on_warehouse(lambda w: checks.recon_order_totals(w.fct_orders, w.fct_order_items)),
    "recon_monthly_revenue": _on_warehouse(lambda w: checks.recon_monthly_revenue(w.monthly_revenue, w.fct_orders)),
    "recon_cohort_month_zero": _on_warehouse(lambda w: checks.recon_cohort_month_zero(w.cohort_retention)),
    # landing and staging
    "raw_batch_replace": _on_warehouse(_raw_batch_replace),
    **{f"stg_{t}": _node(f"stg_{t}") for t in TABLES},
    "extract_csv": _on_warehouse(lambda w: _extract_round_trip(w, "order_items")),
    "extract_jsonl": _on_warehouse(lambda w: _extract_round_trip(w, "orders")),
    "quarantine_csv": _on_warehouse(_quarantine_round_trip),
    "quarantine_unreadable": _on_warehouse(_unreadable_lines),
    "staged_load": _on_warehouse(_staged_load),
    # facts and dimensions
    "fct_orders_in_folders": _on_warehouse(_fact_in_folders),
    "export_customers": _on_warehouse(_exported_customers),
    "order_items_converted": _node("order_items_converted"),
    "fct_order_items": _node("fct_order_items"),
    "fct_orders": _node("fct_orders"),
    "fct_order_items_incremental": _node("fct_order_items_incremental"),
    "fct_orders_incremental": _node("fct_orders_incremental"),
    "dim_customer": _node("dim_customer"),
    "dim_customer_history": _node("dim_customer_history"),
    "dim_product": _node("dim_product"),
    "dim_date": _node("dim_date"),
    "scd2_apply": _node("crm_snapshots"),
    "scd2_daily_snapshots": _node("daily_snapshots"),
    "scd2_history": _node("customer_versions"),
    # marts
    "monthly_revenue": _node("monthly_revenue"),
    "customer_ltv": _node("customer_ltv"),
    "rfm_segments": _node("rfm_segments"),
    "cohort_retention": _node("cohort_retention"),
    "retention_90d": _node("retention_90d"),
    "revenue_by_segment": _node("revenue_by_segment"),
    "revenue_by_category": _node("revenue_by_category"),
    "kpi_summary": _node("kpi_summary"),
    "revenue_by_segment_as_of": _node("revenue_by_segment_as_of"),
    "top_customers": _on_warehouse(lambda w: marts.top_customers(w.customer_ltv, 20)),
    # measures
    "measures_revenue": _on_measures(
        lambda m: m.evaluate(
            [
                "total_revenue",
                "gross_sales",
                "total_discounts",
                "discount_rate_pct",
                "completed_orders",
                "average_order_value",
                "refund_rate_pct",
            ],
            ["year_month", "segment"],
        )
    ),
    "measures_time_intelligence": _on_measures(_time_intelligence),
    "measure_revenue_share": _on_measures(lambda m: m.revenue_share(["segment"], ["year"])),
    "measures_customers": _on_measures(lambda m: m.customer_activity()),
    "measure_retained_mom": _on_measures(lambda m: m.retained_month_over_month()),
    "measures_customer_flow": _on_measures(
        lambda m: m.evaluate(
            [
                "active_customers",
                "new_customers",
                "returning_customers",
                "retained_customers_mom",
                "customer_retention_rate_mom",
            ],
            ["year_month", "segment"],
        )
    ),
    "measures_customer_flow_by_year": _on_measures(
        lambda m: m.evaluate(
            ["new_customers", "returning_customers", "retained_customers_mom"],
            ["year", "country"],
            F.col("segment") == "SMB",
            ["segment"],
        )
    ),
    "measures_buyers_by_channel": _on_measures(
        lambda m: m.evaluate(
            [
                "active_customers",
                "new_customers",
                "returning_customers",
                "retained_customers_mom",
                "customer_retention_rate_mom",
            ],
            ["year", "quarter", "sales_channel"],
        )
    ),
    "measures_buyers_by_channel_and_segment": _on_measures(
        lambda m: m.evaluate(
            ["retained_customers_mom", "customer_retention_rate_mom"], ["order_month", "sales_channel", "segment"]
        ),
        REGIONAL_USER,
    ),
    "measures_yoy_by_segment": _on_measures(
        lambda m: m.evaluate(
            ["total_revenue", "revenue_py", "revenue_yoy_pct", "yoy_colour"],
            ["order_month", "segment"],
            F.col("country") == "DE",
            ["country"],
            dates=F.year("order_month") == 2000,
        )
    ),
    "measures_yoy_by_year": _on_measures(
        lambda m: m.evaluate(["total_revenue", "revenue_py", "revenue_yoy_pct", "yoy_colour"], ["year", "segment"])
    ),
    "measures_time_by_quarter": _on_measures(
        lambda m: m.evaluate(
            ["total_revenue", "revenue_pm", "revenue_py", "revenue_ytd", "revenue_rolling_3m", "revenue_yoy_pct"],
            ["year", "quarter", "sales_channel"],
        )
    ),
    "measures_time_by_day": _on_measures(
        lambda m: m.evaluate(
            ["total_revenue", "revenue_pm", "revenue_py", "revenue_ytd", "revenue_rolling_3m"], ["order_date"]
        )
    ),
    "measures_ytd_by_category": _on_measures(
        lambda m: m.evaluate(["total_revenue", "revenue_ytd", "revenue_py"], ["year", "quarter", "category"])
    ),
    "measures_category": _on_measures(
        lambda m: m.evaluate(["total_revenue", "revenue_share_pct"], ["year", "category"]), REGIONAL_USER
    ),
    "measures_executive": _on_measures(
        lambda m: m.evaluate(["total_revenue", "active_customers", "revenue_share_pct"], ["country"]), EXECUTIVE, False
    ),
    "measures_ltv": _on_measures(
        lambda m: m.evaluate(
            [
                "avg_customer_ltv",
                "avg_predicted_clv",
                "repeat_purchase_rate_pct",
                "churned_customers",
                "churn_rate_pct",
                "top_10pct_customer_revenue_share",
                "champions_count",
            ],
            ["segment"],
        )
    ),
    "measures_cohort": _on_measures(
        lambda m: m.evaluate(
            ["cohort_retention_pct", "cohort_cumulative_revenue_per_customer"], ["months_since_first"]
        )
    ),
    "measure_last_refreshed": _on_measures(lambda m: m.evaluate(["last_refreshed"])),
    "visual_channel_year_matrix": _on_measures(lambda m: m.channel_year_matrix()),
    "visual_lifecycle_by_segment": _on_measures(lambda m: m.lifecycle_by_segment()),
    "visual_clv_by_channel": _on_measures(lambda m: m.clv_by_channel()),
    "visual_rfm_donut": _on_measures(lambda m: m.rfm_donut()),
    "visual_revenue_by_country": _on_measures(lambda m: m.revenue_by_country()),
    "visual_new_vs_returning": _on_measures(
        lambda m: m.customer_activity().select("order_month", "new_customers", "returning_customers")
    ),
    # security
    "rls_revenue_by_country": _on_measures(lambda m: m.revenue_by_country(), REGIONAL_USER),
    "mask_email": _on_warehouse(_dim_customer_masked),
    # monitoring
    "ops_latest_run_per_stage": _on_events(lambda e: monitoring.latest_run_per_stage(feed.run_log(e))),
    "ops_failed_checks_7d": _on_events(lambda e: monitoring.failed_checks(feed.check_log(e), moment(LOG_AS_OF))),
    "ops_rows_per_batch": _on_warehouse(
        lambda w: monitoring.rows_per_batch(feed.daily_landing(w.clean("orders")))
    ),
    "source_freshness": _on_warehouse(
        lambda w: monitoring.source_freshness({t: w.raw(t) for t in TABLES}, moment(AS_OF))
    ),
    "batch_retention_tier": _on_warehouse(
        lambda w: monitoring.classify_batches(feed.daily_landing(w.clean("orders")), moment(AS_OF))
    ),
    # streaming
    "stream_orders_latest": _on_warehouse(latest_from_stream),
    "stream_orders_folded": _on_warehouse(folded_from_stream),
    "stream_orders_once": _on_warehouse(once_from_stream),
}
