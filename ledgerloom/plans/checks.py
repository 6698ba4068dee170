"""The checks: the gate before loading, the model tests, and the reconciliations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import ratio
from ledgerloom.operators import quality as q
from ledgerloom.operators.security import country_grants
from ledgerloom.plans.cleaning import STATUSES, Cleaned, duplicates

# Fixed values.
SEGMENT_VALUES = ("Consumer", "SMB", "Enterprise")
LIFECYCLE_VALUES = ("Active", "Lapsing", "Churned")
RFM_VALUES = (
    "Champions", "Loyal", "New / Promising", "At Risk", "Cannot Lose", "Hibernating", "Needs Attention",
)
WARN_REJECT_PCT = 5


@dataclass(frozen=True)
class TableChecks:
    """What the gate asks of a table: column checks, its key, and (column, parent table) references."""

    columns: tuple[q.ColumnCheck, ...]
    key: tuple[str, ...]
    parents: tuple[tuple[str, str], ...] = ()


def gate() -> dict[str, TableChecks]:
    return {
        "customers": TableChecks(
            (q.min_rows(1), q.not_null("customer_id", "email", "signup_date", "segment")), ("customer_id",)
        ),
        "products": TableChecks((q.positive("list_price_usd"),), ("product_id",)),
        "fx_rates": TableChecks((), ("currency",)),
        "orders": TableChecks(
            (
                q.min_rows(1),
                q.not_null("order_id", "customer_id", "order_ts", "status", "currency"),
                q.accepted_values("status", STATUSES),
            ),
            ("order_id",),
            (("customer_id", "customers"), ("currency", "fx_rates")),
        ),
        "order_items": TableChecks(
            (q.positive("quantity"), q.positive("unit_price")),
            ("order_id", "line_number"),
            (("order_id", "orders"), ("product_id", "products")),
        ),
    }


def gate_checks(
    clean: Mapping[str, DataFrame],
    scope: Sequence[str] = (),
    scopes: DataFrame | None = None,
    counts: Mapping[str, q.Counts] | None = None,
) -> DataFrame:
    """The 17 checks on the cleaned tables; ``counts`` are those of columns from when the tables were written."""
    parts = []
    for table, asked in gate().items():
        if counts is not None and table in counts:
            parts.append(q.counted_checks(clean[table].sparkSession, table, asked.columns, counts[table], scope))
        elif asked.columns:
            parts.append(q.check_columns(clean[table], table, asked.columns, scope, scopes))
        parts.append(q.check_unique(clean[table], table, asked.key, scope, scopes))
        for column, parent in asked.parents:
            parts.append(q.check_relationship(clean[table], table, column, clean[parent], column, scope, scopes))
    return q.union(parts)


def relationship_checks(
    clean: Mapping[str, DataFrame], scope: Sequence[str] = (), scopes: DataFrame | None = None
) -> DataFrame:
    s = {"scope": scope, "scopes": scopes}
    links = [(table, *link) for table, asked in gate().items() for link in asked.parents]
    return q.union(
        [q.check_relationship(clean[child], child, col, clean[parent], col, **s) for child, col, parent in links]
    )


def accounted(raw: Mapping[str, DataFrame], cleaned: Mapping[str, Cleaned], scope: Sequence[str] = ()) -> DataFrame:
    """Raw, clean, rejected and deduplicated rows per table. Each count is taken on its own.

    Raw rows are counted in the extract, before any join, and duplicates from the keys, so a join
    that multiplied or lost rows shows.
    """
    parts = []
    for table, result in cleaned.items():
        counts = [
            raw[table].groupBy(*scope).agg(F.count("*").alias("raw")),
            result.data.groupBy(*scope).agg(F.count("*").alias("clean")),
            result.rejects.groupBy(*scope).agg(F.count("*").alias("rejected")),
            duplicates(result.judged, table, scope).withColumnRenamed("duplicates_removed", "deduped"),
        ]
        joined = counts[0]
        for other in counts[1:]:
            name = other.columns[-1]
            joined = joined.join(other, list(scope), "left") if scope else joined.withColumn(name, other.scalar())
        parts.append(
            joined.select(
                *scope,
                F.lit(table).alias("table_name"),
                *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("raw", "clean", "rejected", "deduped")],
            )
        )
    return q.union(parts)


def reconciliation(accounts: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Two checks per table: every raw row is accounted for, and the reject rate stays low."""
    raw, clean, rejected, deduped = (F.col(c) for c in ("raw", "clean", "rejected", "deduped"))
    balance = raw - clean - rejected - deduped
    rate = ratio(rejected * 100, F.greatest(raw, F.lit(1)), 2)
    figures = F.concat(
        F.lit("raw="), raw.cast("string"), F.lit(" clean="), clean.cast("string"),
        F.lit(" rejected="), rejected.cast("string"), F.lit(" deduped="), deduped.cast("string"),
    )
    rows = F.array(
        F.struct(
            F.lit("row_reconciliation").alias("check_name"),
            F.lit("error").alias("severity"),
            (balance == 0).alias("passed"),
            F.abs(balance).alias("failures"),
            figures.alias("detail"),
        ),
        F.struct(
            F.lit(f"reject_rate<{WARN_REJECT_PCT}%").alias("check_name"),
            F.lit("warning").alias("severity"),
            (rejected * 100 < raw * WARN_REJECT_PCT).alias("passed"),
            rejected.alias("failures"),
            F.concat(rate.cast("string"), F.lit("% rejected")).alias("detail"),
        ),
    )
    return accounts.select(*scope, "table_name", F.explode(rows).alias("r")).select(*scope, "table_name", "r.*")


def rejects_by_reason(rejects: Mapping[str, DataFrame], scope: Sequence[str] = ()) -> DataFrame:
    parts = [
        df.groupBy(*scope, "reject_reason").agg(F.count("*").alias("rows")).select(
            *scope, F.lit(table).alias("table_name"), "reject_reason", "rows"
        )
        for table, df in rejects.items()
    ]
    return q.union(parts)


def order_total_breaks(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders whose totals differ from their lines, or that only one fact knows."""
    sums = lines.groupBy("order_id").agg(
        F.sum("net_revenue_usd").alias("line_net"), F.sum("line_amount_usd").alias("line_gross")
    )
    paired = orders.select("order_id", "net_revenue_usd", "gross_amount_usd", F.lit(True).alias("in_orders")).join(
        sums.withColumn("in_lines", F.lit(True)), "order_id", "full_outer"
    )
    cent = F.lit("0.01").cast("decimal(3,2)")
    return paired.withColumn(
        "broken",
        F.col("in_orders").isNull()
        | F.col("in_lines").isNull()
        | (F.abs(F.col("net_revenue_usd") - F.col("line_net")) > cent)
        | (F.abs(F.col("gross_amount_usd") - F.col("line_gross")) > cent),
    )


def recon_order_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    return order_total_breaks(orders, lines).agg(
        F.count("*").alias("orders_compared"),
        F.count_if("broken").alias("failures"),
        F.sum("net_revenue_usd").alias("order_net_usd"),
        F.sum("line_net").alias("line_net_usd"),
    )


def recon_monthly_revenue(monthly: DataFrame, orders: DataFrame) -> DataFrame:
    fact = orders.filter("is_revenue_order").agg(F.sum("net_revenue_usd")).scalar()
    both = monthly.agg(F.sum("revenue_usd").alias("trend_revenue")).withColumn("fact_revenue", fact)
    off = F.abs(F.col("trend_revenue") - F.col("fact_revenue")) > F.lit("0.01").cast("decimal(3,2)")
    return both.withColumn("passed", ~off)


def recon_cohort_month_zero(cohorts: DataFrame) -> DataFrame:
    return cohorts.filter("months_since_first = 0").agg(
        F.count("*").alias("cohorts"), F.count_if(F.col("retention_rate") != 1).alias("failures")
    )


_GATE, _MODEL = "gate:", "model:"
# tables that are written under another name than that of their tests
_WRITTEN_AS = {f"settled_{t}": t for t in ("customers", "order_items", "products", "fx_rates")} | {"clean_orders": "orders"}


def column_tests() -> dict[str, tuple[q.ColumnCheck, ...]]:
    """The tests of models that look at one row at a time."""
    half = F.lit("0.5").cast("decimal(2,1)")
    one = F.lit(1).cast("decimal(22,4)")
    return {
        "raw_customers": (q.not_null("customer_id"),),
        "raw_orders": (q.not_null("order_id"),),
        "security_country_access": (q.not_null("user_email"), q.not_null("country")),
        "stg_customers": (q.not_null("customer_id"), q.not_null("email"), q.accepted_values("segment", SEGMENT_VALUES)),
        "stg_orders": (
            q.not_null("order_id"),
            q.not_null("customer_id"),
            q.accepted_values("status", STATUSES),
            q.accepted_range("discount_pct", F.lit(0), half),
        ),
        "stg_order_items": (q.not_null("order_item_id"), q.accepted_range("quantity", F.lit(1))),
        "stg_products": (q.not_null("product_id"),),
        "stg_fx_rates": (q.not_null("currency"),),
        "fct_orders": (
            q.not_null("order_id"),
            q.not_null("customer_id"),
            q.not_null("order_date"),
            q.accepted_values("status", STATUSES),
            q.accepted_range("net_revenue_usd", F.lit(0)),
            q.expression_is_true("net_revenue_usd <= gross_amount_usd"),
        ),
        "fct_order_items": (q.not_null("order_item_id"),),
        "dim_customer": (q.not_null("customer_id"), q.accepted_values("segment", SEGMENT_VALUES)),
        "dim_customer_history": (q.not_null("customer_version_key"), q.expression_is_true("valid_from < valid_to")),
        "dim_product": (q.not_null("product_id"),),
        "dim_date": (q.not_null("date_day"),),
        "monthly_revenue": (q.not_null("order_month"),),
        "customer_ltv": (q.not_null("customer_id"), q.accepted_values("lifecycle_status", LIFECYCLE_VALUES)),
        "cohort_retention": (
            q.accepted_range("retention_rate", F.lit(0), one),
            q.failing_rows(
                "cohort_month_zero_full_retention", (F.col("months_since_first") == 0) & (F.col("retention_rate") != 1)
            ),
        ),
        "rfm_segments": (q.accepted_values("rfm_segment", RFM_VALUES),),
        "kpi_summary": (q.expression_is_true("repeat_purchase_rate between 0 and 1"),),
    }


def counted_by(table: str) -> dict[str, tuple[q.ColumnCheck, ...]]:
    """The checks to count while ``table`` is written."""
    landed = _WRITTEN_AS.get(table)
    tests, asked = column_tests(), {}
    if landed is not None:
        asked = {_GATE + landed: gate()[landed].columns, _MODEL + f"raw_{landed}": tests.get(f"raw_{landed}", ())}
    elif table in tests:
        asked = {_MODEL + table: tests[table]}
    return {name: checks for name, checks in asked.items() if checks}


def gate_counts(observed: Mapping[str, q.Counts]) -> dict[str, q.Counts]:
    return {name.removeprefix(_GATE): counts for name, counts in observed.items() if name.startswith(_GATE)}


def model_column_tests(w) -> list[DataFrame]:
    """The column tests, counted when the tables were written; of a table that was not, by reading it.

    An update counts the folders it writes: those it leaves passed the tests of the transform that wrote them.
    """
    spark, parts = w.store.spark, []
    for model, tests in column_tests().items():
        if model.startswith("raw_"):
            table = w.raw(model.removeprefix("raw_"))
        elif model == "security_country_access":
            table = country_grants(spark)
        else:
            table = getattr(w, model)
        counts = w.observed.get(_MODEL + model)  # there once the table is built
        if counts is None:
            parts.append(q.check_columns(table, model, tests))
        else:  # of landed tables over all their batches
            total = {t.name: sum(of[t.name] for of in counts.values()) for t in tests}
            parts.append(q.counted_checks(spark, model, tests, {None: total}))
    return parts


def _failing_rows(df: DataFrame, model: str, name: str, failing) -> DataFrame:
    return q.check_columns(df, model, [q.failing_rows(name, failing)])


def model_tests(w) -> DataFrame:
    """The 61 tests on the built models, one row each. Those of columns need no pass over what was written with ``counting``."""

    def unique(df, model, columns):
        return q.check_unique(df, model, columns, nulls_count=False)

    def related(model, child, column, parent, parent_column):
        return q.check_relationship(child, model, column, parent, parent_column, null_is_orphan=False)

    stg_c, stg_o, stg_i, stg_p, stg_fx = (
        w.stg_customers, w.stg_orders, w.stg_order_items, w.stg_products, w.stg_fx_rates,
    )
    ltv, rfm = w.customer_ltv, w.rfm_segments
    parts = [
        # staging
        unique(stg_c, "stg_customers", ["customer_id"]),
        unique(stg_o, "stg_orders", ["order_id"]),
        related("stg_orders", stg_o, "customer_id", stg_c, "customer_id"),
        related("stg_orders", stg_o, "currency", stg_fx, "currency"),
        unique(stg_i, "stg_order_items", ["order_item_id"]),
        related("stg_order_items", stg_i, "product_id", stg_p, "product_id"),
        unique(stg_p, "stg_products", ["product_id"]),
        unique(stg_fx, "stg_fx_rates", ["currency"]),
        # core
        unique(w.fct_orders, "fct_orders", ["order_id"]),
        related("fct_orders", w.fct_orders, "customer_id", w.dim_customer, "customer_id"),
        related("fct_orders", w.fct_orders, "order_date", w.dim_date, "date_day"),
        unique(w.fct_order_items, "fct_order_items", ["order_item_id"]),
        related("fct_order_items", w.fct_order_items, "product_id", w.dim_product, "product_id"),
        unique(w.dim_customer, "dim_customer", ["customer_id"]),
        unique(w.dim_customer_history, "dim_customer_history", ["customer_version_key"]),
        unique(w.dim_product, "dim_product", ["product_id"]),
        unique(w.dim_date, "dim_date", ["date_day"]),
        # analytics
        unique(w.monthly_revenue, "monthly_revenue", ["order_month"]),
        unique(ltv, "customer_ltv", ["customer_id"]),
        related("customer_ltv", ltv, "customer_id", w.dim_customer, "customer_id"),
        unique(w.cohort_retention, "cohort_retention", ["cohort_month", "months_since_first"]),
        unique(w.retention_90d, "retention_90d", ["month_start"]),
        unique(rfm, "rfm_segments", ["customer_id"]),
        unique(w.revenue_by_category, "revenue_by_category", ["order_month", "category"]),
        # singular
        _failing_rows(
            order_total_breaks(w.fct_orders, w.fct_order_items), "fct_orders", "order_totals_match_lines", F.col("broken")
        ),
        _failing_rows(
            recon_monthly_revenue(w.monthly_revenue, w.fct_orders),
            "monthly_revenue",
            "monthly_revenue_reconciles",
            ~F.col("passed"),
        ),
    ]
    return q.union([*parts, *model_column_tests(w)])
