"""Named dashboard measures over the star schema.

A request names measures, the columns to group by, an optional filter and the user. Every measure of
one base table comes from one aggregation. Order measures are first reduced to one row per customer
and requested fact column, then joined with the customer attributes they need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import cents, ratio, signed_ratio
from ledgerloom.functions.temporal import month_spine, month_start
from ledgerloom.operators import distinct, periods
from ledgerloom.operators.security import country_grants, visible_customers, visible_facts
from ledgerloom.plans.warehouse import BUYER_CELLS, Warehouse

RATE = 6  # decimal places of a rate
# The colours of a rising and a falling figure.
RISING, FALLING = "#16A34A", "#DC2626"

# Calendar attributes are functions of a day, so they need no join with the calendar.
DATE_COLUMNS = {
    "order_month": month_start,
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "year_month": lambda day: F.date_format(day, "yyyy-MM"),
}
FACT_COLUMNS = ("sales_channel", "status", "currency", "order_date")
LINE_COLUMNS = ("category",)
# The grain a set of calendar columns asks for.
_GRAINS = (
    ("day", {"order_date"}),
    ("month", {"order_month"}),
    ("month", {"year_month"}),
    ("month", {"year", "month"}),
    ("quarter", {"year", "quarter"}),
    ("year", {"year"}),
)
CUSTOMER_COLUMNS = ("segment", "country", "acquisition_channel", "signup_month", "first_order_month")

ORDER_MEASURES = {
    "total_revenue": lambda: F.sum("net"),
    "gross_sales": lambda: F.sum("gross"),
    "total_discounts": lambda: F.sum("discount"),
    "discount_rate_pct": lambda: ratio(cents(F.sum("discount")), cents(F.sum("gross")), RATE),
    "completed_orders": lambda: F.sum("completed"),
    "average_order_value": lambda: ratio(cents(F.sum("net")), F.sum("completed") * 100, 2),
    "refund_rate_pct": lambda: ratio(F.sum("refunded"), F.sum("all_orders"), RATE),
    "active_customers": lambda: F.count_distinct(F.when(F.col("completed") > 0, F.col("customer_id"))),
    "revenue_per_customer": lambda: ratio(
        cents(F.sum("net")), F.count_distinct(F.when(F.col("completed") > 0, F.col("customer_id"))) * 100, 2
    ),
    "last_refreshed": lambda: F.concat(F.lit("Data as of "), F.date_format(F.max("last_date"), "dd MMM yyyy")),
}

LTV_MEASURES = {
    "avg_customer_ltv": lambda: ratio(F.sum(cents(F.col("total_revenue_usd"))), F.count("*") * 100, 2),
    "avg_predicted_clv": lambda: ratio(F.sum(cents(F.col("predicted_clv_usd"))), F.count("*") * 100, 2),
    "customers": lambda: F.count("*"),
    "repeat_purchase_rate_pct": lambda: ratio(F.count_if(F.col("orders") > 1), F.count("*"), RATE),
    "churned_customers": lambda: F.count_if(F.col("lifecycle_status") == "Churned"),
    "churn_rate_pct": lambda: ratio(F.count_if(F.col("lifecycle_status") == "Churned"), F.count("*"), RATE),
    "top_10pct_customer_revenue_share": lambda: ratio(
        F.coalesce(
            F.sum(F.when(F.expr("revenue_percentile >= 0.9"), cents(F.col("total_revenue_usd")))), F.lit(0)
        ),
        F.sum(cents(F.col("total_revenue_usd"))),
        RATE,
    ),
}
RFM_MEASURES = {"champions_count": lambda: F.count_if(F.col("rfm_segment") == "Champions")}
COHORT_MEASURES = {
    "cohort_retention_pct": lambda: ratio(F.sum("active_customers"), F.sum("cohort_customers"), RATE),
    "cohort_cumulative_revenue_per_customer": lambda: F.max("cumulative_revenue_per_customer_usd"),
}
# Measures that tell customers apart.
_OF_CUSTOMERS = ("active_customers", "revenue_per_customer")
# Measures that move the date filter: they need the months around the one they are asked for.
TIME_MEASURES = (
    "revenue_pm", "revenue_py", "revenue_ytd", "revenue_rolling_3m", "revenue_mom_pct", "revenue_yoy_pct", "yoy_colour",
)
# Measures of who buys for the first time, again, or in the month after.
FLOW_MEASURES = ("new_customers", "returning_customers", "retained_customers_mom", "customer_retention_rate_mom")
SHARE_MEASURES = ("revenue_share_pct",)


class Measures:
    """The semantic layer of a warehouse for one user."""

    def __init__(self, warehouse: Warehouse, spark, user: str | None = None, restricted: bool = True):
        """``restricted=False`` is a user who may see every country."""
        self.warehouse = warehouse
        self.user = user if restricted else None
        self.spark = spark

    # ---- row-level security ---------------------------------------------------------------

    @property
    def customers(self) -> DataFrame:
        everyone = self.warehouse.dim_customer
        if self.user is None:
            return everyone
        return visible_customers(everyone, country_grants(self.spark), self.user)

    def _visible(self, facts: DataFrame) -> DataFrame:
        """The filter on customers reaches every table with a customer key."""
        return facts if self.user is None else visible_facts(facts, self.customers)

    # ---- filter context -------------------------------------------------------------------

    def _order_grain(self, columns: Sequence[str], where: Column | None, per_customer: bool = True) -> DataFrame:
        revenue_order = F.col("is_revenue_order")
        sums = [
            F.sum("net_revenue_usd").alias("net"),
            F.coalesce(F.sum(F.when(revenue_order, F.col("gross_amount_usd"))), F.lit(0)).alias("gross"),
            F.coalesce(F.sum(F.when(revenue_order, F.col("discount_amount_usd"))), F.lit(0)).alias("discount"),
            F.count_if(revenue_order).alias("completed"),
            F.count_if(F.col("status") == "refunded").alias("refunded"),
            F.count("*").alias("all_orders"),
            F.max("order_date").alias("last_date"),
        ]
        return self._grain(self.warehouse.fct_orders, FACT_COLUMNS, columns, where, sums, per_customer)

    def _line_grain(self, columns: Sequence[str], where: Column | None, per_customer: bool = True) -> DataFrame:
        sums = [F.sum("net_revenue_usd").alias("net")]
        return self._grain(self.warehouse.fct_order_items, (*LINE_COLUMNS, "order_date"), columns, where, sums, per_customer)

    def _grain(
        self, facts, own: Sequence[str], columns: Sequence[str], where: Column | None, sums, per_customer: bool
    ) -> DataFrame:
        """One row per customer and requested column of the fact, with the customer's columns.

        Where nothing asks for customers, ``per_customer`` or by a column or security, rows are those of the columns
        alone: few, added up before anything is shuffled.
        """
        dated = [c for c in columns if c in DATE_COLUMNS]
        of_fact = [c for c in columns if c in own]
        of_customer = [c for c in columns if c in CUSTOMER_COLUMNS]
        unknown = set(columns) - {*dated, *of_fact, *of_customer}
        if unknown:
            raise ValueError(f"no such column for these measures: {sorted(unknown)}")
        grain = facts.withColumns({c: DATE_COLUMNS[c](F.col("order_date")) for c in dated})
        met = bool(of_customer) or self.user is not None
        keys = [*(["customer_id"] if met or per_customer else []), *dated, *of_fact]
        # a constant key: without facts there is no row
        grain = grain.groupBy(*(keys or [F.lit(0).alias("_all")])).agg(*sums)
        # security too applies to one row per customer and requested column: no order is shuffled for it
        if met:
            grain = grain.join(self.customers.select("customer_id", *of_customer), "customer_id")
        return grain if where is None else grain.filter(where)

    def evaluate(
        self,
        measures: Sequence[str],
        by: Sequence[str] = (),
        where: Column | None = None,
        where_columns: Sequence[str] = (),
        dates: Column | None = None,
    ) -> DataFrame:
        """One row per combination of ``by``.

        ``where`` may use ``by`` and ``where_columns``. ``dates`` is a filter on date columns of ``by``: measures
        that move the date filter see beyond it, as do the months before a customer's first one.
        """
        asked = [*dict.fromkeys([*by, *where_columns])]
        line_level = any(c in LINE_COLUMNS for c in asked)
        grain = self._line_grain if line_level else self._order_grain
        order_measures = {"total_revenue": ORDER_MEASURES["total_revenue"]} if line_level else ORDER_MEASURES
        catalog = (
            (order_measures, lambda: grain(asked, where, any(m in _OF_CUSTOMERS for m in measures))),
            (LTV_MEASURES, lambda: self._filtered(self._visible(self.warehouse.customer_ltv), where)),
            (RFM_MEASURES, lambda: self._filtered(self._visible(self.warehouse.rfm_segments), where)),
            (COHORT_MEASURES, lambda: self._filtered(self.warehouse.cohort_retention, where)),
        )
        parts = []
        for family, base in catalog:
            wanted = [m for m in measures if m in family]
            if wanted:
                parts.append((wanted, base().groupBy(*by).agg(*[family[m]().alias(m) for m in wanted])))
        for family, build in (
            (TIME_MEASURES, lambda: self._time_part(by, where, where_columns)),
            (FLOW_MEASURES, lambda: self._flow_part(by, where, where_columns)),
            (SHARE_MEASURES, lambda: self._share_part(by, where, where_columns)),
        ):
            wanted = [m for m in measures if m in family]
            if wanted:
                parts.append((wanted, build().select(*by, *wanted)))
        missing = set(measures) - {m for wanted, _ in parts for m in wanted}
        if missing:
            raise ValueError(f"no such measure for these columns: {sorted(missing)}")
        result = parts[0][1]
        for wanted, part in parts[1:]:
            if by:
                result = result.join(part, list(by), "full_outer")
            else:
                result = result.withColumns({m: part.select(m).scalar() for m in wanted})
        return self._filtered(result.select(*by, *measures), dates)

    def _time_part(self, by: Sequence[str], where: Column | None, where_columns: Sequence[str]) -> DataFrame:
        dated = {c for c in by if c in DATE_COLUMNS or c == "order_date"}
        grain = next((g for g, needed in _GRAINS if needed <= dated), None)
        if grain is None:
            raise ValueError("measures that move the date filter are asked for by day, month, quarter or year")
        others = [c for c in by if c not in dated]
        if dated == {"order_month"}:
            return self.time_intelligence(others, where, where_columns)
        moved = self.moved_revenue(grain, others, where, where_columns)
        columns = {c: F.col("period") if c == "order_date" else DATE_COLUMNS[c](F.col("period")) for c in dated}
        return moved.withColumns(columns)

    def _share_part(self, by: Sequence[str], where: Column | None, where_columns: Sequence[str]) -> DataFrame:
        return self.revenue_share(
            [c for c in by if c not in DATE_COLUMNS], [c for c in by if c in DATE_COLUMNS], where, where_columns
        )

    def _flow_part(self, by: Sequence[str], where: Column | None, where_columns: Sequence[str]) -> DataFrame:
        """New, returning and retained customers in any period and group of customers.

        A purchase counts its customer as a buyer of its period, and as a buyer before the period that the month
        after it is in. One aggregation per customer and period then replaces the intersection of two sets.
        """
        dated = [c for c in by if c in DATE_COLUMNS]
        others = [c for c in by if c not in DATE_COLUMNS]
        if (set(others) | set(where_columns)) - set(CUSTOMER_COLUMNS):
            return self._flow_of_sets(by, where, where_columns)
        months = self._order_grain([*dict.fromkeys(["order_month", *others, *where_columns])], where)
        last = months.agg(F.max("order_month").alias("last"))
        counted = F.array(
            F.struct(F.col("order_month").alias("day"), F.lit(True).alias("now")),
            F.struct(F.add_months("order_month", 1).alias("day"), F.lit(False).alias("now")),
        )
        seen = months.filter("completed > 0").select("customer_id", *others, F.explode(counted).alias("m"))
        seen = seen.filter(F.col("m.day") <= last.scalar())
        seen = seen.select("customer_id", *others, "m.now", *[DATE_COLUMNS[c](F.col("m.day")).alias(c) for c in dated])
        buyers = (
            seen.groupBy("customer_id", *by)
            .agg(F.bool_or("now").alias("now"), F.bool_or(~F.col("now")).alias("before"))
            .groupBy(*by)
            .agg(
                F.count_if("now").alias("_active"),
                F.count_if("before").alias("_before"),
                F.count_if(F.col("now") & F.col("before")).alias("retained_customers_mom"),
            )
        )
        return self._flow(buyers, by, by, self._filtered(self.customers, where))

    def _flow_of_sets(self, by: Sequence[str], where: Column | None, where_columns: Sequence[str]) -> DataFrame:
        """The same by columns of orders too, from the sets of buyers of the finest cells.

        First purchases are a column of customers, which a column of orders does not filter: new customers are those of
        the period, whatever the order. So ``where`` may be on columns of the one or of the other.
        """
        asked = [*dict.fromkeys([*by, *where_columns])]
        dated = [c for c in by if c in DATE_COLUMNS]
        of_cell = [c for c in asked if c in BUYER_CELLS and c not in dated]
        of_customer = [c for c in asked if c in CUSTOMER_COLUMNS]
        unknown = set(asked) - {*dated, *of_cell, *of_customer}
        if unknown:
            raise ValueError(f"buyers are counted by {BUYER_CELLS}, dates and columns of customers, not by {sorted(unknown)}")
        if where_columns and set(where_columns) & set(of_cell) and set(where_columns) & set(of_customer):
            raise ValueError("a filter is on columns of orders or on columns of customers")
        cells = self.warehouse.buyer_sets
        if of_customer or self.user is not None:
            known = self.customers.select("customer_id", *of_customer).join(self.warehouse.customer_numbers, "customer_id")
            cells = distinct.cut(cells, distinct.sets(known, "number", of_customer), of_customer)
        cells = self._filtered(cells, where)
        last = self.warehouse.fct_orders.agg(F.max("order_month")).scalar()
        counted = F.array(
            F.struct(F.col("order_month").alias("day"), F.lit(True).alias("now")),
            F.struct(F.add_months("order_month", 1).alias("day"), F.lit(False).alias("now")),
        )
        # a set counts for its own month and, as buyers before, for the next
        seen = cells.select("*", F.explode(counted).alias("m")).filter(F.col("m.day") <= last)
        others = [c for c in by if c not in dated]
        seen = seen.select(*others, distinct.BLOCK, distinct.BITS, "m.now", *[DATE_COLUMNS[c](F.col("m.day")).alias(c) for c in dated])
        sizes = distinct.two_sets(seen, by, F.col("now"))
        sizes = sizes.filter((F.col("first") > 0) | (F.col("second") > 0))  # what was cut away altogether
        sizes = sizes.withColumnsRenamed({"first": "_active", "second": "_before", "both": "retained_customers_mom"})
        new = self.customers if set(where_columns) & set(of_cell) else self._filtered(self.customers, where)
        return self._flow(sizes, by, [c for c in by if c not in of_cell], new)

    def _flow(self, buyers: DataFrame, by: Sequence[str], on: Sequence[str], customers: DataFrame) -> DataFrame:
        """The measures of FLOW_MEASURES from counts of buyers by ``by`` and first purchases by ``on``."""
        first = customers.filter(F.col("first_order_date").isNotNull())
        first = first.withColumns({c: DATE_COLUMNS[c](F.col("first_order_date")) for c in on if c in DATE_COLUMNS})
        first = first.groupBy(*on).agg(F.count("*").alias("_new"))
        both = buyers.join(first, list(on), "left") if on else buyers.withColumn("_new", first.scalar())
        new = F.coalesce("_new", F.lit(0))
        return both.select(
            *by,
            new.alias("new_customers"),
            (F.col("_active") - new).alias("returning_customers"),
            "retained_customers_mom",
            ratio(F.col("retained_customers_mom"), F.col("_before"), RATE).alias("customer_retention_rate_mom"),
        )

    @staticmethod
    def _filtered(df: DataFrame, where: Column | None) -> DataFrame:
        return df if where is None else df.filter(where)

    # ---- measures that move the date filter -------------------------------------------------

    def time_intelligence(
        self, by: Sequence[str] = (), where: Column | None = None, where_columns: Sequence[str] = ()
    ) -> DataFrame:
        """Previous month and year, year to date and rolling quarter on a dense calendar."""
        orders = self._visible(self.warehouse.fct_orders)
        sold = self.evaluate(["total_revenue"], ["order_month", *by], where, where_columns)
        span = orders.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
        if by:
            ends = {c: span.select(c).scalar() for c in span.columns}
            span = sold.select(*by).distinct().withColumns(ends)
        dense = month_spine(span, by).join(sold, ["order_month", *by], "left")

        in_order = Window.partitionBy(*by).orderBy("order_month")
        in_year = Window.partitionBy(*by, F.year("order_month")).orderBy("order_month")
        revenue = F.col("total_revenue")
        moved = dense.select(
            "order_month",
            *by,
            "total_revenue",
            F.lag(revenue).over(in_order).alias("revenue_pm"),
            F.lag(revenue, 12).over(in_order).alias("revenue_py"),
            F.sum(revenue).over(in_year.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("revenue_ytd"),
            F.sum(revenue).over(in_order.rowsBetween(-2, 0)).alias("revenue_rolling_3m"),
        )

        return self._with_changes(moved)

    def moved_revenue(
        self, grain: str, by: Sequence[str] = (), where: Column | None = None, where_columns: Sequence[str] = ()
    ) -> DataFrame:
        """The measures that move the date filter for each ``period`` of a grain: day, month, quarter or year.

        Revenue is added up per day and group first; each of these rows then names the periods it counts for.
        """
        sold = self.evaluate(["total_revenue"], ["order_date", *by], where, where_columns)
        # a row per day and group, read for the bounds, the groups and the sums: the facts are read once
        sold = self.warehouse.store.scratch(sold, "sold")
        names = dict(zip(periods.MOVED, ("total_revenue", "revenue_pm", "revenue_py", "revenue_ytd", "revenue_rolling_3m")))
        return self._with_changes(periods.moved_sums(sold, "order_date", "total_revenue", grain, by).withColumnsRenamed(names))

    @staticmethod
    def _with_changes(moved: DataFrame) -> DataFrame:
        def change(before: str) -> Column:
            now = F.coalesce(cents(F.col("total_revenue")), F.lit(0))
            return signed_ratio(now - cents(F.col(before)), cents(F.col(before)), RATE)

        changed = moved.withColumns(
            {"revenue_mom_pct": change("revenue_pm"), "revenue_yoy_pct": change("revenue_py")}
        )
        # no base year counts as no decline
        rising = F.coalesce(F.col("revenue_yoy_pct"), F.lit(0)) >= 0
        return changed.withColumn("yoy_colour", F.when(rising, RISING).otherwise(FALLING))

    def revenue_share(
        self,
        by: Sequence[str],
        within: Sequence[str] = (),
        where: Column | None = None,
        where_columns: Sequence[str] = (),
    ) -> DataFrame:
        """Share of the revenue of all selected customers, per ``within``."""
        sold = self.evaluate(["total_revenue"], [*within, *by], where, where_columns)
        if within:
            whole = sold.groupBy(*within).agg(F.sum("total_revenue").alias("_whole"))
            sold = sold.join(whole, list(within))
        else:
            sold = sold.withColumn("_whole", sold.agg(F.sum("total_revenue")).scalar())
        share = ratio(cents(F.col("total_revenue")), cents(F.col("_whole")), RATE)
        return sold.select(*within, *by, "total_revenue", share.alias("revenue_share_pct"))

    def customer_activity(self) -> DataFrame:
        """Active, new and returning customers by month."""
        active = self.evaluate(["active_customers", "total_revenue", "revenue_per_customer"], ["order_month"])
        new = (
            self.customers.filter(F.col("first_order_date").isNotNull())
            .groupBy(month_start(F.col("first_order_date")).alias("order_month"))
            .agg(F.count("*").alias("new_customers"))
        )
        return active.join(new, "order_month", "left").select(
            "order_month",
            "active_customers",
            F.coalesce("new_customers", F.lit(0)).alias("new_customers"),
            (F.col("active_customers") - F.coalesce("new_customers", F.lit(0))).alias("returning_customers"),
            "revenue_per_customer",
        )

    def retained_month_over_month(self) -> DataFrame:
        """Customers who bought in a month and in the month before it.

        Each buyer is counted under its month and, as a prior buyer, under the next one. One
        aggregation per (customer, month) then replaces the intersection of two sets per month.
        """
        orders = self._visible(self.warehouse.fct_orders)
        last = orders.agg(F.max("order_month")).scalar()
        counted = F.array(
            F.struct(F.col("order_month").alias("order_month"), F.lit(True).alias("now")),
            F.struct(F.add_months("order_month", 1).alias("order_month"), F.lit(False).alias("now")),
        )
        buyers = (
            orders.filter("is_revenue_order")
            .select("customer_id", F.explode(counted).alias("m"))
            .groupBy("customer_id", "m.order_month")
            .agg(F.bool_or("m.now").alias("now"), F.bool_or(~F.col("m.now")).alias("before"))
            .groupBy("order_month")
            .agg(
                F.count_if("now").alias("active_customers"),
                F.count_if("before").alias("prior_customers"),
                F.count_if(F.col("now") & F.col("before")).alias("retained_customers_mom"),
            )
        )
        return (
            buyers.filter(F.col("order_month") <= last)
            .select(
                "order_month",
                "active_customers",
                "prior_customers",
                "retained_customers_mom",
                ratio(F.col("retained_customers_mom"), F.col("prior_customers"), RATE).alias(
                    "customer_retention_rate_mom"
                ),
            )
        )

    # ---- dashboard visuals ------------------------------------------------------------------

    def channel_year_matrix(self) -> DataFrame:
        sold = self.evaluate(["total_revenue", "discount_rate_pct"], ["sales_channel", "year"])
        before = sold.select(
            "sales_channel", (F.col("year") + 1).alias("year"), F.col("total_revenue").alias("revenue_py")
        )
        change = cents(F.col("total_revenue")) - cents(F.col("revenue_py"))
        return sold.join(before, ["sales_channel", "year"], "left").select(
            "sales_channel",
            "year",
            "total_revenue",
            signed_ratio(change, cents(F.col("revenue_py")), RATE).alias("revenue_yoy_pct"),
            "discount_rate_pct",
        )

    def lifecycle_by_segment(self) -> DataFrame:
        return self.evaluate(["customers"], ["segment", "lifecycle_status"])

    def clv_by_channel(self) -> DataFrame:
        return self.evaluate(["avg_predicted_clv", "customers"], ["acquisition_channel"])

    def rfm_donut(self) -> DataFrame:
        scored = self._visible(self.warehouse.rfm_segments)
        return scored.groupBy("rfm_segment").agg(
            F.count("*").alias("customers"), F.sum("monetary_usd").alias("revenue_usd")
        )

    def revenue_by_country(self) -> DataFrame:
        return self.evaluate(["total_revenue", "completed_orders", "active_customers"], ["country"])
