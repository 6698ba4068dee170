"""Facts and dimensions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import MONEY, money
from ledgerloom.functions.temporal import FAR_FUTURE, calendar, moment, month_start
from ledgerloom.operators.upsert import reprocess_from, upsert
from ledgerloom.params import Params
from ledgerloom.plans.staging import stg_order_items, stg_orders


def order_items_converted(
    items: DataFrame, orders: DataFrame, fx_rates: DataFrame, products: DataFrame
) -> DataFrame:
    """Order lines with their order, in USD, net of the order's discount.

    No side carries a broadcast hint: Spark broadcasts rates and products while they are below its
    size limit and shuffles them beyond it. Orders, rates and products are written tables, so both
    sides of each join come straight out of a shuffle and Spark can split an order or a product that
    holds a large share of the lines. Cleaning lets a line through whose amount fits decimal(18,2) and a
    rate that fits decimal(12,6), so the product is an exact decimal(38,12) and the only rounding is the
    one to cents.
    """
    return (
        items.drop("_loaded_at")
        .join(orders.drop("_batch_id", "_loaded_at"), "order_id")
        .join(fx_rates, "currency")
        .join(products.select("product_id", "category"), "product_id")
        .select(
            "order_item_id",
            "order_id",
            "line_number",
            "product_id",
            "category",
            "customer_id",
            "order_date",
            month_start(F.col("order_date")).alias("order_month"),
            "status",
            "currency",
            "ingested_at",
            "quantity",
            "unit_price_local",
            money(_local_amount()).alias("line_amount_local"),
            *_amounts(),
        )
    )


def _local_amount() -> Column:
    return (F.col("quantity").cast("decimal(10,0)") * F.col("unit_price_local")).cast("decimal(18,2)")


def _amounts() -> list[Column]:
    usd = _local_amount() * F.col("rate_to_usd").cast("decimal(12,6)")
    net = usd * (F.lit(Decimal(1)) - F.col("discount_pct"))
    return [
        money(usd).alias("line_amount_usd"),
        F.when(F.col("status") == "completed", money(net))
        .otherwise(F.lit(Decimal(0)).cast(MONEY))
        .alias("net_revenue_usd"),
    ]


def priced_lines(items: DataFrame, orders: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """What an order's sums need of its lines, for lines whose product is known to exist.

    The id is handed on as a value of its own. So adding up per order sends one row per order once more, and the
    join above may split a hot order: Spark does so only where no later step relies on the layout of the join.
    """
    return (
        items.select("order_id", "quantity", "unit_price_local")
        .join(orders.select("order_id", "status", "currency", "discount_pct"), "order_id")
        .join(fx_rates, "currency")
        .select(F.concat("order_id", F.lit("")).alias("order_id"), "quantity", *_amounts())
    )


def fct_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per order that has lines."""
    totals = lines.groupBy("order_id").agg(
        F.count("*").alias("line_count"),
        F.sum("quantity").alias("units"),
        F.sum("line_amount_usd").alias("gross_amount_usd"),
        F.sum("net_revenue_usd").alias("net_revenue_usd"),
    )
    return orders.join(totals, "order_id").select(
        "order_id",
        "customer_id",
        "order_ts",
        "order_date",
        month_start(F.col("order_date")).alias("order_month"),
        "status",
        (F.col("status") == "completed").alias("is_revenue_order"),
        "sales_channel",
        "currency",
        "discount_pct",
        "line_count",
        "units",
        "gross_amount_usd",
        money(F.col("gross_amount_usd") * F.col("discount_pct")).alias("discount_amount_usd"),
        "net_revenue_usd",
        "ingested_at",
    )


def changed_orders(raw_orders: DataFrame, existing: DataFrame, params: Params) -> DataFrame:
    """Orders whose newest delivery falls in the lookback.

    The filter runs on RAW, before the newest delivery is picked: a delivery that is newest and
    recent is still newest among the recent ones. So only days of data are read and shuffled.
    """
    since = reprocess_from(existing, "ingested_at", params.lookback_days)
    recent = raw_orders if since is None else raw_orders.filter(F.col("ingested_at") >= moment(since))
    return stg_orders(recent)


def changed_lines(
    orders: DataFrame, raw_items: DataFrame, fx_rates: DataFrame, products: DataFrame
) -> DataFrame:
    """The lines of the changed orders."""
    items = stg_order_items(raw_items.join(orders.select("order_id"), "order_id", "left_semi"))
    return order_items_converted(items, orders, fx_rates, products)


def fct_order_items_incremental(existing: DataFrame, delta: DataFrame) -> DataFrame:
    return upsert(existing, delta, "order_item_id")


def fct_orders_incremental(existing: DataFrame, delta: DataFrame) -> DataFrame:
    return upsert(existing, delta, "order_id")


def dim_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Current attributes plus a summary of completed purchases."""
    purchases = (
        orders.filter("is_revenue_order")
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count("*").alias("completed_orders"),
            F.sum("net_revenue_usd").alias("lifetime_revenue_usd"),
        )
    )
    return customers.join(purchases, "customer_id", "left").select(
        "customer_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "country",
        "segment",
        "acquisition_channel",
        "signup_date",
        month_start(F.col("signup_date")).alias("signup_month"),
        "first_order_date",
        month_start(F.col("first_order_date")).alias("first_order_month"),
        "last_order_date",
        F.coalesce("completed_orders", F.lit(0)).alias("completed_orders"),
        F.coalesce("lifetime_revenue_usd", F.lit(Decimal(0))).cast("decimal(28,2)").alias("lifetime_revenue_usd"),
        F.col("completed_orders").isNotNull().alias("is_paying_customer"),
    )


def dim_customer_history(history: DataFrame) -> DataFrame:
    """Every version of a customer's attributes."""
    return history.select(
        "customer_version_key",
        "customer_id",
        "segment",
        "country",
        "acquisition_channel",
        "valid_from",
        F.coalesce("valid_to", moment(FAR_FUTURE)).alias("valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "category", "list_price_usd")


def dim_date(orders: DataFrame, params: Params) -> DataFrame:
    """A row per day. Without fixed ends it covers the whole years in which orders exist."""
    first = F.trunc(F.min("order_date"), "YEAR") if params.calendar_start is None else F.lit(params.calendar_start)
    after = (
        F.add_months(F.trunc(F.max("order_date"), "YEAR"), 12)
        if params.calendar_end is None
        else F.lit(params.calendar_end)
    )
    days = calendar(orders.agg(first.alias("first_day"), after.alias("end_day")))
    day = F.col("date_day")
    return days.select(
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        month_start(day).alias("month_start"),
        F.concat(F.year(day).cast("string"), F.lit("-"), F.lpad(F.month(day).cast("string"), 2, "0")).alias(
            "year_month"
        ),
    )
