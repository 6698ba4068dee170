"""Staging: the current version of every business key over all loaded batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.temporal import NTZ
from ledgerloom.operators.latest import latest_per_key


def newest(*stamps: str) -> list[Column]:
    """Newest stamp first; the batch id settles loads of the same moment."""
    return [F.col(s).desc_nulls_last() for s in (*stamps, "_loaded_at", "_batch_id")]


def stg_customers(raw: DataFrame) -> DataFrame:
    return latest_per_key(raw, ["customer_id"], newest("updated_at")).select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "country",
        "segment",
        "acquisition_channel",
        F.col("signup_date").cast("date").alias("signup_date"),
        F.col("updated_at").cast(NTZ).alias("updated_at"),
        "_batch_id",
        "_loaded_at",
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    """The order feed re-delivers an order when it changes; the newest delivery wins."""
    return latest_per_key(raw, ["order_id"], newest("ingested_at")).select(
        "order_id",
        "customer_id",
        F.col("order_ts").cast(NTZ).alias("order_ts"),
        F.col("order_ts").cast("date").alias("order_date"),
        "status",
        "sales_channel",
        "currency",
        F.col("discount_pct").cast("decimal(5,4)").alias("discount_pct"),
        F.col("ingested_at").cast(NTZ).alias("ingested_at"),
        "_batch_id",
        "_loaded_at",
    )


def stg_order_items(raw: DataFrame, within_batch: Sequence[Column] = ()) -> DataFrame:
    """``within_batch`` orders the deliveries of a line in one batch, where those are still in ``raw``."""
    return latest_per_key(raw, ["order_id", "line_number"], [*newest(), *within_batch]).select(
        F.concat(F.col("order_id"), F.lit("-"), F.col("line_number").cast("string")).alias("order_item_id"),
        "order_id",
        F.col("line_number").cast("int").alias("line_number"),
        "product_id",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("decimal(14,2)").alias("unit_price_local"),
        "_loaded_at",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return latest_per_key(raw, ["product_id"], newest()).select(
        "product_id", "product_name", "category", F.col("list_price_usd").cast("decimal(12,2)").alias("list_price_usd")
    )


def stg_fx_rates(raw: DataFrame) -> DataFrame:
    return latest_per_key(raw, ["currency"], newest()).select(
        "currency", F.col("rate_to_usd").cast("decimal(18,6)").alias("rate_to_usd")
    )
