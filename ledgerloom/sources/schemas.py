"""Extract layouts. Everything is text on extract; typing happens while cleaning."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# The column names of the five extracts.
EXTRACT_COLUMNS = {
    "customers": (
        "customer_id", "first_name", "last_name", "email", "country", "segment",
        "acquisition_channel", "signup_date", "updated_at",
    ),
    "orders": (
        "order_id", "customer_id", "order_ts", "currency", "status", "sales_channel",
        "discount_pct", "ingested_at",
    ),
    "order_items": ("order_id", "line_number", "product_id", "quantity", "unit_price"),
    "products": ("product_id", "product_name", "category", "list_price_usd"),
    "fx_rates": ("currency", "rate_to_usd"),
}

# Where a row of an extract comes from: the text of a line that cannot be read, its file, the part of the file.
LINE, FILE, BLOCK = TRACE = ("_line", "_source_file", "_source_block")

# Load order: parents first.
TABLES = ("fx_rates", "products", "customers", "orders", "order_items")


def text_schema(table: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in EXTRACT_COLUMNS[table]])


LOADED_AT = StructField("_loaded_at", TimestampNTZType())

RUNS = StructType(
    [
        StructField("run_id", StringType()),
        StructField("stage", StringType()),
        StructField("target", StringType()),
        StructField("status", StringType()),
        StructField("started_at", TimestampNTZType()),
        StructField("finished_at", TimestampNTZType()),
        StructField("duration_seconds", DoubleType()),
        StructField("metrics", StringType()),
        StructField("error_message", StringType()),
    ]
)

CHECK_RESULTS = StructType(
    [
        StructField("run_id", StringType()),
        StructField("checked_at", TimestampNTZType()),
        StructField("table_name", StringType()),
        StructField("check_name", StringType()),
        StructField("severity", StringType()),
        StructField("passed", BooleanType()),
        StructField("detail", StringType()),
    ]
)

# Landing tables hold cleaned rows; the batch id is the partition folder.
LANDED = {
    "customers": StructType(
        [StructField(c, StringType()) for c in EXTRACT_COLUMNS["customers"][:7]]
        + [StructField("signup_date", DateType()), StructField("updated_at", TimestampNTZType()), LOADED_AT]
    ),
    "orders": StructType(
        [
            StructField("order_id", StringType()),
            StructField("customer_id", StringType()),
            StructField("order_ts", TimestampNTZType()),
            StructField("currency", StringType()),
            StructField("status", StringType()),
            StructField("sales_channel", StringType()),
            StructField("discount_pct", DecimalType(5, 4)),
            StructField("ingested_at", TimestampNTZType()),
            LOADED_AT,
        ]
    ),
    "order_items": StructType(
        [
            StructField("order_id", StringType()),
            StructField("line_number", IntegerType()),
            StructField("product_id", StringType()),
            StructField("quantity", IntegerType()),
            StructField("unit_price", DecimalType(14, 2)),
            LOADED_AT,
        ]
    ),
    "products": StructType(
        [
            StructField("product_id", StringType()),
            StructField("product_name", StringType()),
            StructField("category", StringType()),
            StructField("list_price_usd", DecimalType(12, 2)),
            LOADED_AT,
        ]
    ),
    "fx_rates": StructType(
        [StructField("currency", StringType()), StructField("rate_to_usd", DecimalType(18, 6)), LOADED_AT]
    ),
}
