"""Raw extracts derived from the benchmark tables.

Pure projections: every source row becomes one or more text rows of the extract with the defects a
real feed has (mixed formats, stray case and blanks, missing and impossible values, re-deliveries).
No row of a table is left out. Batch ``b1`` is the first full load. Batch ``b2`` is the next day's
delivery: customers, products and rates in full again, plus the orders that changed since.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.temporal import NTZ

# Fixed values of the derived feed.
COUNTRIES = ("US", "GB", "DE", "FR", "IN", "CA", "AU")
CURRENCIES = ("USD", "GBP", "EUR", "EUR", "INR", "CAD", "AUD")
FX_RATE_TO_USD = {"USD": "1.0", "EUR": "1.125", "GBP": "1.3334", "INR": "0.0157", "CAD": "0.8021", "AUD": "0.7312"}
CHANNELS = ("Newsletter", "Trade Fair", "Search", "Reseller", "Word of Mouth")
FIRST_NAMES = ("Ada", "Grace", "Alan", "Mary-Jane", "Edsger", "Barbara")
LAST_NAMES = ("Lovelace", "O'Brien", "Turing", "Hopper", "Van Rossum")
DISCOUNTS = ("0.05", "0.1", "0.15", "0.2")
BATCHES = {"b1": "2001-12-01 02:00:00", "b2": "2001-12-02 02:00:00"}


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _deliveries(*options: tuple[str, str, Column | None]) -> Column:
    """One array entry per delivery of the row: (batch, kind), kept when its condition holds."""
    entry = [
        F.when(F.lit(True) if cond is None else cond, F.struct(F.lit(b).alias("batch"), F.lit(k).alias("kind")))
        for b, k, cond in options
    ]
    return F.explode(F.filter(F.array(*entry), lambda d: d.isNotNull())).alias("d")


def _iso(ts: Column) -> Column:
    """``2001-10-15T08:00:00``; casting, unlike formatting, never looks at the session zone."""
    return F.translate(ts.cast("string"), " ", "T")


def _batch_columns() -> list[Column]:
    return [F.col("d.batch").alias("_batch_id")]


def customers(t: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    kind, batch = F.col("d.kind"), F.col("d.batch")
    signup = F.date_add(F.to_date(F.lit("1994-01-01")), (k % 365).cast("int"))
    age = (k % 400).cast("int") + F.when((batch == "b2") & (k % 10 == 5), 1460).otherwise(0)
    segment = (
        F.when(k % 250 == 11, "other")
        .when((batch == "b2") & (k % 10 == 5), "Enterprise")
        .when(F.col("c_mktsegment") == "BUILDING", "Enterprise")
        .when(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"), "SMB")
        .otherwise("Consumer")
    )
    first, last = _pick(FIRST_NAMES, k), _pick(LAST_NAMES, k)
    country = _pick(COUNTRIES, k)
    rows = t.select(
        "c_custkey",
        "c_mktsegment",
        _deliveries(
            ("b1", "main", None),
            ("b1", "stale", k % 50 == 0),
            ("b1", "noid", k == 0),
            ("b2", "main", k % 40 != 6),  # the others were deleted in the CRM
        ),
    )
    return rows.select(
        F.when(kind != "noid", F.concat(F.when(k % 10 == 0, "c").otherwise("C"), k.cast("string"))).alias("customer_id"),
        F.when(k % 20 == 0, F.concat(F.lit("  "), F.lower(first), F.lit(" "))).otherwise(first).alias("first_name"),
        F.when(k % 7 == 3, F.lower(last)).otherwise(last).alias("last_name"),
        F.when(k % 250 == 9, "not-an-email")
        .when(k % 12 == 0, F.concat(F.lit("CUSTOMER."), k.cast("string"), F.lit("@EXAMPLE.COM")))
        .otherwise(F.concat(F.lit("customer."), k.cast("string"), F.lit("@example.com")))
        .alias("email"),
        F.when(k % 97 != 0, F.when((country == "GB") & (k % 3 == 0), "uk").otherwise(country)).alias("country"),
        F.when(k % 25 == 0, F.upper(segment)).otherwise(segment).alias("segment"),
        F.when(k % 90 == 4, "").otherwise(_pick(CHANNELS, k)).alias("acquisition_channel"),
        F.when(k % 250 == 13, "2024-02-30")
        .when(k % 4 == 0, F.date_format(signup, "dd MMM yyyy"))
        .otherwise(signup.cast("string"))
        .alias("signup_date"),
        F.when(kind == "stale", "1990-01-01 00:00:00")
        .when(k % 60 == 30, F.concat(F.date_add(signup, age).cast("string"), F.lit("T02:00:00+02:00")))
        .otherwise(F.concat(F.date_add(signup, age).cast("string"), F.lit(" 00:00:00")))
        .alias("updated_at"),
        *_batch_columns(),
        kind.alias("_src_pos"),
    )


def orders(t: DataFrame) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    kind, batch = F.col("d.kind"), F.col("d.batch")
    placed = F.col("o_orderdate").cast(NTZ) + F.make_dt_interval(hours=F.lit(8), secs=(k % 54000).cast("decimal(18,6)"))
    two_hours_on = placed + F.make_dt_interval(hours=F.lit(2))
    received = placed + F.make_dt_interval(secs=(k % 86340 + 60).cast("decimal(18,6)"))
    status = (
        F.when(k % 500 == 9, "shipped")
        .when((kind == "again") | (k % 20 == 0), "refunded")
        .when(k % 20 == 1, "cancelled")
        .otherwise("completed")
    )
    currency = F.when(k % 500 == 13, "XYZ").otherwise(_pick(CURRENCIES, c))
    rows = t.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        "o_orderpriority",
        _deliveries(
            ("b1", "first", None),
            ("b1", "again", k % 100 == 57),
            ("b1", "noid", k == 0),
            ("b2", "again", k % 100 == 7),
        ),
    )
    return rows.select(
        F.when(kind != "noid", F.concat(F.lit("SO"), k.cast("string"))).alias("order_id"),
        F.concat(F.when(k % 250 == 3, "CX").otherwise("C"), c.cast("string")).alias("customer_id"),
        F.when(k % 333 == 5, None)
        .when(k % 5 == 0, placed.cast("string"))
        .when(k % 77 == 11, F.concat(_iso(two_hours_on), F.lit("+02:00")))
        .when(k % 77 == 12, F.concat(_iso(two_hours_on), F.lit("+02")))
        .when(k % 77 == 13, F.concat(_iso(two_hours_on), F.lit(" +02:00")))
        .when(k % 770 == 14, F.concat(_iso(placed), F.lit(" CET")))
        .otherwise(F.concat(_iso(placed), F.lit("Z")))
        .alias("order_ts"),
        F.when(k % 20 == 7, F.lower(currency)).otherwise(currency).alias("currency"),
        F.when(k % 33 == 0, F.upper(status)).otherwise(status).alias("status"),
        F.when(k % 400 == 2, None)
        .when(F.col("o_orderpriority").startswith("1"), "sales_rep")
        .when(F.col("o_orderpriority").startswith("2"), "web")
        .when(F.col("o_orderpriority").startswith("3"), "mobile_app")
        .otherwise("marketplace")
        .alias("sales_channel"),
        F.when(k % 640 == 4, "0.9")
        .when(k % 710 == 8, "n/a")
        .when(k % 10 < 3, _pick(DISCOUNTS, k))
        .otherwise("0")
        .alias("discount_pct"),
        F.when(kind != "again", F.concat(_iso(received), F.lit("Z")))
        .when(batch == "b1", "2001-10-15T00:00:00Z")
        .otherwise("2001-11-30T00:00:00Z")
        .alias("ingested_at"),
        *_batch_columns(),
        kind.alias("_src_pos"),
    )


def order_items(t: DataFrame) -> DataFrame:
    k = F.col("l_orderkey")
    mix = k + F.col("l_linenumber")
    quantity = F.greatest(F.col("l_quantity").cast("bigint"), F.lit(1).cast("bigint"))
    extended = (F.col("l_extendedprice").cast("decimal(14,2)") * F.lit(Decimal(100))).cast("bigint")
    unit_cents = F.call_function("div", extended * 2 + quantity, quantity * 2)
    price = (unit_cents.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast("decimal(14,2)").cast("string")
    delivered = (
        "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
    )
    rows = t.select(
        "l_orderkey",
        "l_linenumber",
        *delivered,
        _deliveries(("b1", "main", None), ("b2", "again", k % 100 == 7)),
    )
    return rows.select(
        F.concat(F.when(k % 11 == 2, "so").otherwise("SO"), k.cast("string")).alias("order_id"),
        F.when(mix % 1000 != 6, F.col("l_linenumber").cast("string")).alias("line_number"),
        F.when(mix % 500 == 4, "P-none")
        .otherwise(F.concat(F.when(F.col("l_partkey") % 9 == 0, "p").otherwise("P"), F.col("l_partkey").cast("string")))
        .alias("product_id"),
        F.when(mix % 20000 == 17, "10000000")
        .when(mix % 500 == 0, "0")
        .when(mix % 1000 == 1, "-1")
        .when(mix % 700 == 3, F.concat(quantity.cast("string"), F.lit(".0")))
        .otherwise(quantity.cast("string"))
        .alias("quantity"),
        F.when(mix % 500 == 2, None)
        .when(mix % 1000 == 8, "NaN")
        .when(mix % 20000 == 19, "10000000000.00")
        .when(mix % 3000 == 23, "1000000000000.00")
        .otherwise(price)
        .alias("unit_price"),
        *_batch_columns(),
        F.struct(*delivered).alias("_src_pos"),
    )


def products(t: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    kind = F.col("d.kind")
    rows = t.select(
        "p_partkey",
        "p_name",
        "p_type",
        "p_retailprice",
        _deliveries(
            ("b1", "main", None), ("b1", "noid", k == 0), ("b1", "free", k == 0), ("b2", "main", None),
        ),
    )
    return rows.select(
        F.when(kind == "free", "P-free")
        .when(kind == "main", F.concat(F.when(k % 9 == 0, "p").otherwise("P"), k.cast("string")))
        .alias("product_id"),
        F.when(k % 8 == 0, F.concat(F.lit("  "), F.col("p_name"))).otherwise(F.col("p_name")).alias("product_name"),
        F.when(k % 4 == 0, F.lower(F.col("p_type"))).otherwise(F.col("p_type")).alias("category"),
        F.when(kind == "free", "0")
        .otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
        .alias("list_price_usd"),
        *_batch_columns(),
        kind.alias("_src_pos"),
    )


def fx_rates(events: DataFrame) -> DataFrame:
    """A quote per event; the last usable quote of a currency is its rate."""
    k = F.col("event_id")
    known = _pick(CURRENCIES, F.col("user_id"))
    base = F.element_at(
        F.create_map(*[F.lit(v) for kv in FX_RATE_TO_USD.items() for v in kv]), known
    ).cast("decimal(10,6)")
    moved = (base + (k % 5).cast("decimal(1,0)") * F.lit(Decimal("0.0001"))).cast("decimal(10,6)")
    rows = events.select("event_id", "ts", "user_id", _deliveries(("b1", "main", None), ("b2", "main", None)))
    return rows.select(
        F.when(k % 20 == 7, "JPY")
        .when(k % 1000 != 3, F.when(k % 20 == 9, F.lower(known)).otherwise(known))
        .alias("currency"),
        F.when(k % 20 == 7, "-1")
        .when(k % 1000 == 11, "NaN")
        .when(k % 1000 == 13, "10000000")
        .otherwise(moved.cast("string"))
        .alias("rate_to_usd"),
        *_batch_columns(),
        F.struct("ts", "event_id").alias("_src_pos"),
    )


SOURCES = {
    "customers": ("customer", customers),
    "orders": ("orders", orders),
    "order_items": ("lineitem", order_items),
    "products": ("part", products),
    "fx_rates": ("events", fx_rates),
}


def source_paths(sf_dir: str) -> list[str]:
    return [f"{sf_dir}/{source}.parquet" for source, _ in SOURCES.values()]


def extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        name: shape(spark.read.parquet(f"{sf_dir}/{source}.parquet"))
        for name, (source, shape) in SOURCES.items()
    }


DAILY = {f"d{i:02d}": f"2002-01-{i:02d} 02:00:00" for i in range(1, 13)}


def daily_customers(customers: DataFrame) -> DataFrame:
    """Twelve daily deliveries of clean customers, in which some go missing, return, change, go back or lose their stamp."""
    k = F.substring("customer_id", 2, 20).cast("bigint")
    day = F.col("day")
    changes = F.floor(day * (k % 3) / 4).cast("int")
    older = (k % 10 == 3) & (day % 5 == 0)
    ahead = F.when(k % 20 == 5, changes * 150).otherwise(changes)  # some stamps lie in the future
    stamp = F.col("updated_at") + F.make_dt_interval(days=F.when(older, -1).otherwise(ahead))
    unknown = (k % 50 == 7) | ((k % 50 == 8) & (day % 3 == 0))
    rows = customers.drop("_batch_id").select("*", F.explode(F.sequence(F.lit(1), F.lit(len(DAILY)))).alias("day"))
    rows = rows.filter((k % 4 == 0) | ((k * 5 + day * 3) % 13 >= 2))
    return rows.select(
        F.concat(F.lit("d"), F.lpad(day.cast("string"), 2, "0")).alias("_batch_id"),
        "customer_id",
        F.when(changes % 2 == 1, "Enterprise").otherwise(F.col("segment")).alias("segment"),
        "country",
        "acquisition_channel",
        F.when(~unknown, stamp).alias("updated_at"),
    )


def run_log(events: DataFrame) -> DataFrame:
    """A log of stage runs, one run per event."""
    k = F.col("event_id")
    failed = k % 9 == 4
    return events.select(
        F.concat(F.lit("run-"), k.cast("string")).alias("run_id"),
        F.when(F.col("event_type").isin("view", "click"), "ingest")
        .when(F.col("event_type") == "purchase", "transform")
        .otherwise("publish")
        .alias("stage"),
        F.lit("prod").alias("target"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(secs=(k % 600).cast("decimal(18,6)"))).alias("finished_at"),
        (k % 600).cast("double").alias("duration_seconds"),
        F.when(failed, "boom").alias("error_message"),
    )


def check_log(events: DataFrame) -> DataFrame:
    """A log of data-quality results, one per event."""
    k = F.col("event_id")
    return events.select(
        F.concat(F.lit("run-"), k.cast("string")).alias("run_id"),
        F.col("ts").alias("checked_at"),
        F.when(k % 2 == 0, "orders").otherwise("customers").alias("table_name"),
        F.concat(F.lit("check-"), (k % 27).cast("string")).alias("check_name"),
        F.when(k % 7 == 0, "warning").otherwise("error").alias("severity"),
        (k % 5 != 3).alias("passed"),
        F.concat((k % 11).cast("string"), F.lit(" rows")).alias("detail"),
    )


def daily_landing(orders_raw: DataFrame) -> DataFrame:
    """The order feed as it would land daily: one batch per ingestion day, loaded at 02:00 the day after."""
    day = F.col("ingested_at").cast("date")
    return orders_raw.withColumns(
        {
            "_batch_id": F.date_format(day, "yyyyMMdd"),
            "_loaded_at": F.date_add(day, 1).cast(NTZ) + F.make_dt_interval(hours=F.lit(2)),
        }
    )
