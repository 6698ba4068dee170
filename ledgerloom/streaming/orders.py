"""Order changes as a stream.

A micro-batch is cleaned by the same rules as a file, rejects go to quarantine, and accepted rows
replace the batch's own folder of the landing table. A replayed micro-batch therefore changes
nothing, late rows need no watermark, and the newest delivery is picked in staging. No micro-batch
rewrites what earlier ones landed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.temporal import as_instant, as_utc, parse_utc
from ledgerloom.functions.text import strip
from ledgerloom.operators.rules import REASON, rejected
from ledgerloom.plans.cleaning import judge_orders, settle, split_empty_orders
from ledgerloom.plans.staging import newest, stg_orders
from ledgerloom.sources.catalog import Catalog
from ledgerloom.sources.lake import drop_batch, read_batches, replace_batch
from ledgerloom.sources.schemas import LINE, text_schema
from ledgerloom.streaming.latest import Latest

MICRO_BATCH = "_micro_batch"


def order_feed(
    spark: SparkSession, path: str, extra: Sequence[str] = (), files_per_batch: int | None = None
) -> DataFrame:
    """The feed as JSON lines, everything as text; ``LINE`` is the text of one that cannot be read. Without ``files_per_batch`` one micro-batch takes all that waits."""
    schema = text_schema("orders")
    for column in extra:
        schema = schema.add(column, "string")
    reader = spark.readStream.schema(schema.add(LINE, "string")).option("columnNameOfCorruptRecord", LINE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def without_exact_redeliveries(feed: DataFrame, stamp: str, lookback: str = "3 days") -> DataFrame:
    """Drop copies of the same delivery that arrive within the lookback; state is bounded by it."""
    return feed.withWatermark(stamp, lookback).dropDuplicatesWithinWatermark(["order_id", stamp])


def land_orders(
    feed: DataFrame,
    customers: DataFrame,
    fx_rates: DataFrame,
    landing: str,
    quarantine: str,
    progress: str,
    scope: Sequence[str] = (),
    state: Latest | None = None,
) -> None:
    """Take in everything that is waiting, then stop. With a ``state`` landed folders are folded into it."""

    def land(rows: DataFrame, micro_batch: int) -> None:
        name = f"{micro_batch:09d}"
        # judged once, and both halves are taken from what was written
        replace_batch(judge_orders(rows, customers, fx_rates, scope), f"{quarantine}_judged", name, MICRO_BATCH)
        judged = rows.sparkSession.read.parquet(f"{quarantine}_judged/{MICRO_BATCH}={name}")
        replace_batch(rejected(judged), quarantine, name, MICRO_BATCH)
        replace_batch(settle(judged, "orders", scope), landing, name, MICRO_BATCH)
        drop_batch(rows.sparkSession, f"{quarantine}_judged", name, MICRO_BATCH)  # both halves are there
        if state is not None:
            state.fold(micro_batch)

    query = (
        feed.writeStream.foreachBatch(land)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed_orders(spark: SparkSession, landing: str, schema: StructType) -> DataFrame:
    return read_batches(spark, landing, schema, MICRO_BATCH)


def latest_from_stream(warehouse) -> DataFrame:
    """Write the order feed as files, stream them in, and take the newest delivery of each order."""
    spark, store = warehouse.store.spark, warehouse.store
    base = store.path(store.unique("stream"))
    feed_path = f"{base}/feed"
    warehouse.extracts["orders"].drop("_src_pos").write.mode("overwrite").option("ignoreNullFields", False).json(feed_path)
    landing = f"{base}/landing"
    land_orders(
        order_feed(spark, feed_path, ["_batch_id"]),
        warehouse.settled_customers,
        warehouse.settled_fx_rates,
        landing,
        f"{base}/quarantine",
        f"{base}/progress",
        ["_batch_id"],
    )
    schema = warehouse.judged_orders.drop("_src_pos", REASON).schema
    landed = landed_orders(spark, landing, schema).drop(MICRO_BATCH)
    loads = F.create_map(*[F.lit(v) for pair in warehouse.loaded_at.items() for v in pair])
    stamped = landed.withColumn("_loaded_at", F.element_at(loads, F.col("_batch_id")).cast("timestamp_ntz"))
    # the same rule as for files: an order without accepted lines is not staged
    return stg_orders(split_empty_orders(stamped, warehouse.filled_orders, ["_batch_id"])[0])


def folded_from_stream(warehouse, parts: int = 4, every: int = 2) -> DataFrame:
    """The same in several micro-batches, of which every few are folded into the newest orders."""
    spark, store = warehouse.store.spark, warehouse.store
    base = store.path(store.unique("folded"))
    feed = warehouse.extracts["orders"].drop("_src_pos").repartition(parts, "order_ts", "status")
    feed.write.option("ignoreNullFields", False).json(f"{base}/feed")
    schema = warehouse.judged_orders.drop("_src_pos", REASON).schema
    loads = F.create_map(*[F.lit(v) for pair in warehouse.loaded_at.items() for v in pair])

    def accepted(folders: list[str]) -> DataFrame:
        landed = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
        stamped = landed.withColumn("_loaded_at", F.element_at(loads, F.col("_batch_id")).cast("timestamp_ntz"))
        return split_empty_orders(stamped, warehouse.filled_orders, ["_batch_id"])[0]

    landing = f"{base}/landing"
    state = Latest(Catalog(spark, f"{base}/state"), "orders", landing, MICRO_BATCH, "order_id", lambda: newest("ingested_at"), accepted, every)
    land_orders(
        order_feed(spark, f"{base}/feed", ["_batch_id"], files_per_batch=1),
        warehouse.settled_customers,
        warehouse.settled_fx_rates,
        landing,
        f"{base}/quarantine",
        f"{base}/progress",
        ["_batch_id"],
        state,
    )
    return stg_orders(state.rows())


def once_from_stream(warehouse) -> DataFrame:
    """Deliver the order feed twice as files and stream it without exact re-deliveries."""
    spark, store = warehouse.store.spark, warehouse.store
    base = store.path(store.unique("stream"))
    rows = warehouse.extracts["orders"].select(
        F.upper(strip(F.col("order_id"))).alias("order_id"),
        as_instant(parse_utc(F.col("ingested_at"))).alias("ingested_at"),
    )
    for _ in range(2):
        rows.write.mode("append").parquet(f"{base}/feed")
    feed = spark.readStream.schema(rows.schema).parquet(f"{base}/feed")
    query = (
        without_exact_redeliveries(feed, "ingested_at")
        .writeStream.format("parquet")
        .option("path", f"{base}/once")
        .option("checkpointLocation", f"{base}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    once = spark.read.schema(rows.schema).parquet(f"{base}/once")
    return once.withColumn("ingested_at", as_utc(F.col("ingested_at")))
