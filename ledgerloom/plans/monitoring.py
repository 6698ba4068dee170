"""Monitoring queries. "Now" is always a parameter."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.latest import latest_per_key
from ledgerloom.operators.quality import union

WARN_HOURS, ERROR_HOURS = 26, 50
# Days after which a batch moves to the next storage tier or is deleted.
COOL_DAYS, RAW_DAYS, ARCHIVE_DAYS, DELETE_DAYS = 30, 90, 180, 2555


def latest_run_per_stage(runs: DataFrame) -> DataFrame:
    # of the rows of one run the one with its outcome
    newest = [F.col("started_at").desc_nulls_last(), F.col("run_id").desc(), F.col("finished_at").desc_nulls_last()]
    return latest_per_key(runs, ["stage"], newest).select(
        "stage", "run_id", "status", "started_at", "duration_seconds", "error_message"
    )


def failed_checks(results: DataFrame, now: Column, days: int = 7) -> DataFrame:
    recent = F.col("checked_at") >= now - F.make_dt_interval(days=F.lit(days))
    return (
        results.filter(~F.col("passed") & recent)
        .select("checked_at", "run_id", "table_name", "check_name", "severity", "detail")
        .orderBy(F.col("checked_at").desc(), "run_id")
    )


def rows_per_batch(raw: DataFrame, limit: int = 30) -> DataFrame:
    """The newest batches with their row counts, to see a change in volume."""
    return (
        raw.groupBy("_batch_id")
        .agg(F.min("_loaded_at").alias("loaded_at"), F.count("*").alias("order_rows"))
        .orderBy(F.col("loaded_at").desc(), "_batch_id")
        .limit(limit)
    )


def source_freshness(raw: Mapping[str, DataFrame], now: Column) -> DataFrame:
    """Age of the newest load of each landing table."""
    parts = [
        df.agg(F.max("_loaded_at").alias("max_loaded_at")).withColumn("table_name", F.lit(table))
        for table, df in raw.items()
    ]
    newest = F.col("max_loaded_at")

    def older_than(hours: int) -> Column:
        return newest < now - F.make_dt_interval(hours=F.lit(hours))

    return union(parts).select(
        "table_name",
        "max_loaded_at",
        F.when(newest.isNull() | older_than(ERROR_HOURS), "error")
        .when(older_than(WARN_HOURS), "warn")
        .otherwise("pass")
        .alias("freshness"),
    )


def classify_batches(raw: DataFrame, now: Column) -> DataFrame:
    """Storage tier of every batch, and whether the landing table still keeps it."""
    batches = raw.groupBy("_batch_id").agg(F.max("_loaded_at").alias("loaded_at"), F.count("*").alias("rows"))
    age = F.datediff(now.cast("date"), F.col("loaded_at").cast("date"))
    return batches.select(
        "_batch_id",
        "loaded_at",
        "rows",
        F.when(age > DELETE_DAYS, "delete")
        .when(age > ARCHIVE_DAYS, "archive")
        .when(age > COOL_DAYS, "cool")
        .otherwise("hot")
        .alias("tier"),
        (age <= RAW_DAYS).alias("kept_in_raw"),
    )
