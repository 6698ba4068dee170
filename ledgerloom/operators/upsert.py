"""Incremental upsert as a pure function over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(existing: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Delete the delta's keys from ``existing``, then add the delta; new columns are appended."""
    kept = existing.join(delta.select(key), key, "left_anti")
    return kept.unionByName(delta, allowMissingColumns=True)


def reprocess_from(existing: DataFrame, stamp: str, lookback_days: int):
    """Earliest ``stamp`` to reprocess: the newest one loaded less the lookback. One value."""
    newest = F.max(stamp)
    return existing.agg((newest - F.make_dt_interval(days=F.lit(lookback_days))).alias("since")).first()["since"]
