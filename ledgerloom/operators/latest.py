"""One row per key: the newest version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key in the given order.

    Comparing the row number with 1 lets Spark drop all but one row per key on the map side (window
    group limit), so a key that holds a third of the table sends one row per input partition.
    """
    newest = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def delivery_order(df: DataFrame, keys: Sequence[str], *leading: Column) -> list[Column]:
    """``leading``, then the position in the file if known, then every other column: a total order."""
    if "_src_pos" in df.columns:
        return [*leading, F.col("_src_pos").desc()]
    return [*leading, *[F.col(c).desc_nulls_last() for c in df.columns if c not in keys]]
