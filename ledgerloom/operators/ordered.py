"""Global order without a single-task window.

Ranks, quantile buckets, running shares, "next version" and "last version known at a time" all need
rows in one order over the whole table. A window without partition keys moves the table to one task,
and one keyed by customer moves a hot customer to one task. Here the table is range-partitioned on a
total order, written once with each row's slice and position in it, and the windows run per slice.
What one slice must know of the others (row counts, sums, the value at its edge) is one row per
slice and is broadcast. A hot value simply spans several slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.store import Store

SLICE, POS = "_slice", "_pos"
_SLICE_BITS = 33  # monotonically_increasing_id keeps the partition above its lower 33 bits

def _before():
    """The slices before this one. Only ever used over frames of one row per slice."""
    return Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def _all():
    return Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def lay_out(df: DataFrame, order: Sequence[Column], store: Store, name: str) -> DataFrame:
    """Sort globally by ``order``, which must tell all rows apart, and write the result once."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    written = store.scratch(ranged.withColumn("_id", F.monotonically_increasing_id()), name)
    return written.withColumns(
        {
            SLICE: F.shiftright("_id", _SLICE_BITS).cast("int"),
            POS: F.col("_id").bitwiseAND(F.lit((1 << _SLICE_BITS) - 1)) + 1,
        }
    ).drop("_id")


def place(laid: DataFrame, number: str, total: str) -> DataFrame:
    """Global row number, and the row count of the table."""
    edges = laid.groupBy(SLICE).agg(F.count("*").alias("_n"))
    edges = edges.select(
        SLICE,
        F.coalesce(F.sum("_n").over(_before()), F.lit(0)).alias("_n_before"),
        F.sum("_n").over(_all()).alias(total),
    )
    return laid.join(F.broadcast(edges), SLICE).withColumn(number, F.col("_n_before") + F.col(POS)).drop("_n_before")


def ntile(number: Column, total: Column, buckets: int) -> Column:
    """Bucket of a row number: the first ``total % buckets`` buckets hold one row more."""
    size = F.floor(total / buckets)
    larger = total % buckets
    cut = larger * (size + 1)
    in_larger = F.floor((number - 1) / (size + 1)) + 1
    in_rest = larger + F.floor((number - 1 - cut) / F.greatest(size, F.lit(1))) + 1
    return F.when(number <= cut, in_larger).otherwise(in_rest).cast("int")


@dataclass(frozen=True)
class Positions:
    """Names of the columns ``positions`` adds."""

    number: str = "_n"  # row number
    total: str = "_total"  # rows
    first: str = "_first"  # row numbers of the first and the last row of equal value
    last: str = "_last"
    running: str = "_running"  # running sum of the value
    whole: str = "_whole"  # sum of the value
    rank: str = "_rank"  # rank of the value within the group


def positions(laid: DataFrame, value: str, group: str, names: Positions = Positions()) -> DataFrame:
    """Every position of a row in a layout that descends by the non-null ``value``.

    ``group`` has few distinct values. All the frames that are broadcast hold at most one row per
    slice and group: counts and sums of the slices, and the values that reach over an edge, of which
    a slice has at most two. They are all taken from the layout itself.
    """
    edges = laid.groupBy(SLICE).agg(
        F.count("*").alias("_rows"),
        F.sum(value).alias("_sum"),
        F.min_by(value, POS).alias("_lo"),
        F.max_by(value, POS).alias("_hi"),
    )
    before = edges.select(
        SLICE,
        "_rows",
        F.coalesce(F.sum("_rows").over(_before()), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_sum").over(_before()), F.lit(0)).alias("_sum_before"),
        F.sum("_rows").over(_all()).alias(names.total),
        F.sum("_sum").over(_all()).alias(names.whole),
    )
    earlier = Window.partitionBy(group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        laid.groupBy(SLICE, group)
        .agg(F.count("*").alias("_rows"))
        .select(SLICE, group, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_ahead"))
    )

    # values that reach over an edge, counted per slice and group
    spanning = (
        edges.select(F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias(value))
        .groupBy(value)
        .count()
        .filter("count > 1")
        .select(value)
    )
    spread = (
        laid.join(F.broadcast(spanning), value, "left_semi").groupBy(value, SLICE, group).agg(F.count("*").alias("_k"))
    )
    # such a value ends its first slice, so its first row follows all others there
    span = (
        spread.groupBy(value, SLICE)
        .agg(F.sum("_k").alias("_k"))
        .groupBy(value)
        .agg(F.min(SLICE).alias(SLICE), F.min_by("_k", SLICE).alias("_k"), F.sum("_k").alias("_all"))
        .join(F.broadcast(before), SLICE)
        .select(
            value,
            (F.col("_rows_before") + F.col("_rows") - F.col("_k") + 1).alias("_span_first"),
            F.col("_all").alias("_span_rows"),
        )
    )
    # rows of earlier slices with the same value are equals, not ahead
    earlier_equal = Window.partitionBy(group, value).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    tied = spread.select(SLICE, group, value, F.sum("_k").over(earlier_equal).alias("_tied"))

    in_slice = Window.partitionBy(SLICE)
    running = F.sum(value).over(in_slice.orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    by_value = in_slice.orderBy(F.col(value).desc())
    equal_or_ahead = by_value.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    in_group = Window.partitionBy(SLICE, group).orderBy(F.col(value).desc())
    return (
        laid.join(F.broadcast(before.drop("_rows")), SLICE)
        .join(F.broadcast(ahead), [SLICE, group])
        .join(F.broadcast(tied), [SLICE, group, value], "left")
        .join(F.broadcast(span), value, "left")
        .withColumn(names.number, F.col("_rows_before") + F.col(POS))
        # the first window fixes the partitioning by slice that the others share
        .withColumn(names.running, F.col("_sum_before") + running)
        .withColumn(names.first, F.coalesce("_span_first", F.col("_rows_before") + F.rank().over(by_value)))
        .withColumn(
            names.last,
            F.coalesce(
                F.col("_span_first") + F.col("_span_rows") - 1,
                F.col("_rows_before") + F.count("*").over(equal_or_ahead),
            ),
        )
        .withColumn(names.rank, F.col("_ahead") + F.rank().over(in_group) - F.coalesce("_tied", F.lit(0)))
        .drop("_rows_before", "_sum_before", "_ahead", "_tied", "_span_first", "_span_rows")
    )


def next_in_group(laid: DataFrame, group: str, value: str, following: str) -> DataFrame:
    """``value`` of the next row of the same ``group``; the order starts with ``group``."""
    row = F.struct(F.col(group).alias("g"), F.col(value).alias("v"))
    edges = laid.groupBy(SLICE).agg(F.min_by(row, POS).alias("_first"))
    edges = edges.select(SLICE, F.lead("_first").over(Window.orderBy(SLICE)).alias("_edge"))
    within = Window.partitionBy(SLICE).orderBy(POS)
    nxt = F.coalesce(F.lead(row).over(within), F.col("_edge"))
    return (
        laid.join(F.broadcast(edges), SLICE)
        .withColumn("_next", nxt)
        .withColumn(following, F.when(F.col("_next.g") == F.col(group), F.col("_next.v")))
        .drop("_edge", "_next")
    )


def last_known(laid: DataFrame, group: str, value: str, known: str) -> DataFrame:
    """The latest non-null ``value`` of the same ``group`` up to each row; the order starts with ``group``."""
    row = F.struct(F.col(group).alias("g"), F.col(value).alias("v"))
    newest = F.max_by(row, F.when(F.col(value).isNotNull(), F.col(POS)))
    edges = laid.groupBy(SLICE).agg(newest.alias("_newest"))
    edges = edges.select(SLICE, F.last("_newest", ignorenulls=True).over(_before()).alias("_edge"))
    within = Window.partitionBy(SLICE, group).orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.when(F.col("_edge.g") == F.col(group), F.col("_edge.v"))
    return (
        laid.join(F.broadcast(edges), SLICE)
        .withColumn(known, F.coalesce(F.last(value, ignorenulls=True).over(within), carried))
        .drop("_edge")
    )
