"""A period algebra: which periods a dated row counts for.

A measure that moves the date filter asks, for each period, for the rows of other dates. Turned round, each row names
the periods it counts for: its own, the one a month or a year later, all that follow in its year, all whose last three
months it is in. One aggregation over (measure, period) then gives all of them, at any grain, without a self join
and without a window over all periods of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = {"day": "interval 1 day", "month": "interval 1 month", "quarter": "interval 3 months", "year": "interval 12 months"}
_ROLLING_MONTHS = 3
#: Measures by the amounts they add up.
MOVED = ("now", "month_before", "year_before", "to_date", "rolling")


def start(grain: str, day: Column) -> Column:
    """First day of the period a day is in."""
    return day if grain == "day" else F.trunc(day, grain)


def end(grain: str, first: Column) -> Column:
    """Last day of the period that begins with ``first``."""
    if grain == "day":
        return first
    return F.date_sub(F.add_months(first, {"month": 1, "quarter": 3, "year": 12}[grain]), 1)


def _rolling_start(grain: str, first: Column) -> Column:
    """First day of the last months of a period: whole months, or for a day as many months back."""
    if grain == "day":
        return F.date_add(F.add_months(first, -_ROLLING_MONTHS), 1)
    return F.add_months(F.trunc(end(grain, first), "month"), 1 - _ROLLING_MONTHS)


def _moved(grain: str, day: Column, months: int) -> Column:
    """The period that sees a day as ``months`` before its own; a day has none if the later month is too short."""
    later = F.add_months(day, months)
    return F.when(F.day(later) == F.day(day), later) if grain == "day" else start(grain, later)


def _counted(grain: str, day: Column) -> Column:
    """An array of (measure, first and last period) for a day."""
    own = start(grain, day)
    year_end = F.date_sub(F.add_months(F.trunc(day, "year"), 12), 1)
    ranges = {
        "now": (own, own),
        "month_before": (_moved(grain, day, 1),) * 2,
        "year_before": (_moved(grain, day, 12),) * 2,
        "to_date": (own, start(grain, year_end)),
        "rolling": (own, start(grain, F.add_months(day, _ROLLING_MONTHS))),
    }
    return F.array(*[F.struct(F.lit(m).alias("measure"), a.alias("first"), b.alias("last")) for m, (a, b) in ranges.items()])


def moved_sums(cells: DataFrame, day: str, amount: str, grain: str, by: Sequence[str] = ()) -> DataFrame:
    """period (its first day), ``by`` and the sums of MOVED for every period between the first and the last ``day``.

    ``cells`` has one row per day and ``by``, or more; a group has all periods, null where nothing counts for one.
    """
    ends = cells.agg(start(grain, F.min(day)).alias("_first"), start(grain, F.max(day)).alias("_last"))
    bounds = {c: ends.select(c).scalar() for c in ends.columns}
    counted = cells.select(*by, F.col(day).alias("_day"), F.col(amount).alias("_amount"), F.explode(_counted(grain, F.col(day))).alias("c"))
    # a day of a month that has no such day counts for no period
    counted = counted.filter("c.first IS NOT NULL")
    last = F.least(F.col("c.last"), bounds["_last"])
    spread = counted.filter(F.col("c.first") <= last).select(
        *by, "_day", "_amount", F.col("c.measure").alias("_measure"), F.explode(F.sequence("c.first", last, F.expr(STEPS[grain]))).alias("period")
    )
    inside = (F.col("_measure") != "rolling") | (F.col("_day") >= _rolling_start(grain, F.col("period")))
    sums = spread.filter(inside).groupBy(*by, "period").agg(
        *[F.sum(F.when(F.col("_measure") == m, F.col("_amount"))).alias(m) for m in MOVED]
    )
    groups = cells.select(*by).distinct() if by else ends.select()
    every = F.sequence(bounds["_first"], bounds["_last"], F.expr(STEPS[grain]))
    periods = groups.select(*by, F.explode(every).alias("period"))
    return periods.join(sums, [*by, "period"], "left")
