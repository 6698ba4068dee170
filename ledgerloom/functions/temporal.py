"""Dates and timestamps. Timestamps are zone-free UTC, so no result depends on the session zone."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"
FAR_FUTURE = "9999-12-31 00:00:00"


def moment(at: datetime | str) -> Column:
    """A zone-free literal. ``lit`` of a datetime would pass through the session zone."""
    return F.lit(str(at)).cast(NTZ)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def calendar_months(earlier: Column, later: Column) -> Column:
    """Month boundaries crossed: 31 Jan -> 1 Feb counts 1."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def parse_date(text: Column) -> Column:
    """Closed list of accepted forms: ISO, ``01 Mar 2024`` and month-first ``03/04/2024``."""
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in ("yyyy-MM-dd", "dd MMM yyyy", "MM/dd/yyyy")])


_ZONE = r"\s*([Zz]|[+-]\d{2}(?::?\d{2})?)$"
_TIMED = r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}"
# the form nearly all stamps have: whole seconds of UTC, which the first 19 characters say
_PLAIN = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\dZ?\z"


def parse_utc(text: Column) -> Column:
    """Timestamp text to zone-free UTC.

    ``Z`` or an offset (``+02``, ``+0200``, ``+02:00``, after blanks too) is applied to a time of day; none means
    UTC already. Any other zone is unknown, and so is the time.

    One anchored expression tells the usual form; only other text is searched for a zone. That search is bound by a
    lambda: it stays out of the generated code of the rows' own stage, which otherwise outgrows what the JVM compiles.
    """
    zoned = F.get(F.transform(F.array(text), _parse_zoned), F.lit(0))
    return F.when(text.rlike(_PLAIN), F.left(text, F.lit(19)).try_cast(NTZ)).otherwise(zoned)


def _parse_zoned(text: Column) -> Column:
    zone = F.when(text.rlike(_TIMED), F.nullif(F.regexp_extract(text, _ZONE, 1), F.lit("")))
    local = F.when(zone.isNotNull(), F.regexp_replace(text, _ZONE, "")).otherwise(text)
    # a cast to a zone-free time would drop a zone without notice
    plain = F.when(local.rlike(r"^[\d:.T -]+$"), local.try_cast(NTZ))
    digits = F.regexp_replace(zone, "[^0-9]", "")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    offset = F.when(F.coalesce(F.upper(zone), F.lit("Z")) == "Z", 0).when(zone.startswith("-"), -minutes).otherwise(minutes)
    return F.timestamp_add("MINUTE", -offset, plain)


_EPOCH = "1970-01-01 00:00:00"


def as_instant(utc: Column) -> Column:
    """Zone-free UTC as an instant, whatever the session zone. Streams count their event time in instants."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", moment(_EPOCH), utc))


def as_utc(instant: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), moment(_EPOCH))


def days_before(ts: Column, days: int) -> Column:
    return ts - F.make_dt_interval(days=F.lit(days))


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day for a one-row frame ``(first_day, end_day)``; the end is exclusive."""
    days = F.sequence(F.col("first_day"), F.date_sub(F.col("end_day"), 1), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("date_day"))


def month_spine(bounds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per month start from ``first_day`` to ``last_day`` for each row of ``bounds``, ends included."""
    months = F.sequence(month_start(F.col("first_day")), month_start(F.col("last_day")), F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias("order_month"), *by)
