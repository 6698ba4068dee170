"""Exact money and ratio arithmetic.

Money stays in decimals. Ratios are rounded half-up from integers, so a result never depends on
how a double happens to be represented or on the order in which rows were added.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(24,2)"
WIDE = "decimal(28,0)"


def money(amount: Column) -> Column:
    """Round half-up to cents."""
    return F.round(amount, 2).cast(MONEY)


def cents(amount: Column) -> Column:
    """A two-decimal amount as a whole number of cents."""
    return (amount.cast("decimal(26,2)") * F.lit(Decimal(100))).cast(WIDE)


def ratio(num: Column, den: Column, places: int) -> Column:
    """``num / den`` rounded half-up (away from zero) to ``places``; NULL when ``den`` is 0 or NULL.

    Both operands are whole numbers and ``den`` is not negative.
    """
    whole = num.cast(WIDE)
    below = F.nullif(den.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    doubled = F.abs(whole) * F.lit(Decimal(2 * 10**places)) + below
    steps = F.call_function("div", doubled, below * F.lit(Decimal(2)))
    signed = F.when(whole < 0, -steps).otherwise(steps)
    return (signed.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(22,{places})")


def signed_ratio(num: Column, den: Column, places: int) -> Column:
    """``ratio`` for a denominator that may be negative."""
    flip = F.when(den < 0, F.lit(-1)).otherwise(F.lit(1)).cast("decimal(1,0)")
    return ratio((num.cast("decimal(26,0)") * flip).cast(WIDE), F.abs(den), places)
