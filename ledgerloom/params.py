"""Business thresholds shared by the jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal
from fractions import Fraction


@dataclass(frozen=True)
class Params:
    lookback_days: int = 3
    gross_margin: Decimal = Decimal("0.35")
    clv_horizon_months: int = 24
    active_days: int = 90
    lapsing_days: int = 180
    retention_days: int = 90
    # None: the calendar covers the whole years in which orders exist. The end is exclusive.
    calendar_start: date | None = None
    calendar_end: date | None = None

    @property
    def clv_multiplier(self) -> Fraction:
        """Margin times horizon as an exact fraction, e.g. 0.35 x 24 = 84/10."""
        return Fraction(self.gross_margin) * self.clv_horizon_months
