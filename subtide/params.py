"""Explicit report parameters: nothing in the models reads the clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class ReportParams:
    """``as_of`` stands in for "today", so every result is reproducible.

    ``product_prefix`` is what precedes the product name in ``addon_key``.
    ``literal`` keeps the documented-versus-coded conflict of the trial mart
    in its coded form (see README, "Known deviations").
    """

    as_of: date
    product_prefix: str = ""
    cohort_start: date = date(2024, 7, 1)
    cohort_periods: int = 24
    engagement_days: int = 90
    literal: bool = False

    def cohort_months(self) -> list[date]:
        first = self.cohort_start.year * 12 + self.cohort_start.month - 1
        return [
            date(index // 12, index % 12 + 1, 1)
            for index in range(first, first + self.cohort_periods)
        ]
