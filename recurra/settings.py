"""Parameters shared by every operator."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Settings:
    """Run parameters; operators never read the wall clock.

    ``as_of`` stands for "today" in every tenure, recency and staleness rule.
    """

    as_of: dt.date = dt.date(2001, 11, 30)
    half_life_days: float = 7.0
    max_cohort_months: int = 24
    gross_margin: float = 0.80
    min_churn_rate: float = 0.01
    strict_casts: bool = True

    def but(self, **changes) -> "Settings":
        return replace(self, **changes)
