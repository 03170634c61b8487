"""Analysis period and other fixed parameters.

The calendar range and the refresh windows are parameters of the spine
build.  ``DEFAULT_PERIOD`` is the one used with the provided test tables
(see ``retentia.sources.adapter``): calendar year 2000, refreshed in four
quarterly windows.  ``REFERENCE_PERIOD`` reproduces the original business
set-up (Jan 2, 2023 .. Nov 30, 2024, six quarters plus one five-month window).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


def _d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


@dataclass(frozen=True)
class AnalysisPeriod:
    """Calendar range plus the ordered, disjoint refresh windows inside it."""

    cal_start: dt.date
    cal_end: dt.date
    windows: tuple[tuple[dt.date, dt.date], ...] = field(default_factory=tuple)

    def __post_init__(self):
        if self.cal_start > self.cal_end:
            raise ValueError("calendar start after calendar end")
        prev_to = None
        for lo, hi in self.windows:
            if lo > hi:
                raise ValueError(f"window {lo}..{hi} is empty")
            if prev_to is not None and lo <= prev_to:
                raise ValueError("refresh windows must be ordered and disjoint")
            prev_to = hi

    @property
    def first_from(self) -> dt.date:
        return self.windows[0][0]

    @property
    def last_to(self) -> dt.date:
        return self.windows[-1][1]

    def as_of_run(self) -> "AnalysisPeriod":
        """One single window spanning all refresh windows (hazard H-1 mode)."""
        return AnalysisPeriod(self.cal_start, self.cal_end, ((self.first_from, self.last_to),))

    @staticmethod
    def quarters(cal_start: str, cal_end: str, bounds: list[tuple[str, str]]) -> "AnalysisPeriod":
        return AnalysisPeriod(_d(cal_start), _d(cal_end), tuple((_d(a), _d(b)) for a, b in bounds))


# The analysis period used with the provided test tables.
DEFAULT_PERIOD = AnalysisPeriod.quarters(
    "2000-01-01",
    "2000-12-31",
    [
        ("2000-01-01", "2000-03-31"),
        ("2000-04-01", "2000-06-30"),
        ("2000-07-01", "2000-09-30"),
        ("2000-10-01", "2000-12-31"),
    ],
)

# The original business period and its seven refresh windows.
REFERENCE_PERIOD = AnalysisPeriod.quarters(
    "2023-01-02",
    "2024-11-30",
    [
        ("2023-01-02", "2023-03-31"),
        ("2023-04-01", "2023-06-30"),
        ("2023-07-01", "2023-09-30"),
        ("2023-10-01", "2023-12-31"),
        ("2024-01-01", "2024-03-31"),
        ("2024-04-01", "2024-06-30"),
        ("2024-07-01", "2024-11-30"),
    ],
)

# Dashboard constants.
TRAILING_SHORT_DAYS = 30          # "Is Trailing 30 Days": >= max - 30 (31 dates)
TRAILING_LONG_DAYS = 90           # "Is Trailing 90 Days": >= max - 90 (91 dates)
COHORT_MAX_MONTHS = 12            # cohort grid columns 0..12
AT_RISK_FRICTION = 5              # friction events > 5
AT_RISK_CSAT = 3                  # csat < 3
PRIORITY_ORDER = ("urgent", "high", "medium", "low")

# Feature window and split.
FEATURE_WINDOW_DAYS = 30
FEATURE_RECENT_DAYS = 7
SPLIT_TRAIN = 0.6
SPLIT_VALID_END = 0.8
RISK_THRESHOLD = 0.60

# The score-file contract.
SCORE_COLUMNS = (
    "account_id",
    "industry",
    "active_mrr_run_rate",
    "flight_risk_score",
    "primary_risk_drivers",
    "tenure_days",
)
