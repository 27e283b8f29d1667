"""The numbers an operator may be tuned with, in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Fixed values.
SECONDS_PER_DAY = 86_400
SECONDS_PER_HOUR = 3_600
SECONDS_PER_MINUTE = 60


@dataclass(frozen=True)
class Params:
    """Defaults are the published ones; tests and stand-in data override the dates and amounts."""

    origin: date = date(2017, 12, 1)  # day 0 of the seconds offset; only order matters
    valid_start: date = date(2018, 5, 4)  # first day of the validation split
    block_threshold: float = 0.43  # fixed reference threshold for day-to-day comparison
    high_amount: float = 250.0  # lower edge of the high-amount band
    min_bucket_rows: int = 1000  # groups below this size are not reported
    top_values: int = 5  # most frequent values kept per feature
    domain_min_count: int = 1000  # rarer mail domains become "other"
    tiles: int = 5  # quantile buckets per feature
    trailing_rows: int = 7  # rows in the trailing baseline, current row excluded
