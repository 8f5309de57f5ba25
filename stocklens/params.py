"""Run parameters.

The reference derives "today" from the wall clock in its notebooks; here the
as-of date is always an explicit parameter so every run is repeatable.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

MONTH_MODES = ("first_day", "full_month")


@dataclass(frozen=True)
class RunParams:
    """Parameters shared by every pipeline.

    as_of          processing date ("today" of the reference)
    lookback_days  history window; the window is [as_of - lookback_days, as_of], both ends inclusive
    mode           "RUN" (whole data, 90 days) or "TEST" (1 day, deterministic hash sample)
    env            table-name environment ("DEV" / "PROD")
    month_mode     "first_day": M1..M3 hold only the first day of each previous month (as the
                   reference computes them); "full_month": the whole calendar month
    sample_buckets TEST mode keeps keys whose hash falls in bucket 0 of this many buckets
    table_format   writer format for sinks ("parquet" here; "delta" where the jar exists)
    """

    as_of: dt.date = dt.date(2001, 6, 30)
    lookback_days: int = 90
    mode: str = "RUN"
    env: str = "DEV"
    month_mode: str = "first_day"
    sample_buckets: int = 10
    table_format: str = "parquet"
    source_prefix: str = field(default="supply")

    def __post_init__(self) -> None:
        if self.month_mode not in MONTH_MODES:
            raise ValueError(f"month_mode must be one of {MONTH_MODES}, got {self.month_mode!r}")
        if self.mode not in ("RUN", "TEST"):
            raise ValueError(f"mode must be RUN or TEST, got {self.mode!r}")
        if self.lookback_days < 0:
            raise ValueError("lookback_days must be >= 0")

    @classmethod
    def for_mode(cls, mode: str, as_of: dt.date | None = None, **kw) -> "RunParams":
        """V4: TEST = sampled input and a 1-day window; RUN = everything and 90 days."""
        days = 1 if mode == "TEST" else 90
        base = cls(mode=mode, lookback_days=days, **kw)
        return replace(base, as_of=as_of) if as_of is not None else base

    @property
    def start(self) -> dt.date:
        return self.as_of - dt.timedelta(days=self.lookback_days)

    @property
    def sampled(self) -> bool:
        return self.mode == "TEST"

    def table(self, stem: str) -> str:
        """Output table name by environment, e.g. supply_dev_vendas_90d_on_off."""
        return f"{self.source_prefix}_{self.env.lower()}_{stem}"

    def with_(self, **kw) -> "RunParams":
        return replace(self, **kw)
