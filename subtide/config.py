"""Lifecycle thresholds."""

from __future__ import annotations

from dataclasses import dataclass

# The trailing windows, in days, that state rows and KPIs carry.
# The third window is the whole history array.
SHORT_WINDOW_DAYS = 7
MONTH_WINDOW_DAYS = 30


@dataclass(frozen=True)
class LifecycleConfig:
    """Thresholds of the subscription state machine, in days unless noted."""

    array_size: int = 90
    grace_days: int = 30
    winback_days: int = 90
    retention_days: int = 180
    viewer_minutes: float = 1.0
    # Whose rows make a date a feed date: any company's ("all"), or each company its own ("opco").
    feed_scope: str = "all"

    def __post_init__(self) -> None:
        if self.feed_scope not in ("all", "opco"):
            raise ValueError("feed_scope must be 'all' or 'opco'")
        if self.array_size < 1:
            raise ValueError("array_size must be at least 1")
        if self.grace_days < 0 or self.winback_days < 0:
            raise ValueError("grace_days and winback_days must not be negative")
        # A key has to outlive its grace period, or it could never be seen to churn.
        if self.retention_days <= self.grace_days:
            raise ValueError("retention_days must be greater than grace_days")

    @property
    def feed_key(self) -> list[str]:
        """The columns that a feed calendar has besides the date."""
        return ["opco_code"] if self.feed_scope == "opco" else []

    def window(self, days: int) -> int:
        """Days a trailing window really covers: history is capped at array_size."""
        return min(days, self.array_size)
