"""Per-key history arrays: newest day first, capped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.config import MONTH_WINDOW_DAYS, SHORT_WINDOW_DAYS, LifecycleConfig
from subtide.functions.columns import flag, minute_parts, whole_minutes


def push_front(value: Column, history: Column, cap: int) -> Column:
    """Put today's value before the history and keep `cap` entries.

    A NULL history belongs to a key seen for the first time.
    """
    today = F.array(value)
    return F.when(history.isNull(), today).otherwise(F.slice(F.concat(today, history), 1, cap))


def trailing_windows(states: DataFrame, cfg: LifecycleConfig) -> DataFrame:
    """Add the 7/30/90-day columns of a state row; the longest one is the whole history.

    Flags and day counts need no look at single entries. Minutes are added up over
    the entries that are not zero, each window going on from the shorter one, so
    that no entry is added twice; sums are exact, as in the bulk build.
    """
    windows = {
        "7d": cfg.window(SHORT_WINDOW_DAYS),
        "30d": cfg.window(MONTH_WINDOW_DAYS),
        "90d": cfg.array_size,
    }
    last_viewed = F.array_position("viewer_array", F.lit(1).cast("long"))
    columns: dict[str, Column] = {}
    for name, days in windows.items():
        newest = F.slice("activity_array", 1, days)
        columns[f"is_viewer_{name}"] = flag(last_viewed.between(1, days))
        columns[f"active_days_{name}"] = F.size(F.array_remove(newest, F.lit(0).cast("long"))).cast("long")
    states = states.withColumns(columns)
    total, done = F.lit(0).cast("long"), 0
    for name, days in windows.items():
        if days > done:
            watched = F.array_remove(F.slice("mou_array", done + 1, days - done), F.lit(0.0))
            total = F.aggregate(watched, total, lambda acc, minutes: acc + minute_parts(minutes))
        states = states.withColumn(f"parts_{name}", total).withColumn(f"mou_{name}", whole_minutes(F.col(f"parts_{name}")))
        total, done = F.col(f"parts_{name}"), days
    return states.drop(*[f"parts_{name}" for name in windows])
