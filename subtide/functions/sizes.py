"""Broadcasts of checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000  # of two or three short columns


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it has up to `most` rows; beyond that the planner decides."""
    return F.broadcast(df) if df.count() <= most else df
