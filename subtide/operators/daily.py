"""Snapshot rows -> one row per subscription and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.config import LifecycleConfig
from subtide.functions.columns import flag
from subtide.schemas import SUBSCRIPTION_DAILY


def in_range(df: DataFrame, start: date, end: date, column: str = "snapshot_date") -> DataFrame:
    """Rows of an inclusive date range; reaches the scan as a partition filter."""
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))


def build_subscription_daily(
    bronze: DataFrame,
    start: date,
    end: date | None = None,
    cfg: LifecycleConfig = LifecycleConfig(),
) -> DataFrame:
    """Collapse the snapshot to (snapshot_date, subscription_key).

    One grouped aggregate with map-side partials, so a hot subscription is
    reduced to one row per day before anything is shuffled. Being present in the
    snapshot is what makes a subscription paying that day.
    """
    texts = ["opco_code", "subscriber_id", "subscription_name", "subscription_id"]
    src = (
        in_range(bronze, start, end or start)
        .where(F.col("subscriber_id").isNotNull() & F.col("subscription_name").isNotNull())
        .withColumns({c: F.col(c).cast("string") for c in texts})
    )
    latest_instance = F.struct("subscription_start_date", "subscription_id")
    grouped = src.groupBy("opco_code", "subscriber_id", "subscription_name", "snapshot_date").agg(
        # NULL start dates and ids sort lowest, so any known instance wins.
        F.max(latest_instance)["subscription_id"].alias("subscription_id"),
        F.sum(F.coalesce("minutes_of_usage", F.lit(0.0))).alias("minutes_of_usage"),
        F.min("subscription_start_date").alias("subscription_start_date"),
        F.max("subscription_end_date").alias("paid_through_date"),
    )
    return grouped.select(
        "opco_code",
        # concat, not concat_ws: a missing opco must give a NULL key, which the
        # writer rejects, rather than a key without its first part.
        F.concat("opco_code", F.lit("|"), "subscriber_id", F.lit("|"), "subscription_name").alias(
            "subscription_key"
        ),
        "subscriber_id",
        "subscription_name",
        "subscription_id",
        F.lit(1).cast("long").alias("is_paying_today"),
        flag(F.col("minutes_of_usage") >= cfg.viewer_minutes).alias("is_viewer_today"),
        "minutes_of_usage",
        "subscription_start_date",
        "paid_through_date",
        "snapshot_date",
    ).select(*SUBSCRIPTION_DAILY.names)
