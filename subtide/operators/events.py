"""Lifecycle events as rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.config import LifecycleConfig
from subtide.functions.columns import epoch_day, to_day
from subtide.operators.daily import in_range
from subtide.operators.state_bulk import NEW, REACQUISITION, RENEWED, WINBACK, paying_spans

# Event names and the state flags they stand for.
EVENT_FLAGS = {
    "NEW": "is_new_subscription",
    "CHURN": "is_churn_event",
    "WINBACK": "is_winback_event",
    "REACQUISITION": "is_reacquisition_event",
    "RENEWAL": "is_renewal_event",
}

EVENT_KEYS = ["subscriber_id", "event_date", "event_type"]


def lifecycle_events(states: DataFrame, start: date, end: date) -> DataFrame:
    """One row per event flag that is set, from a single scan of the state table."""
    happened = [F.when(F.col(flag) == 1, F.lit(name)) for name, flag in EVENT_FLAGS.items()]
    any_flag = F.greatest(*EVENT_FLAGS.values()) == 1
    return (
        in_range(states, start, end)
        .where(any_flag)
        .select(
            "opco_code",
            "subscription_key",
            "subscriber_id",
            F.col("snapshot_date").alias("event_date"),
            F.explode(F.array(*happened)).alias("event_type"),
        )
        .where(F.col("event_type").isNotNull())
    )


def events_from_daily(
    daily: DataFrame,
    start: date,
    end: date,
    cfg: LifecycleConfig = LifecycleConfig(),
    feed_dates: DataFrame | None = None,
    distributed: bool = False,
) -> DataFrame:
    """The same events without building the state table: two candidates per paying day."""
    spans = paying_spans(daily, start, end, cfg, feed_dates, distributed)
    arrival = F.col("arrival")
    how = (
        F.when(arrival == NEW, "NEW")
        .when(arrival == WINBACK, "WINBACK")
        .when(arrival == REACQUISITION, "REACQUISITION")
        .when(arrival == RENEWED, "RENEWAL")
    )
    churn_day = F.col("covered_to") + cfg.grace_days + 1
    churns = (churn_day <= epoch_day(end)) & (
        F.col("next_day").isNull() | (F.col("next_day") > churn_day)
    )
    candidates = F.array(
        F.struct(F.col("day").alias("event_day"), how.alias("event_type")),
        F.struct(churn_day.alias("event_day"), F.when(churns, F.lit("CHURN")).alias("event_type")),
    )
    return (
        spans.select("opco_code", "subscription_key", "subscriber_id", F.inline(candidates))
        .where(F.col("event_type").isNotNull())
        .select(
            "opco_code",
            "subscription_key",
            "subscriber_id",
            to_day(F.col("event_day")).alias("event_date"),
            "event_type",
        )
    )
