"""One day of the lifecycle state machine: yesterday's state + today's rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.config import LifecycleConfig
from subtide.functions.columns import flag
from subtide.functions.history import push_front, trailing_windows
from subtide.functions.sizes import broadcast_if_small
from subtide.schemas import SUBSCRIPTION_CUMULATED


def step_cumulated(
    yesterday: DataFrame,
    today: DataFrame,
    ds: date,
    has_snapshot: bool | DataFrame,
    cfg: LifecycleConfig = LifecycleConfig(),
) -> DataFrame:
    """State of `ds` from the state of the day before and the daily rows of `ds`.

    `has_snapshot` says whether a feed arrived; where each opco has a feed of its own, it is a frame with the
    opco_code of those whose feed arrived.

    Both sides hold one row per subscription_key, so the full outer join cannot
    skew, and between tables bucketed on the key it needs no shuffle. On a day
    without any feed (`has_snapshot` false) payers are carried as paying, while
    everybody else keeps ageing and may churn.
    """
    previous = yesterday.alias("y")
    current = today.alias("t")
    paired = previous.join(
        current, F.col("y.subscription_key") == F.col("t.subscription_key"), "full_outer"
    )
    if isinstance(has_snapshot, DataFrame):
        paired, has_snapshot = _with_own_feed(paired, has_snapshot)
    else:
        has_snapshot = F.lit(has_snapshot)
    return _advance(paired, F.lit(ds), has_snapshot, cfg)


def _with_own_feed(paired: DataFrame, feed: DataFrame) -> tuple[DataFrame, Column]:
    """`paired` and whether the row's opco is in `feed`, one row per opco."""
    opcos = broadcast_if_small(feed.select(F.col("opco_code").alias("feed_opco")).distinct())
    paired = paired.join(opcos, F.coalesce("t.opco_code", "y.opco_code") == F.col("feed_opco"), "left")
    return paired, F.col("feed_opco").isNotNull()


def step_all_days(
    states: DataFrame,
    daily: DataFrame,
    feed_dates: DataFrame,
    end: date,
    cfg: LifecycleConfig = LifecycleConfig(),
) -> DataFrame:
    """Apply the one-day step to every day of a state table at once.

    Each state row is taken as "yesterday" of the following day, up to `end`. A
    state table that equals this result obeys the recurrence on every day, which
    is how a bulk build is audited without replaying it.
    """
    previous = states.withColumn("for_date", F.date_add("snapshot_date", 1)).where(
        F.col("for_date") <= F.lit(end)
    )
    paired = previous.alias("y").join(
        daily.alias("t"),
        (F.col("y.subscription_key") == F.col("t.subscription_key"))
        & (F.col("y.for_date") == F.col("t.snapshot_date")),
        "full_outer",
    )
    ds = F.coalesce("y.for_date", "t.snapshot_date")
    feed = feed_dates.select(F.col("snapshot_date").alias("feed_date"), *[F.col(c).alias("feed_opco") for c in cfg.feed_key])
    on = F.col("ds") == F.col("feed_date")
    if cfg.feed_key:
        on = on & (F.coalesce("t.opco_code", "y.opco_code") == F.col("feed_opco"))
    # One row per calendar day at most, so the broadcast is bounded by the range; with a calendar per opco they are counted.
    feed = broadcast_if_small(feed) if cfg.feed_key else F.broadcast(feed)
    paired = paired.withColumn("ds", ds).join(feed, on, "left")
    return _advance(paired, F.col("ds"), F.col("feed_date").isNotNull(), cfg)


def _advance(paired: DataFrame, ds: Column, has_snapshot: Column, cfg: LifecycleConfig) -> DataFrame:
    y, t = (lambda c: F.col(f"y.{c}")), (lambda c: F.col(f"t.{c}"))

    def from_feed(value: Column, without_feed: Column) -> Column:
        return F.when(has_snapshot, value).otherwise(without_feed)

    ids = ["opco_code", "subscription_key", "subscriber_id", "subscription_name", "subscription_id"]
    carried = F.coalesce(F.get(y("activity_array"), F.lit(0)), F.lit(0))
    today = paired.select(
        *[F.coalesce(t(c), y(c)).alias(c) for c in ids],
        from_feed(F.coalesce(t("is_paying_today"), F.lit(0)), carried).cast("long").alias("is_paying"),
        from_feed(F.coalesce(t("is_viewer_today"), F.lit(0)), F.lit(0)).cast("long").alias("viewer"),
        from_feed(F.coalesce(t("minutes_of_usage"), F.lit(0.0)), F.lit(0.0)).alias("minutes"),
        F.coalesce(t("paid_through_date"), y("paid_through_date")).alias("paid_through_date"),
        *[
            y(c).alias(f"prev_{c}")
            for c in [
                "activity_array", "viewer_array", "mou_array", "first_active_date",
                "last_active_date", "churn_date", "last_churn_date", "last_winback_date",
                "subscription_id",
            ]
        ],
        F.coalesce(y("is_churned"), F.lit(0)).alias("was_churned"),
        F.coalesce(y("is_active_subscription"), F.lit(0)).alias("was_active"),
        ds.alias("snapshot_date"),
    )

    col = F.col
    paying, not_paying = col("is_paying") == 1, col("is_paying") == 0
    cap = cfg.array_size
    aged = today.withColumns(
        {
            "activity_array": push_front(col("is_paying"), col("prev_activity_array"), cap),
            "viewer_array": push_front(col("viewer"), col("prev_viewer_array"), cap),
            "mou_array": push_front(col("minutes"), col("prev_mou_array"), cap),
            "last_active_date": F.when(paying, col("snapshot_date")).otherwise(col("prev_last_active_date")),
            "first_active_date": F.coalesce("prev_first_active_date", F.when(paying, col("snapshot_date"))),
            "open_churn_days": F.date_diff("snapshot_date", "prev_churn_date"),
        }
    ).withColumn("idle", F.date_diff("snapshot_date", "last_active_date"))

    returned = paying & (col("was_churned") == 1)
    flagged = aged.withColumns(
        {
            "is_in_grace": flag(not_paying & col("idle").between(1, cfg.grace_days)),
            "is_churned": flag(not_paying & (col("idle") > cfg.grace_days)),
            "is_churn_event": flag(
                not_paying & (col("idle") > cfg.grace_days) & (col("was_churned") == 0)
            ),
            "is_winback_event": flag(returned & (col("open_churn_days") <= cfg.winback_days)),
            "is_reacquisition_event": flag(returned & (col("open_churn_days") > cfg.winback_days)),
            "is_new_subscription": flag(paying & col("prev_first_active_date").isNull()),
            "is_addition": flag(paying & (col("was_active") == 0)),
            "is_renewal_event": flag(
                paying & (col("was_active") == 1) & (col("subscription_id") != col("prev_subscription_id"))
            ),
        }
    ).where((col("is_paying") == 1) | (col("is_in_grace") == 1) | (col("idle") <= cfg.retention_days))

    churned_today = col("is_churn_event") == 1
    churn_reference = F.when(churned_today, col("snapshot_date")).otherwise(col("prev_churn_date"))
    since_churn = F.date_diff("snapshot_date", churn_reference)
    states = flagged.withColumns(
        {
            "churn_date": F.when(churned_today, col("snapshot_date")).when(not_paying, col("prev_churn_date")),
            "last_churn_date": F.when(churned_today, col("snapshot_date")).otherwise(
                col("prev_last_churn_date")
            ),
            "last_winback_date": F.when(col("is_winback_event") == 1, col("snapshot_date")).otherwise(
                col("prev_last_winback_date")
            ),
            "is_active_subscription": F.greatest("is_paying", "is_in_grace"),
            "is_in_winback_window": flag((col("is_churned") == 1) & (since_churn <= cfg.winback_days)),
            "days_since_last_active": col("idle").cast("long"),
            "days_since_churn": since_churn.cast("long"),
            "tenure_days": F.date_diff("snapshot_date", "first_active_date").cast("long"),
            "is_viewer_1d": col("viewer"),
            "mou_1d": col("minutes"),
        }
    )
    return trailing_windows(states, cfg).select(*SUBSCRIPTION_CUMULATED.names)
