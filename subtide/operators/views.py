"""Reporting view over the KPI table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def kpi_daily_view(kpi: DataFrame) -> DataFrame:
    """KPIs with calendar buckets, opening balances and the roll-forward variance.

    "Opening" is the closing of the previous row of the opco, not of the previous
    calendar day. The window holds one row per day of an opco. A filter on
    opco_code passes through it, a filter on snapshot_date does not.
    """
    by_opco = Window.partitionBy("opco_code").orderBy("snapshot_date")
    c = F.col
    opened = kpi.where(c("snapshot_date").isNotNull()).withColumns(
        {
            "opening_subscriptions": F.lag("closing_subscriptions").over(by_opco),
            "unique_opening_subscribers": F.lag("unique_closing_subscribers").over(by_opco),
        }
    )
    return opened.select(
        "snapshot_date",
        F.trunc("snapshot_date", "WEEK").alias("week_start"),
        F.trunc("snapshot_date", "MONTH").alias("month_start"),
        F.trunc("snapshot_date", "QUARTER").alias("quarter_start"),
        "opco_code",
        "additions",
        "unique_additions",
        "closing_subscriptions",
        "unique_closing_subscribers",
        "opening_subscriptions",
        "unique_opening_subscribers",
        "subscription_churn",
        "subscriber_churn",
        c("winback_subscriptions").alias("winback_subscription"),
        "active_subscribers",
        "active_subscriptions",
        c("unique_viewers_1d").alias("unique_viewers"),
        c("minutes_of_usage_1d").alias("minutes_of_usage"),
        c("avg_viewing_time_1d").alias("average_viewing_time"),
        "new_subscriptions",
        "reacquisition_subscriptions",
        "renewal_subscriptions",
        "paying_subscriptions",
        "grace_subscriptions",
        "unique_viewers_7d",
        "unique_viewers_30d",
        "minutes_of_usage_7d",
        "minutes_of_usage_30d",
        "avg_viewing_time_7d",
        "avg_viewing_time_30d",
        (
            c("closing_subscriptions")
            - (c("opening_subscriptions") + c("additions") - c("subscription_churn"))
        ).alias("roll_forward_variance"),
    )
