"""Column lists that the registered queries and their SQL share."""

from __future__ import annotations

from subtide.schemas import HISTORY_COLUMNS, SUBSCRIPTION_CUMULATED

STATE_SCALARS = [c for c in SUBSCRIPTION_CUMULATED.names if c not in HISTORY_COLUMNS]

# Every non-key state column as something that can be summed per opco and day.
STATE_TOTALS = [
    c for c in STATE_SCALARS
    if c not in ("opco_code", "subscription_key", "subscriber_id", "subscription_name", "snapshot_date")
]


def state_total(column: str) -> str:
    """SQL of a summable stand-in, the same in both engines."""
    if column == "subscription_id":
        return "CAST(subscription_id AS BIGINT)"
    if column.endswith("_date"):
        return f"datediff('day', DATE '1990-01-01', {column})"
    return column


# KPI column -> state flag it sums.
KPI_SUMS = {
    "additions": "is_addition",
    "new_subscriptions": "is_new_subscription",
    "winback_subscriptions": "is_winback_event",
    "reacquisition_subscriptions": "is_reacquisition_event",
    "renewal_subscriptions": "is_renewal_event",
    "subscription_churn": "is_churn_event",
    "paying_subscriptions": "is_paying",
    "grace_subscriptions": "is_in_grace",
    "active_subscriptions": "is_active_subscription",
}
KPI_MINUTES = {f"minutes_of_usage_{w}": f"mou_{w}" for w in ("1d", "7d", "30d")}
KPI_UNIQUES = {
    "unique_additions": "any_added = 1",
    "subscriber_churn": "any_churned = 1 AND any_active = 0",
    "active_subscribers": "any_active = 1",
    "unique_viewers_1d": "any_1d = 1",
    "unique_viewers_7d": "any_7d = 1",
    "unique_viewers_30d": "any_30d = 1",
}
