"""Declared schemas of every table. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, DOUBLE, DATE = T.StringType(), T.LongType(), T.DoubleType(), T.DateType()


def _schema(*groups: tuple[T.DataType, str], required: str = "") -> T.StructType:
    """One StructType from (type, "col col ...") groups, in order."""
    not_null = set(required.split())
    return T.StructType(
        [
            T.StructField(name, dtype, nullable=name not in not_null)
            for dtype, names in groups
            for name in names.split()
        ]
    )


RAW_SNAPSHOT = _schema(
    (
        STRING,
        "snapshot_date subscription_id subscription_name subscriber_id "
        "subscription_start_date subscription_end_date minutes_of_usage",
    )
)

SUBSCRIPTION_SNAPSHOT = _schema(
    (STRING, "opco_code subscriber_id subscription_name subscription_id"),
    (DATE, "subscription_start_date subscription_end_date"),
    (DOUBLE, "minutes_of_usage"),
    (DATE, "snapshot_date"),
    required="snapshot_date",
)

SUBSCRIPTION_DAILY = _schema(
    (STRING, "opco_code subscription_key subscriber_id subscription_name subscription_id"),
    (LONG, "is_paying_today is_viewer_today"),
    (DOUBLE, "minutes_of_usage"),
    (DATE, "subscription_start_date paid_through_date snapshot_date"),
    required="opco_code subscription_key subscriber_id snapshot_date",
)

SUBSCRIPTION_CUMULATED = _schema(
    (STRING, "opco_code subscription_key subscriber_id subscription_name subscription_id"),
    (T.ArrayType(LONG), "activity_array viewer_array"),
    (T.ArrayType(DOUBLE), "mou_array"),
    (DATE, "first_active_date last_active_date paid_through_date"),
    (DATE, "churn_date last_churn_date last_winback_date"),
    (LONG, "is_paying is_in_grace is_active_subscription is_churned is_in_winback_window"),
    (LONG, "is_addition is_new_subscription is_winback_event is_reacquisition_event"),
    (LONG, "is_churn_event is_renewal_event"),
    (LONG, "days_since_last_active days_since_churn tenure_days"),
    (LONG, "is_viewer_1d is_viewer_7d is_viewer_30d is_viewer_90d"),
    (LONG, "active_days_7d active_days_30d active_days_90d"),
    (DOUBLE, "mou_1d mou_7d mou_30d mou_90d"),
    (DATE, "snapshot_date"),
    required="opco_code subscription_key subscriber_id snapshot_date",
)

HISTORY_COLUMNS = ["activity_array", "viewer_array", "mou_array"]

OTT_KPI_DAILY = _schema(
    (STRING, "opco_code"),
    (LONG, "additions unique_additions new_subscriptions winback_subscriptions"),
    (LONG, "reacquisition_subscriptions renewal_subscriptions"),
    (LONG, "subscription_churn subscriber_churn"),
    (LONG, "closing_subscriptions unique_closing_subscribers"),
    (LONG, "paying_subscriptions grace_subscriptions active_subscriptions active_subscribers"),
    (LONG, "unique_viewers_1d unique_viewers_7d unique_viewers_30d"),
    (DOUBLE, "minutes_of_usage_1d minutes_of_usage_7d minutes_of_usage_30d"),
    (DOUBLE, "avg_viewing_time_1d avg_viewing_time_7d avg_viewing_time_30d"),
    (DATE, "snapshot_date"),
    required="opco_code snapshot_date",
)

ETL_RUN_LOG = _schema(
    (T.TimestampType(), "run_ts"),
    (STRING, "proc_name"),
    (DATE, "ds"),
    (LONG, "rows_affected"),
    (STRING, "status message"),
    (DOUBLE, "duration_sec"),
)

TEST_RESULTS = _schema(
    (T.TimestampType(), "test_run_ts"),
    (STRING, "test_id test_name severity status"),
    (LONG, "failed_rows"),
    (STRING, "expected actual detail run_id"),
)

# A delivered row that is not in the snapshot table, as it was delivered.
LANDING_REJECTS = T.StructType([*RAW_SNAPSHOT.fields, *_schema((STRING, "opco_code reject_reason load_id")).fields])

TEST_EXPECTED_EVENTS = _schema(
    (STRING, "subscriber_id"),
    (DATE, "event_date"),
    (STRING, "event_type"),
)
