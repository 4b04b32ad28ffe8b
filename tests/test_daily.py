from datetime import date

from subtide.operators.daily import build_subscription_daily
from subtide.schemas import SUBSCRIPTION_DAILY, SUBSCRIPTION_SNAPSHOT

DAY = date(2024, 4, 1)


def build(spark, *rows):
    bronze = spark.createDataFrame(
        [("X", sub, name, sid, start, end, minutes, day) for sub, name, sid, start, end, minutes, day in rows],
        SUBSCRIPTION_SNAPSHOT,
    )
    return build_subscription_daily(bronze, DAY, DAY)


def test_instances_of_a_subscription_become_one_row(spark):
    d1, d2, d3 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 9, 1)
    daily = build(
        spark, ("s", "P", "a", d2, d2, 0.5, DAY), ("s", "P", "b", d2, d1, 0.25, DAY),
        ("s", "P", "z", d1, d3, None, DAY), ("s", "P", "zz", None, None, 0.25, DAY),
    )
    (row,) = daily.collect()
    assert daily.columns == SUBSCRIPTION_DAILY.names
    assert row["subscription_key"] == "X|s|P" and row["subscription_id"] == "b"
    assert (row["minutes_of_usage"], row["is_viewer_today"], row["is_paying_today"]) == (1.0, 1, 1)
    assert (row["subscription_start_date"], row["paid_through_date"]) == (d1, d3)


def test_viewer_threshold_and_filters(spark):
    rows = build(
        spark, ("s1", "P", None, None, None, 0.99, DAY), ("s2", "P", None, None, None, 1.0, DAY),
        (None, "P", "i", None, None, 5.0, DAY), ("s3", None, "i", None, None, 5.0, DAY),
        ("s4", "P", "i", None, None, 5.0, date(2024, 4, 2)),
    ).collect()
    assert {r["subscriber_id"]: r["is_viewer_today"] for r in rows} == {"s1": 0, "s2": 1}
    assert {r["subscription_id"] for r in rows} == {None}


def test_date_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([], SUBSCRIPTION_SNAPSHOT).write.parquet(f"{tmp_path}/s")
    daily = build_subscription_daily(spark.read.schema(SUBSCRIPTION_SNAPSHOT).parquet(f"{tmp_path}/s"), DAY)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(snapshot_date,2024-04-01)" in plan
    assert plan.count("Exchange") == 1
