"""What the check suite keeps of the state while it runs."""

from contextlib import contextmanager
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from subtide.config import LifecycleConfig
from subtide.operators.checks import checked_state, run_checks
from subtide.operators.daily import build_subscription_daily
from subtide.plans import queries
from subtide.schemas import SUBSCRIPTION_SNAPSHOT

START, END = date(2024, 1, 1), date(2024, 1, 25)
CFG = LifecycleConfig(array_size=7, grace_days=2, winback_days=4, retention_days=9)


@pytest.fixture
def inputs(spark):
    paid = {"a": [0, 1, 2, 9, 10], "b": [0, 5, 20], "c": [3]}
    rows = [
        ("O", who, "tv", f"{who}{day // 5}", START, END, 1.5 * day, START + timedelta(days=day))
        for who, days in paid.items()
        for day in days
    ]
    columns = ["opco_code", "subscriber_id", "subscription_name", "subscription_id", "subscription_start_date",
               "subscription_end_date", "minutes_of_usage", "snapshot_date"]
    bronze = spark.createDataFrame(rows, columns).select(*SUBSCRIPTION_SNAPSHOT.names)
    feed = spark.createDataFrame([(START + timedelta(days=d),) for d in range(25)], "snapshot_date date")
    return queries.Inputs(bronze, build_subscription_daily(bronze, START, END, CFG), feed, START, END, CFG)


def test_suite_stores_each_table_once_and_no_arrays(inputs, monkeypatch):
    stored, written = [], queries.written

    @contextmanager
    def noted(df):
        stored.append(df.schema)
        with written(df) as kept:
            yield kept

    monkeypatch.setattr(queries, "written", noted)
    results = queries._suite_of(inputs).collect()
    assert [r.status for r in results] == ["PASS"] * 12
    assert len(stored) == 3  # daily rows, state, golden events
    assert not [f.name for schema in stored for f in schema if f.dataType.typeName() == "array"]


def test_checks_of_lengths_equal_checks_of_arrays(inputs):
    tables = queries._healthy(inputs)
    longer = F.when(F.col("is_churn_event") == 1, F.array_append("mou_array", F.lit(0.0))).otherwise(F.col("mou_array"))
    lost = F.when(F.col("is_addition") == 0, F.col("viewer_array"))
    broken = tables.cumulated.withColumns({"mou_array": longer, "viewer_array": lost, "mou_30d": F.col("mou_30d") + F.col("is_churned")})
    both = [
        run_checks(queries.replace(tables, cumulated=state), START, END, datetime(2024, 2, 1), CFG).orderBy("test_id").collect()
        for state in (broken, checked_state(broken))
    ]
    assert both[0] == both[1]
    assert {r.test_id for r in both[0] if r.status == "FAIL"} >= {"T05", "T08"}


@pytest.mark.parametrize("with_arrays", [False, True])
def test_no_arrays_of_days_are_sorted_or_collected(spark, inputs, with_arrays):
    fields = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(fields)
    spark.conf.set(fields, "1000")
    try:
        plan = inputs.states(with_arrays=with_arrays)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    finally:
        spark.conf.set(fields, before)
    window = next(i for i, line in enumerate(plan) if "Window" in line)
    assert any("array_repeat" in line for line in plan[:window])
    assert not any("array_repeat" in line for line in plan[window:])
