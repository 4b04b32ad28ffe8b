"""Sums of many columns in one pass."""

import random
from datetime import timedelta

from pyspark.sql import functions as F

from subtide.operators.state_bulk import paying_spans, with_history
from subtide.plans.queries import _added_up
from tests.test_suite_state import CFG, END, START

COLUMNS = ["mou_a", *[f"c{i}" for i in range(20)], "mou_b"]


def test_added_up_equals_plain_sums(spark):
    rand = random.Random(4)
    rows = [
        (rand.choice(["x", "y", None]), *[None if rand.random() < 0.3 or c == "c7" else rand.randint(-9, 9) for c in COLUMNS])
        for _ in range(200)
    ]
    schema = "g string, " + ", ".join(f"{c} {'double' if c.startswith('mou') else 'long'}" for c in COLUMNS)
    rows = [(r[0], *[float(v) if c.startswith("mou") and v is not None else v for c, v in zip(COLUMNS, r[1:])]) for r in rows]
    df = spark.createDataFrame(rows, schema)
    expected = df.groupBy("g").agg(F.count(F.lit(1)).alias("state_rows"), *[F.sum(c).alias(c) for c in COLUMNS])
    found = _added_up(df, ["g"], {c: F.col(c) for c in COLUMNS})
    assert found.dtypes == expected.dtypes
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_the_aggregate_gets_few_columns(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("g"), *[F.col("id").alias(c) for c in COLUMNS])
    plan = _added_up(df, ["g"], {c: F.col(c) for c in COLUMNS})._jdf.queryExecution().optimizedPlan()
    while "Aggregate" != plan.nodeName():
        plan = plan.children().head()
    assert plan.children().head().output().size() == 3


def test_days_out_of_reach_are_left_out_of_the_history(spark):
    rows = [("O", "O|a|tv", "a", "tv", "1", 1, 1, 2.0, END, START + timedelta(days=d)) for d in range(25)]
    daily = spark.createDataFrame(
        rows,
        "opco_code string, subscription_key string, subscriber_id string, subscription_name string, subscription_id string, "
        "is_paying_today long, is_viewer_today long, minutes_of_usage double, paid_through_date date, snapshot_date date",
    )
    spans = with_history(paying_spans(daily, START, END, CFG), CFG)
    found = spans.groupBy(F.floor((F.col("day") - F.col("first_active_day")) / CFG.array_size).alias("block"))
    sizes = {r.block: r.days for r in found.agg(F.max(F.size("activity_history")).alias("days")).collect()}
    assert sizes == {0: 7, 1: 14, 2: 14, 3: 11}
