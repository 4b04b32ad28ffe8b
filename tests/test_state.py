import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from subtide.config import LifecycleConfig
from subtide.operators.daily import build_subscription_daily
from subtide.operators.state_bulk import bulk_cumulated, feed_calendar
from subtide.operators.state_step import step_all_days, step_cumulated
from subtide.schemas import HISTORY_COLUMNS, SUBSCRIPTION_CUMULATED, SUBSCRIPTION_DAILY
from tests.model import random_daily, replay

START = date(2024, 1, 1)


def frame(spark, rows):
    names = SUBSCRIPTION_DAILY.names
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SUBSCRIPTION_DAILY)


def collected(df):
    return {(r["subscription_key"], r["snapshot_date"]): r.asDict() for r in df.collect()}


def assert_same(actual, expected):
    assert actual.keys() == expected.keys()
    for key, row in expected.items():
        got = actual[key]
        diff = {c: (got[c], row[c]) for c in got if got[c] != row[c]}
        assert not diff, (key, diff)


CONFIGS = [
    (LifecycleConfig(), 420, 24),
    (LifecycleConfig(array_size=7, grace_days=2, winback_days=4, retention_days=9), 90, 60),
    (LifecycleConfig(array_size=40, grace_days=0, winback_days=0, retention_days=1), 60, 40),
    (LifecycleConfig(array_size=1, grace_days=3, winback_days=50, retention_days=12), 90, 40),
]


@pytest.mark.parametrize("cfg,days,keys", CONFIGS)
@pytest.mark.parametrize("gap_rate", [0.0, 0.15])
def test_bulk_equals_replay(spark, cfg, days, keys, gap_rate):
    end = START + timedelta(days=days)
    rows = random_daily(7 + days, keys, START, end, gap_rate)
    actual = collected(bulk_cumulated(frame(spark, rows), START, end, cfg))
    assert_same(actual, replay(rows, START, end, cfg))


def test_step_equals_replay_day_by_day(spark):
    cfg = LifecycleConfig(array_size=7, grace_days=2, winback_days=4, retention_days=9)
    end = START + timedelta(days=25)
    rows = random_daily(3, 30, START, end, 0.2)
    expected = replay(rows, START, end, cfg)
    daily = frame(spark, rows).cache()
    yesterday, ds = [], START
    while ds <= end:
        today = daily.where(F.col("snapshot_date") == F.lit(ds))
        state = step_cumulated(
            spark.createDataFrame(yesterday, SUBSCRIPTION_CUMULATED), today, ds, not today.isEmpty(), cfg
        )
        yesterday = state.collect()
        got = {(r["subscription_key"], ds): r.asDict() for r in yesterday}
        assert_same(got, {k: v for k, v in expected.items() if k[1] == ds})
        ds += timedelta(days=1)
    daily.unpersist()


@pytest.mark.parametrize("cfg,days,keys", CONFIGS)
def test_bulk_obeys_the_step_on_every_day(spark, cfg, days, keys):
    end = START + timedelta(days=days)
    daily = frame(spark, random_daily(11, keys, START, end, 0.1)).cache()
    bulk = bulk_cumulated(daily, START, end, cfg).cache()
    stepped = step_all_days(bulk, daily, feed_calendar(daily, START, end), end, cfg)
    assert bulk.exceptAll(stepped).isEmpty() and stepped.exceptAll(bulk).isEmpty()
    daily.unpersist(), bulk.unpersist()


@pytest.mark.parametrize("cfg,days,keys", CONFIGS)
def test_a_range_goes_on_from_state(spark, cfg, days, keys):
    """From the state of any day, with the daily rows after it alone; feed gaps fall on the seam too."""
    end = START + timedelta(days=days)
    starts = [START + timedelta(days=int(days * share)) for share in (0.3, 0.5, 0.8)]
    rows = [r for r in random_daily(23 + days, keys, START, end, 0.2) if r["snapshot_date"] != starts[1]]
    expected = replay(rows, START, end, cfg)
    for start in starts:
        day_before = [v for (_, day), v in expected.items() if day == start - timedelta(days=1)]
        state = spark.createDataFrame([tuple(v[n] for n in SUBSCRIPTION_CUMULATED.names) for v in day_before], SUBSCRIPTION_CUMULATED)
        later = frame(spark, [r for r in rows if r["snapshot_date"] >= start])
        got = bulk_cumulated(later, start, end, cfg, earlier=state)
        assert_same(collected(got), {k: v for k, v in expected.items() if k[1] >= start})


def test_emit_from_and_no_arrays_only_leave_things_out(spark):
    cfg, end = LifecycleConfig(), START + timedelta(days=300)
    daily = frame(spark, random_daily(5, 15, START, end, 0.05))
    middle = START + timedelta(days=200)
    whole = bulk_cumulated(daily, START, end, cfg).where(F.col("snapshot_date") >= F.lit(middle))
    late = bulk_cumulated(daily, START, end, cfg, emit_from=middle)
    assert_same(collected(late), collected(whole))
    scalar = bulk_cumulated(daily, START, end, cfg, emit_from=middle, with_arrays=False)
    assert_same(collected(scalar), collected(whole.drop(*HISTORY_COLUMNS)))


def paying_on(offsets, key="A", ids=None, minutes=None):
    return [
        {
            "opco_code": "X", "subscription_key": f"X|{key}|p", "subscriber_id": key, "subscription_name": "p",
            "subscription_id": (ids or {}).get(o, "i"), "is_paying_today": 1,
            "is_viewer_today": int((minutes or {}).get(o, 0.0) >= 1.0),
            "minutes_of_usage": (minutes or {}).get(o, 0.0), "subscription_start_date": START,
            "paid_through_date": START, "snapshot_date": START + timedelta(days=o),
        }
        for o in offsets
    ]


@pytest.mark.parametrize(
    "gap,event",
    [
        (1, None), (31, None), (32, "is_winback_event"), (121, "is_winback_event"),
        (122, "is_reacquisition_event"), (181, "is_reacquisition_event"), (182, "is_new_subscription"),
    ],
)
def test_gap_boundaries(spark, gap, event):
    # A second key keeps the feed alive on every day.
    rows = paying_on([0, gap]) + paying_on(range(gap + 1), key="B")
    day = START + timedelta(days=gap)
    states = collected(bulk_cumulated(frame(spark, rows), START, day))
    row = states[("X|A|p", day)]
    events = ["is_new_subscription", "is_winback_event", "is_reacquisition_event"]
    assert [e for e in events if row[e]] == ([event] if event else [])
    assert row["is_addition"] == int(event is not None)
    assert row["is_renewal_event"] == 0


def test_idle_boundaries(spark):
    rows = paying_on([0]) + paying_on(range(200), key="B")
    states = collected(bulk_cumulated(frame(spark, rows), START, START + timedelta(days=199)))
    at = lambda o: states.get(("X|A|p", START + timedelta(days=o)))
    assert (at(30)["is_in_grace"], at(30)["is_churned"]) == (1, 0)
    assert (at(31)["is_in_grace"], at(31)["is_churn_event"], at(31)["days_since_churn"]) == (0, 1, 0)
    assert (at(32)["is_churned"], at(32)["is_churn_event"]) == (1, 0)
    assert (at(121)["is_in_winback_window"], at(122)["is_in_winback_window"]) == (1, 0)
    assert at(180) is not None and at(181) is None
    assert [len(at(o)["activity_array"]) for o in (88, 89, 90)] == [89, 90, 90]


def test_renewal_needs_two_known_ids(spark):
    ids = {0: "a", 1: "b", 2: None, 3: "b", 4: "c"}
    rows = paying_on(range(5), ids=ids)
    states = collected(bulk_cumulated(frame(spark, rows), START, START + timedelta(days=4)))
    renewals = [states[("X|A|p", START + timedelta(days=o))]["is_renewal_event"] for o in range(5)]
    assert renewals == [0, 1, 0, 0, 1]


def test_feed_gap_carries_payers(spark):
    cfg = LifecycleConfig(grace_days=1, winback_days=4, retention_days=9)
    # Nobody reports on days 2 and 3.
    rows = paying_on([0, 1, 4], key="A") + paying_on([0, 4], key="B")
    states = collected(bulk_cumulated(frame(spark, rows), START, START + timedelta(days=4), cfg))
    a, b = ("X|A|p", "X|B|p")
    on = lambda key, o: states[(key, START + timedelta(days=o))]
    assert [on(a, o)["is_paying"] for o in range(5)] == [1, 1, 1, 1, 1]
    assert on(a, 3)["last_active_date"] == START + timedelta(days=3)
    assert [on(b, o)["is_churn_event"] for o in range(5)] == [0, 0, 1, 0, 0]
    assert on(b, 4)["is_winback_event"] == 1 and on(b, 4)["days_since_churn"] == 2
    assert on(b, 4)["churn_date"] is None


def test_config_rejects_retention_within_grace():
    with pytest.raises(ValueError):
        LifecycleConfig(grace_days=30, retention_days=30)


def test_fractional_minutes_stay_within_rounding(spark):
    rng = random.Random(1)
    rows = paying_on(range(400), minutes={o: round(rng.uniform(0, 300), 2) for o in range(0, 400, 3)})
    end = START + timedelta(days=460)
    got = collected(bulk_cumulated(frame(spark, rows + paying_on(range(461), key="B")), START, end))
    want = replay(rows + paying_on(range(461), key="B"), START, end, LifecycleConfig())
    for key, row in want.items():
        for c in ("mou_7d", "mou_30d", "mou_90d"):
            assert got[key][c] == pytest.approx(row[c], abs=1e-8)
            assert row[c] != 0 or got[key][c] == 0


def test_fractional_and_large_minutes_are_exact(spark):
    """A large value leaves with the history; the step adds up the same."""
    rng = random.Random(4)
    minutes = {o: round(rng.uniform(0, 300), 2) for o in range(1, 200)} | {0: 1e9}
    rows, end = paying_on(range(200), minutes=minutes), START + timedelta(days=199)
    daily = frame(spark, rows)
    bulk = bulk_cumulated(daily, START, end)
    got = {r["snapshot_date"]: r for r in bulk.collect()}
    last = got[end]
    assert (last["mou_1d"], last["mou_7d"]) == (minutes[199], round(sum(minutes[o] for o in range(193, 200)), 2))
    assert last["mou_90d"] == round(sum(minutes[o] for o in range(110, 200)), 2)
    stepped = step_all_days(bulk, daily, feed_calendar(daily, START, end), end, LifecycleConfig())
    assert bulk.exceptAll(stepped).isEmpty() and stepped.exceptAll(bulk).isEmpty()


def test_a_hot_subscription_is_reduced_before_the_shuffle(spark):
    """A third of all rows belongs to one subscription; it arrives as one row per day."""
    n, end = 60_000, START + timedelta(days=9)
    bronze = spark.range(n).select(
        F.lit("X").alias("opco_code"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 2000)).alias("subscriber_id"),
        F.lit("p").alias("subscription_name"),
        (F.col("id") % 7).cast("string").alias("subscription_id"),
        F.lit(START).alias("subscription_start_date"),
        F.lit(end).alias("subscription_end_date"),
        F.lit(1.0).alias("minutes_of_usage"),
        F.date_add(F.lit(START), (F.col("id") % 10).cast("int")).alias("snapshot_date"),
    )
    daily = build_subscription_daily(bronze, START, end)
    hot = daily.where(F.col("subscriber_id") == "hot").collect()
    assert len(hot) == 10 and sum(r["minutes_of_usage"] for r in hot) == n / 3
    plan = daily._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "partial_sum" in plan[exchange:] and "partial_sum" not in plan[:exchange]
