from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from subtide.config import LifecycleConfig
from subtide.operators.events import events_from_daily, lifecycle_events
from subtide.operators.kpi import build_kpi_daily, kpi_from_daily
from subtide.operators.state_bulk import bulk_cumulated
from subtide.operators.views import kpi_daily_view
from subtide.schemas import OTT_KPI_DAILY
from tests.model import random_daily, replay
from tests.test_state import START, frame, paying_on

CONFIGS = [
    (LifecycleConfig(), 420, 24, 0.0),
    (LifecycleConfig(), 420, 24, 0.15),
    (LifecycleConfig(array_size=7, grace_days=2, winback_days=4, retention_days=9), 90, 60, 0.15),
    (LifecycleConfig(array_size=40, grace_days=0, winback_days=0, retention_days=45), 120, 40, 0.1),
]


def expected_kpis(states):
    groups = {}
    for (_, ds), row in states.items():
        groups.setdefault((row["opco_code"], ds), []).append(row)
    out = {}
    for key, rows in groups.items():
        total = lambda c: sum(r[c] for r in rows)
        people = {}
        for r in rows:
            people.setdefault(r["subscriber_id"], []).append(r)
        anyone = lambda c: {s for s, rs in people.items() if any(r[c] for r in rs)}
        row = {
            "opco_code": key[0], "additions": total("is_addition"),
            "unique_additions": len(anyone("is_addition")),
            "new_subscriptions": total("is_new_subscription"),
            "winback_subscriptions": total("is_winback_event"),
            "reacquisition_subscriptions": total("is_reacquisition_event"),
            "renewal_subscriptions": total("is_renewal_event"),
            "subscription_churn": total("is_churn_event"),
            "subscriber_churn": len(anyone("is_churn_event") - anyone("is_active_subscription")),
            "paying_subscriptions": total("is_paying"), "grace_subscriptions": total("is_in_grace"),
            "active_subscriptions": total("is_active_subscription"),
            "active_subscribers": len(anyone("is_active_subscription")), "snapshot_date": key[1],
        }
        row["closing_subscriptions"] = row["active_subscriptions"]
        row["unique_closing_subscribers"] = row["active_subscribers"]
        for w in ("1d", "7d", "30d"):
            viewers, minutes = len(anyone(f"is_viewer_{w}")), total(f"mou_{w}")
            row[f"unique_viewers_{w}"], row[f"minutes_of_usage_{w}"] = viewers, minutes
            row[f"avg_viewing_time_{w}"] = minutes / viewers if viewers else None
        out[key] = row
    return out


@pytest.mark.parametrize("cfg,days,keys,gap_rate", CONFIGS)
def test_both_kpi_builds_equal_the_model(spark, cfg, days, keys, gap_rate):
    end = START + timedelta(days=days)
    rows = random_daily(31 + days, keys, START, end, gap_rate)
    expected = expected_kpis(replay(rows, START, end, cfg))
    daily = frame(spark, rows)
    for kpi in (
        build_kpi_daily(bulk_cumulated(daily, START, end, cfg), START, end),
        kpi_from_daily(daily, START, end, cfg),
    ):
        assert kpi.columns == OTT_KPI_DAILY.names
        actual = {(r["opco_code"], r["snapshot_date"]): r.asDict() for r in kpi.collect()}
        assert actual.keys() == expected.keys()
        for key in expected:
            diff = {c: (actual[key][c], v) for c, v in expected[key].items() if actual[key][c] != v}
            assert not diff, (key, diff)


def test_kpi_without_state_refuses_windows_beyond_retention(spark):
    cfg = LifecycleConfig(array_size=90, grace_days=2, retention_days=9)
    with pytest.raises(ValueError):
        kpi_from_daily(frame(spark, []), START, START, cfg)


@pytest.mark.parametrize("cfg,days,keys,gap_rate", CONFIGS)
def test_both_event_builds_agree(spark, cfg, days, keys, gap_rate):
    end = START + timedelta(days=days)
    daily = frame(spark, random_daily(57 + days, keys, START, end, gap_rate))
    a = lifecycle_events(bulk_cumulated(daily, START, end, cfg), START, end)
    b = events_from_daily(daily, START, end, cfg)
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.count() > 0


def test_view_opens_with_the_last_existing_row(spark):
    # Day 3 has no row: day 4 opens with the closing of day 2.
    row = {n: 0 for n in OTT_KPI_DAILY.names}
    rows = [
        {**row, "opco_code": "X", "closing_subscriptions": closing, "additions": added, "snapshot_date": d}
        for closing, added, d in [
            (5, 5, date(2024, 4, 1)), (6, 1, date(2024, 4, 2)), (9, 2, date(2024, 4, 4)),
        ]
    ]
    kpi = spark.createDataFrame(
        [
            tuple(float(r[f.name]) if f.dataType.typeName() == "double" else r[f.name] for f in OTT_KPI_DAILY)
            for r in rows
        ],
        OTT_KPI_DAILY,
    )
    got = kpi_daily_view(kpi).orderBy("snapshot_date").collect()
    assert [r["opening_subscriptions"] for r in got] == [None, 5, 6]
    assert [r["roll_forward_variance"] for r in got] == [None, 0, 1]
    assert got[2]["week_start"] == date(2024, 4, 1) and got[2]["quarter_start"] == date(2024, 4, 1)


def test_opco_filter_reaches_below_the_view_window(spark, tmp_path):
    spark.createDataFrame([], OTT_KPI_DAILY).write.parquet(f"{tmp_path}/kpi")
    view = kpi_daily_view(spark.read.schema(OTT_KPI_DAILY).parquet(f"{tmp_path}/kpi"))
    plan = view.where(F.col("opco_code") == "X")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(opco_code,X)" in plan


def test_a_subscriber_with_another_plan_does_not_churn(spark):
    rows = [
        {**r, "subscription_key": f"X|s|{plan}", "subscriber_id": "s", "subscription_name": plan}
        for plan, days in (("a", range(1)), ("b", range(34)))
        for r in paying_on(days)
    ]
    end = START + timedelta(days=80)
    rows += paying_on(range(81), key="other")
    daily = frame(spark, rows)
    for kpi in (
        kpi_from_daily(daily, START, end),
        build_kpi_daily(bulk_cumulated(daily, START, end), START, end),
    ):
        churn = {r["snapshot_date"]: r for r in kpi.where("subscription_churn > 0").collect()}
        first, last = START + timedelta(days=31), START + timedelta(days=64)
        assert {d: (r["subscription_churn"], r["subscriber_churn"]) for d, r in churn.items()} == {
            first: (1, 0),
            last: (1, 1),
        }
