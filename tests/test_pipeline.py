from datetime import datetime, timedelta
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from subtide.__main__ import main
from subtide.config import LifecycleConfig
from subtide.operators.checks import CHECKS, ChecksFailed, Tables, run_checks
from subtide.operators.daily import build_subscription_daily
from subtide.operators.events import EVENT_KEYS, lifecycle_events
from subtide.operators.state_bulk import bulk_cumulated
from subtide.plans.pipeline import (
    DAILY, KPI, SNAPSHOT, STATE, backfill, kpi_view, load_ott_kpi_daily, load_snapshots,
    changed_keys, load_golden_events, load_subscription_cumulated, load_subscription_cumulated_range, load_subscription_daily, rebuilt_states,
    register_views, rejects_by_load, repair, replay_rejects, run_pipeline, stored_tables, validate,
)
from subtide.plans.runlog import LoadFailed
from subtide.schemas import RAW_SNAPSHOT, SUBSCRIPTION_SNAPSHOT, TEST_EXPECTED_EVENTS
from subtide.sources.scratch import written
from subtide.sources.tables import Warehouse
from tests.model import random_daily, replay
from tests.test_kpi import expected_kpis
from tests.test_state import START, assert_same, collected

CFG = LifecycleConfig(array_size=7, grace_days=2, winback_days=4, retention_days=9)
END = START + timedelta(days=17)


@pytest.fixture
def warehouse(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), f"wh_{uuid4().hex[:8]}", buckets=4)
    yield wh
    wh.drop()


def fill_snapshots(wh, rows):
    data = [
        (r["opco_code"], r["subscriber_id"], r["subscription_name"], r["subscription_id"],
         r["subscription_start_date"], r["paid_through_date"], r["minutes_of_usage"], r["snapshot_date"])
        for r in rows
    ]
    wh.replace_touched(SNAPSHOT, wh.spark.createDataFrame(data, SUBSCRIPTION_SNAPSHOT))


def expect_all_events(wh, start=START, end=END):
    events = lifecycle_events(wh.table(STATE), start, end).select(*EVENT_KEYS)
    wh.replace_all("test_expected_events", events)


@pytest.fixture(scope="module")
def rows():
    # No feed gaps: on one, the fourth check compares carried payers with no daily rows.
    return random_daily(99, 30, START, END, 0.0)


def test_bulk_backfill_then_steps_equal_the_model(warehouse, rows):
    fill_snapshots(warehouse, rows)
    middle = START + timedelta(days=15)
    backfill(warehouse, START, middle, CFG)
    backfill(warehouse, middle + timedelta(days=1), END, CFG, mode="step")
    expected = replay(rows, START, END, CFG)
    assert_same(collected(warehouse.table(STATE)), expected)
    kpis = expected_kpis(expected)
    got = {(r["opco_code"], r["snapshot_date"]): r.asDict() for r in warehouse.table(KPI).collect()}
    assert got.keys() == kpis.keys()
    assert all(got[k][c] == v for k in kpis for c, v in kpis[k].items())
    assert kpi_view(warehouse).where("roll_forward_variance <> 0").isEmpty()
    stored = warehouse.table(KPI).collect()
    load_ott_kpi_daily(warehouse, START, END, CFG, source="daily")
    assert sorted(warehouse.table(KPI).collect()) == sorted(stored)
    # Bulk again over the tail, with the first days as history, changes nothing.
    backfill(warehouse, middle, END, CFG)
    assert_same(collected(warehouse.table(STATE)), expected)
    log = warehouse.table("etl_run_log").groupBy("proc_name", "status").count().collect()
    steps = (END - middle).days
    assert {(r[0], r[1]): r[2] for r in log} == {
        ("load_subscription_daily", "SUCCESS"): steps + 2,
        ("load_subscription_cumulated", "SUCCESS"): steps + 2,
        ("load_ott_kpi_daily", "SUCCESS"): steps + 3,
    }
    expect_all_events(warehouse)
    results = validate(warehouse, START, END, CFG)
    assert [r["status"] for r in results.collect()] == ["PASS"] * 12


def test_a_range_goes_on_from_stored_state_or_refuses(spark, warehouse, rows):
    fill_snapshots(warehouse, rows)
    middle, later = END - timedelta(days=6), END - timedelta(days=5)
    backfill(warehouse, START, middle, CFG)
    warehouse.replace_range(DAILY, warehouse.table(DAILY).where("false"), START, middle)
    before = collected(warehouse.table(STATE))
    # Without state the day before, every life would start over.
    with pytest.raises(LoadFailed, match="state from before"):
        load_subscription_cumulated_range(warehouse, END, END, CFG)
    assert collected(warehouse.table(STATE)) == before
    backfill(warehouse, later, END, CFG)
    expected = replay(rows, START, END, CFG)
    assert_same(collected(warehouse.table(STATE)), expected)
    backfill(warehouse, END - timedelta(days=1), END, CFG, mode="step")
    assert_same(collected(warehouse.table(STATE)), expected)
    # It reads one date of the state and the daily rows of the range.
    states = bulk_cumulated(
        warehouse.read(DAILY, later, END), later, END, CFG, distributed=True, earlier=warehouse.read(STATE, middle)
    )
    read = {path.split("snapshot_date=")[1][:10] for path in states.inputFiles() if f"/{STATE}/" in path}
    assert read == {str(middle)}
    read = {path.split("snapshot_date=")[1][:10] for path in states.inputFiles() if f"/{DAILY}/" in path}
    assert min(read) == str(later)


def test_rerun_replaces_and_an_emptied_day_becomes_empty(warehouse, rows):
    fill_snapshots(warehouse, rows)
    day = START + timedelta(days=1)
    backfill(warehouse, START, day, CFG)
    before = warehouse.table(DAILY).count()
    load_subscription_daily(warehouse, START, day, CFG)
    assert warehouse.table(DAILY).count() == before
    warehouse.replace_day(SNAPSHOT, warehouse.table(SNAPSHOT).where("false"), day)
    assert load_subscription_daily(warehouse, START, day, CFG) > 0
    assert warehouse.read(DAILY, day).isEmpty() and not warehouse.read(DAILY, START).isEmpty()
    assert load_subscription_daily(warehouse, day, cfg=CFG) == 0
    last = warehouse.table("etl_run_log").orderBy(F.desc("run_ts")).first()
    assert (last["status"], last["rows_affected"], last["ds"]) == ("SKIPPED", 0, day)


def test_feed_gap_is_carried_by_the_step(warehouse):
    last = START + timedelta(days=4)
    rows = [r for r in random_daily(4, 20, START, last, 0.0) if r["snapshot_date"] != START + timedelta(days=2)]
    fill_snapshots(warehouse, rows)
    backfill(warehouse, START, last, CFG, mode="step")
    assert_same(collected(warehouse.table(STATE)), replay(rows, START, last, CFG))
    messages = {r["message"] for r in warehouse.table("etl_run_log").collect()}
    assert any(m and m.startswith("feed missing") for m in messages)


def test_missing_yesterday_stops_the_step(warehouse, rows):
    fill_snapshots(warehouse, rows)
    run_pipeline(warehouse, START, CFG)
    with pytest.raises(LoadFailed):
        run_pipeline(warehouse, START + timedelta(days=2), CFG)
    failed = warehouse.table("etl_run_log").where("status = 'FAILED'").collect()
    assert [r["proc_name"] for r in failed] == ["load_subscription_cumulated"]
    load_subscription_cumulated(warehouse, START + timedelta(days=2), CFG, allow_cold_start=True)


def test_null_opco_fails_loudly(warehouse, rows):
    fill_snapshots(warehouse, [{**rows[0], "opco_code": None}])
    with pytest.raises(LoadFailed, match="must not be NULL"):
        load_subscription_daily(warehouse, rows[0]["snapshot_date"], cfg=CFG)


def test_tables_survive_a_new_catalog(spark, warehouse, rows):
    fill_snapshots(warehouse, rows)
    backfill(warehouse, START, START + timedelta(days=2), CFG)
    count = warehouse.table(STATE).count()
    with pytest.warns(UserWarning, match="16 is ignored"):
        again = Warehouse(spark, warehouse.root, f"{warehouse.database}_b", buckets=16)
    assert again.buckets == 4 and again.table(STATE).count() == count > 0
    again.drop()


def test_key_joins_and_windows_do_not_shuffle(spark, warehouse, rows):
    from subtide.operators.checks import check_t02
    from subtide.operators.kpi import build_kpi_daily
    from subtide.operators.state_bulk import paying_spans
    from subtide.operators.state_step import step_cumulated

    fill_snapshots(warehouse, rows)
    backfill(warehouse, START, START + timedelta(days=2), CFG)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        step = step_cumulated(
            warehouse.read(STATE, START + timedelta(days=1)), warehouse.read(DAILY, START + timedelta(days=2)),
            START + timedelta(days=2), True, CFG,
        )
        plan = step._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        spans = paying_spans(warehouse.read(DAILY, START, END), START, END, CFG, distributed=True)
        plan = spans._jdf.queryExecution().executedPlan().toString()
        # Only the feed calendar is exchanged: its distinct dates and the broadcast of them.
        assert "hashpartitioning(subscription_key" not in plan
        kpi = build_kpi_daily(warehouse.table(STATE), START, END)
        plan = kpi._jdf.queryExecution().executedPlan().toString()
        assert "_array" not in plan and "PartitionFilters: [isnotnull(snapshot_date" in plan
        t02 = check_t02(stored_tables(warehouse), START, END)
        assert "hashpartitioning" not in t02._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_landing_files_reach_the_snapshot_table(spark, warehouse):
    def raw(*rows):
        return spark.createDataFrame([tuple(r) for r in rows], RAW_SNAPSHOT)

    assert load_snapshots(warehouse, raw(("4/1/2024", "i1", "P", "s1", None, None, "5")), "X") == 1
    later = raw(("4/1/2024", "i1", "P", "s1", None, None, "7"), ("4/2/2024", "i1", "P", "s1", None, None, "8"))
    load_snapshots(warehouse, later, "X")
    got = [r["minutes_of_usage"] for r in warehouse.table(SNAPSHOT).orderBy("snapshot_date").collect()]
    assert got == [7.0, 8.0]
    bad = raw(("soon", "i1", "P", "s1", None, None, "7"))
    with pytest.raises(ValueError, match="snapshot_date"):
        load_snapshots(warehouse, bad, "X")
    assert load_snapshots(warehouse, bad, "X", allow_rejects=True) == 0
    with pytest.raises(ValueError, match="repeat a key"):
        load_snapshots(warehouse, later.union(later), "X")


@pytest.fixture(scope="module")
def healthy(spark, rows):
    data = [
        (r["opco_code"], r["subscriber_id"], r["subscription_name"], r["subscription_id"],
         r["subscription_start_date"], r["paid_through_date"], r["minutes_of_usage"], r["snapshot_date"])
        for r in rows
    ]
    bronze = spark.createDataFrame(data, SUBSCRIPTION_SNAPSHOT).cache()
    daily = build_subscription_daily(bronze, START, END).cache()
    cumulated = bulk_cumulated(daily, START, END, CFG).cache()
    return Tables(bronze, daily, cumulated, lifecycle_events(cumulated, START, END).select(*EVENT_KEYS).cache())


def first_row(df, condition="true"):
    return df.where(condition).orderBy("snapshot_date", "subscription_key").limit(1)


def changed(df, condition, **values):
    """One row that meets the condition, changed."""
    row = first_row(df, condition)
    rest = df.join(row.select("subscription_key", "snapshot_date"), ["subscription_key", "snapshot_date"], "left_anti")
    return rest.select(*df.columns).unionByName(row.withColumns({c: F.expr(v) for c, v in values.items()}))


CORRUPTIONS = {
    "T01": ("daily", lambda df: df.unionByName(first_row(df)), 1),
    "T02": ("cumulated", lambda df: df.unionByName(first_row(df)), 1),
    "T03": ("bronze", lambda df: df.withColumn("minutes_of_usage", F.col("minutes_of_usage") + 1), 18),
    "T04": ("cumulated", lambda df: changed(df, "is_paying = 1", is_paying="0L"), 1),
    "T05": ("cumulated", lambda df: changed(df, "true", mou_array="array_append(mou_array, 0D)"), 1),
    "T06": ("cumulated", lambda df: changed(df, "is_paying = 1", is_churned="1L"), 1),
    "T07": ("cumulated", lambda df: changed(df, "is_paying = 1", mou_1d="mou_1d + 1"), 1),
    "T08": ("cumulated", lambda df: changed(df, f"snapshot_date = DATE'{END}'", mou_30d="mou_30d + 1"), 1),
    # A wrong addition is off on its own day only.
    "T09": ("cumulated", lambda df: changed(df, f"snapshot_date = DATE'{END}'", is_addition="is_addition + 1"), 1),
    "T10": ("cumulated", lambda df: df.where(F.col("snapshot_date") != F.lit(START + timedelta(days=3))), 1),
    "T11": ("cumulated", lambda df: changed(df, "is_churned = 1", churn_date="CAST(NULL AS DATE)"), 1),
    "T12": ("expected_events", lambda df: df.limit(df.count() - 2), 2),
}


@pytest.mark.parametrize("test_id", sorted(CORRUPTIONS))
def test_each_check_fails_on_its_own_corruption(healthy, test_id):
    check = CHECKS[test_id]
    assert check(healthy, START, END, CFG).first()["bad"] == 0
    table, corrupt, bad = CORRUPTIONS[test_id]
    tables = Tables(**{**healthy.__dict__, table: corrupt(getattr(healthy, table))})
    assert check(tables, START, END, CFG).first()["bad"] == bad
    now = datetime(2024, 6, 1, 12)
    together = {r["test_id"]: r for r in run_checks(tables, START, END, now, CFG).collect()}
    assert sorted(together) == sorted(CHECKS)
    assert together[test_id]["failed_rows"] == bad and together[test_id]["status"] == "FAIL"
    assert together[test_id]["actual"] == str(bad)


def test_t12_names_missing_and_unexpected_events(spark, healthy):
    extra = spark.createDataFrame([("nobody", START, "NEW")], TEST_EXPECTED_EVENTS)
    row = CHECKS["T12"](Tables(**{**healthy.__dict__, "expected_events": extra}), START, END, CFG).first()
    total = healthy.expected_events.count()
    assert row["bad"] == total + 1 and row["detail"].count(",") == 49
    only = Tables(**{**healthy.__dict__, "expected_events": healthy.expected_events.unionByName(extra)})
    assert CHECKS["T12"](only, START, END, CFG).first()["detail"] == f"nobody|{START}|NEW|MISSING"


def test_validate_replaces_its_runs_results_and_raises(spark, warehouse, rows):
    fill_snapshots(warehouse, rows)
    last = START + timedelta(days=4)
    backfill(warehouse, START, last, CFG)
    for run_id in ("default", "other"):
        with pytest.raises(ChecksFailed, match="1 checks failed"):
            validate(warehouse, START, last, CFG, run_id=run_id)
    expect_all_events(warehouse)
    # The other run's failure of the day neither goes nor counts.
    assert {r["status"] for r in validate(warehouse, START, last, CFG).collect()} == {"PASS"}
    failed = warehouse.table("test_results").groupBy("run_id").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "FAIL").alias("bad"))
    assert sorted(map(tuple, failed.collect())) == [("default", 12, 0), ("other", 12, 1)]
    with pytest.raises(ValueError, match="needs an id"):
        validate(warehouse, START, last, CFG, run_id="")


def test_feed_gaps_may_be_tolerated(spark, warehouse):
    last = START + timedelta(days=4)
    fill_snapshots(warehouse, [r for r in random_daily(4, 20, START, last, 0.0) if r["snapshot_date"] != START + timedelta(days=2)])
    backfill(warehouse, START, last, CFG)
    expect_all_events(warehouse, START, last)
    with pytest.raises(ChecksFailed):
        validate(warehouse, START, last, CFG)
    validate(warehouse, START, last, CFG, tolerate_feed_gaps=True)


def corrected(rows, first, last):
    """Other minutes for some, no rows for others, between two dates."""
    out = []
    for i, r in enumerate(rows):
        if first <= r["snapshot_date"] <= last:
            if r["subscriber_id"] == "s1":
                continue
            if r["subscriber_id"] == "s3":
                r = {**r, "minutes_of_usage": r["minutes_of_usage"] + 3, "is_viewer_today": 1}
        out.append(r)
    return out


def test_repair_redoes_what_changed_and_no_more(spark, warehouse, rows):
    fill_snapshots(warehouse, rows)
    backfill(warehouse, START, END, CFG)
    first, last = START + timedelta(days=4), START + timedelta(days=6)
    assert repair(warehouse, first, last, CFG) == 0
    runs = warehouse.table("etl_run_log").count()
    right = corrected(rows, first, last)
    days = {r["snapshot_date"] for r in right if first <= r["snapshot_date"] <= last}
    fill_snapshots(warehouse, [r for r in right if r["snapshot_date"] in days])
    changed = changed_keys(warehouse.read(DAILY, first, last), build_subscription_daily(warehouse.table(SNAPSHOT), first, last, CFG)).collect()
    touched = {r["subscription_key"] for r in rows if r["subscriber_id"] in ("s1", "s3") and first <= r["snapshot_date"] <= last}
    assert {r[0] for r in changed} == touched and touched
    assert repair(warehouse, first, last, CFG) == len(touched)
    expected = replay(right, START, END, CFG)
    assert_same(collected(warehouse.table(STATE)), expected)
    kpis = expected_kpis(expected)
    got = {(r["opco_code"], r["snapshot_date"]): r.asDict() for r in warehouse.table(KPI).collect()}
    assert got.keys() == kpis.keys() and all(got[k][c] == v for k in kpis for c, v in kpis[k].items())
    messages = [r["message"] for r in warehouse.table("etl_run_log").orderBy("run_ts").collect()][runs:]
    assert messages == [f"repair of {first}..{last}: {len(touched)} subscriptions differ", f"repair of {first}..{END}", f"range {first}..{END}"]
    # Only the changed subscriptions are built.
    keys = spark.createDataFrame([(k,) for k in touched], "subscription_key string")
    rebuilt = rebuilt_states(warehouse, keys, first, END, CFG)
    assert {r["subscription_key"] for r in rebuilt.select("subscription_key").distinct().collect()} <= touched
    plan = rebuilt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2  # the daily rows and the state of the day before


def test_repair_builds_all_if_the_feed_calendar_changes(warehouse, rows):
    gap = START + timedelta(days=5)
    fill_snapshots(warehouse, [r for r in rows if r["snapshot_date"] != gap])
    backfill(warehouse, START, END, CFG)
    fill_snapshots(warehouse, [r for r in rows if r["snapshot_date"] == gap])
    assert repair(warehouse, gap, gap, CFG) > 0
    assert_same(collected(warehouse.table(STATE)), replay(rows, START, END, CFG))
    warehouse.replace_range(SNAPSHOT, warehouse.table(SNAPSHOT).where("false"), gap, gap)
    repair(warehouse, gap, gap, CFG)
    assert_same(collected(warehouse.table(STATE)), replay([r for r in rows if r["snapshot_date"] != gap], START, END, CFG))
    assert gap not in warehouse.partitions(DAILY)


def test_dates_without_rows_go_together_without_jobs(spark, warehouse, rows):
    fill_snapshots(warehouse, rows)
    load_subscription_daily(warehouse, START, END, CFG)
    jobs = spark.sparkContext.statusTracker()
    with written(warehouse.read(DAILY, START)) as kept:
        spark.sparkContext.setJobGroup("drop", "drop")
        warehouse.replace_range(DAILY, kept, START, END)
        count = len(jobs.getJobIdsForGroup("drop"))
        spark.sparkContext.setJobGroup("tests", "tests")
    assert warehouse.partitions(DAILY) == [START] and count <= 3
    again = Warehouse(spark, warehouse.root, f"{warehouse.database}_c")
    assert again.partitions(DAILY) == [START]
    again.drop()


@pytest.mark.parametrize("mode", ["bulk", "step"])
def test_each_opco_has_its_own_feed(warehouse, mode):
    cfg = LifecycleConfig(array_size=7, grace_days=2, winback_days=4, retention_days=9, feed_scope="opco")
    last = START + timedelta(days=6)
    late = {START + timedelta(days=2), START + timedelta(days=3), START + timedelta(days=5)}
    rows = [r for r in random_daily(5, 24, START, last, 0.0) if not (r["opco_code"] == "OP1" and r["snapshot_date"] in late)]
    fill_snapshots(warehouse, rows)
    first = START + timedelta(days=3)
    backfill(warehouse, START, first - timedelta(days=1), cfg)
    backfill(warehouse, first, last, cfg, mode=mode)
    assert_same(collected(warehouse.table(STATE)), replay(rows, START, last, cfg))
    if mode == "step":
        assert "feed missing for OP1: their payers carried" in {r["message"] for r in warehouse.table("etl_run_log").collect()}


def test_rows_that_cannot_be_loaded_are_kept_and_replayed(spark, warehouse):
    def raw(*rows):
        return spark.createDataFrame([tuple(r) for r in rows], RAW_SNAPSHOT)

    good, keyless = ("4/1/2024", "i1", "P", "s1", None, None, "5"), ("4/1/2024", None, "P", "s1", None, None, "6")
    unread = ("soon", "i2", "P", "s1", None, None, "7")
    rejects = lambda: sorted(tuple(r) for r in warehouse.table("landing_rejects").select("load_id", "reject_reason", "minutes_of_usage").collect())
    # A row without a key is set aside and stops nothing, and loading it twice changes nothing.
    for _ in range(2):
        assert load_snapshots(warehouse, raw(good, keyless), "X", load_id="a") == 1
    assert rejects() == [("a", "no subscription_id", "6")]
    with pytest.raises(ValueError, match="1 unreadable"):
        load_snapshots(warehouse, raw(good, unread, keyless), "X", load_id="b")
    assert rejects() == [("a", "no subscription_id", "6"), ("b", "no subscription_id", "6"), ("b", "snapshot_date", "7")]
    mended = lambda df: df.withColumn("snapshot_date", F.lit("2024-04-02"))
    assert replay_rejects(warehouse, "b", mended) == 1
    assert rejects() == [("a", "no subscription_id", "6"), ("b", "no subscription_id", "6")]
    assert replay_rejects(warehouse, "b", lambda df: df.withColumn("subscription_id", F.lit("i9"))) == 2
    assert rejects() == [("a", "no subscription_id", "6")] and replay_rejects(warehouse, "none", mended) == 0
    assert sorted(tuple(r) for r in rejects_by_load(warehouse).collect()) == [("a", "X", "no subscription_id", 1)]
    assert sorted(r["minutes_of_usage"] for r in warehouse.table(SNAPSHOT).collect()) == [5.0, 6.0, 7.0]
    with pytest.raises(ValueError, match="letters"):
        load_snapshots(warehouse, raw(good), "X", load_id="a/b")
    register_views(warehouse, raw(good, unread, keyless), "X")
    view = spark.table("opco_raw_subscribers_vw")
    assert view.count() == 3 and view.where("reject_reason IS NOT NULL").count() == 1


def test_golden_events_replace_their_dates(spark, warehouse):
    def raw(*rows):
        return spark.createDataFrame(list(rows), "subscriber_id string, event_date string, event_type string")

    day = START + timedelta(days=1)
    assert load_golden_events(warehouse, raw(("s1", "1/1/2024", "new"), ("s2", str(day), " CHURN "))) == 2
    assert load_golden_events(warehouse, raw(("s3", "2024-01-01", "Winback"))) == 1
    stored = lambda: sorted(tuple(r) for r in warehouse.table("test_expected_events").select(*EVENT_KEYS).collect())
    assert stored() == [("s2", day, "CHURN"), ("s3", START, "WINBACK")]
    load_golden_events(warehouse, raw(("s4", str(START), "NEW")), START, day)
    assert stored() == [("s4", START, "NEW")]
    for bad in (("s1", "soon", "NEW"), (None, str(day), "NEW"), ("s1", str(day), "BORN"), ("s1", str(day), None)):
        with pytest.raises(ValueError, match="unreadable golden events"):
            load_golden_events(warehouse, raw(bad))
    assert load_golden_events(warehouse, raw(("s1", "soon", "NEW"), ("s5", str(day), "NEW")), allow_rejects=True) == 1
    with pytest.raises(ValueError, match="outside"):
        load_golden_events(warehouse, raw(("s1", str(END), "NEW")), START, day)


def test_command_line_runs_the_jobs(spark, tmp_path):
    database = f"cli_{uuid4().hex[:8]}"
    (tmp_path / "day.csv").write_text(",".join(RAW_SNAPSHOT.names) + "\n1/2/2024,i1,P,s1,1/1/2024,2/1/2024,5\n")
    options = ["--root", str(tmp_path / "wh"), "--database", database, "--buckets", "2"]
    main([*options, "load", str(tmp_path / "day.csv"), "--opco", "X"])
    main([*options, "--grace-days", "3", "--feed-scope", "opco", "backfill", "2024-01-02", "2024-01-02", "--kpi-source", "daily"])
    wh = Warehouse(spark, str(tmp_path / "wh"), database)
    register_views(wh)
    assert spark.sql("SELECT closing_subscriptions FROM vw_ott_kpi_daily").collect() == [(1,)]
    with pytest.raises(ChecksFailed):
        main([*options, "validate", "2024-01-02", "2024-01-02"])  # no golden events are stored
    (tmp_path / "golden.csv").write_text("subscriber_id,event_date,event_type\ns1,1/2/2024,NEW\n")
    main([*options, "golden", str(tmp_path / "golden.csv"), "--start", "2024-01-01", "--end", "2024-01-31"])
    main([*options, "validate", "2024-01-02", "2024-01-02", "--run-id", "again"])
    (tmp_path / "day.csv").write_text(",".join(RAW_SNAPSHOT.names) + "\n1/2/2024,i1,P,s1,1/1/2024,2/1/2024,9\n")
    main([*options, "load", str(tmp_path / "day.csv"), "--opco", "X", "--load-id", "second"])
    main([*options, "repair", "2024-01-02", "2024-01-02"])
    assert [r["mou_1d"] for r in wh.table(STATE).collect()] == [9.0]
    with pytest.raises(LoadFailed):
        main([*options, "backfill", "2024-01-05", "2024-01-05", "--mode", "step"])
    main([*options, "backfill", "2024-01-05", "2024-01-05", "--mode", "step", "--allow-cold-start"])
    wh.drop()
