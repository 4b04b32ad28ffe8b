"""Loads and their order: landing -> snapshot -> daily -> state -> KPIs -> checks."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from subtide.config import LifecycleConfig
from subtide.operators.checks import CHECK_NAMES, ChecksFailed, Tables, run_checks
from subtide.operators.daily import build_subscription_daily, in_range
from subtide.operators.kpi import build_kpi_daily, kpi_from_daily
from subtide.operators.state_bulk import bulk_cumulated, feed_calendar
from subtide.operators.state_step import step_cumulated
from subtide.operators.upsert import duplicate_keys, upsert_snapshots
from subtide.operators.views import kpi_daily_view
from subtide.plans.runlog import SKIPPED, logged
from subtide.schemas import RAW_SNAPSHOT, SUBSCRIPTION_DAILY, SUBSCRIPTION_SNAPSHOT
from subtide.sources.golden import golden_events, rejected_golden_events
from subtide.sources.landing import as_delivered, landing_view, missing_key, parse_raw
from subtide.sources.scratch import written
from subtide.sources.tables import BUCKET_KEY, Warehouse, day_before

SNAPSHOT, DAILY, STATE, KPI = (
    "subscription_snapshot_daily",
    "subscription_daily",
    "subscription_cumulated",
    "ott_kpi_daily",
)


def load_snapshots(
    warehouse: Warehouse, raw: DataFrame, opco: str, allow_rejects: bool = False, load_id: str | None = None
) -> int:
    """Upsert raw landing rows into the snapshot table; returns the rows in the touched dates.

    Rows that can't be upserted are stored as delivered in `landing_rejects` under the load's id, in place of
    those of an earlier load of that id: rows that can't be read, and rows without a key, which would
    be inserted again by every load. One that can't be read stops the load besides, unless the caller allows it.
    `replay_rejects` loads them again.
    """
    load_id = load_id or f"{opco}-{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid4().hex[:8]}"
    if not re.fullmatch(r"[\w.-]+", load_id):
        raise ValueError("a load's id has letters, digits, dots, dashes and underscores alone")
    quality = Observation()
    unread = F.col("reject_reason")
    parsed = parse_raw(raw, opco).withColumn("quarantined", F.coalesce(unread, missing_key()))
    bad = F.col("quarantined").isNotNull()
    parsed = parsed.observe(
        quality,
        F.count("reject_reason").alias("unread"),
        F.count("quarantined").alias("quarantined"),
        F.collect_set(F.when(~bad, F.col("snapshot_date"))).alias("dates"),  # one per calendar day in the files
    )
    # Only of rejected rows the delivered text is needed any more.
    kept = parsed.select(
        *SUBSCRIPTION_SNAPSHOT.names, "quarantined", *[F.when(bad, F.col(f"raw_{c}")).alias(f"raw_{c}") for c in RAW_SNAPSHOT.names]
    )
    # The text is read and parsed once; everything after it works on the written rows.
    with written(kept) as rows:
        rejects = as_delivered(
            rows.where(bad), F.lit(opco).alias("opco_code"), F.col("quarantined").alias("reject_reason"), F.lit(load_id).alias("load_id")
        )
        if quality.get["quarantined"] or warehouse.has_partition("landing_rejects", load_id):
            warehouse.replace_partition("landing_rejects", load_id, rejects)
        if quality.get["unread"] and not allow_rejects:
            example = rejects.where(~F.startswith("reject_reason", F.lit("no "))).first().asDict()
            raise ValueError(
                f"{quality.get['unread']} unreadable landing rows, like the {example['reject_reason']} of {example}"
            )
        source = rows.where(~bad).select(*SUBSCRIPTION_SNAPSHOT.names)
        twice = duplicate_keys(source).first()
        if twice is not None:
            raise ValueError(f"landing rows repeat a key: {twice.asDict()}")
        # Prunes the table to the touched dates.
        touched = warehouse.table(SNAPSHOT).where(F.col("snapshot_date").isin(quality.get["dates"]))
        merged = upsert_snapshots(touched, source)
        # Days differ in size: let the planner split big ones and join small ones.
        return warehouse.replace_touched(SNAPSHOT, merged.hint("rebalance", "snapshot_date"))


def replay_rejects(
    warehouse: Warehouse, load_id: str, mend: Callable[[DataFrame], DataFrame], allow_rejects: bool = False
) -> int:
    """Load the stored rejects of a load again after `mend`, which gets and returns raw rows; returns the rows in the
    touched dates. What still can't be loaded stays stored under the same id, the rest goes from there."""
    stored = warehouse.table("landing_rejects").where(F.col("load_id") == load_id)
    opcos = [r["opco_code"] for r in stored.select("opco_code").distinct().collect()]  # one: a load has one
    if not opcos:
        return 0
    # Written first, since the load replaces the rows that it reads.
    with written(mend(stored.select(*RAW_SNAPSHOT.names))) as mended:
        return load_snapshots(warehouse, mended, opcos[0], allow_rejects, load_id)


def rejects_by_load(warehouse: Warehouse) -> DataFrame:
    """How many rows of each load are stored as rejects, by reason."""
    by = ["load_id", "opco_code", "reject_reason"]
    return warehouse.table("landing_rejects").groupBy(*by).agg(F.count(F.lit(1)).alias("rejected_rows"))


def load_golden_events(
    warehouse: Warehouse, raw: DataFrame, start: date | None = None, end: date | None = None, allow_rejects: bool = False
) -> int:
    """Store the events that T12 expects, in place of those of the same dates; returns their number.

    With `start` and `end`, in place of all dates of that range, and events outside it are refused. A row
    that can't be read stops the load, unless the caller has dealt with `rejected_golden_events(raw)` and says so.
    """
    bad = rejected_golden_events(raw).first()
    if bad is not None and not allow_rejects:
        raise ValueError(f"unreadable golden events, like the {bad['reject_reason']} of {bad.asDict()}")
    events = golden_events(raw)
    if start is None:
        return warehouse.replace_touched("test_expected_events", events)
    end = end or start
    outside = events.where(~F.col("event_date").between(F.lit(start), F.lit(end))).first()
    if outside is not None:
        raise ValueError(f"a golden event outside {start}..{end}: {outside.asDict()}")
    return warehouse.replace_range("test_expected_events", events, start, end)


def load_subscription_daily(
    warehouse: Warehouse, start: date, end: date | None = None, cfg: LifecycleConfig = LifecycleConfig()
) -> int:
    end = end or start
    with logged(warehouse, "load_subscription_daily", end) as run:
        daily = build_subscription_daily(warehouse.table(SNAPSHOT), start, end, cfg)
        # One task per bucket, so that every day gets one file per bucket.
        run.rows = warehouse.replace_range(DAILY, daily.repartition(warehouse.buckets, BUCKET_KEY), start, end)
        if run.rows == 0:
            run.status, run.message = SKIPPED, "the snapshot table has nothing for this date"
        elif end > start:
            run.message = f"range {start}..{end}"
    return run.rows


def load_subscription_cumulated(
    warehouse: Warehouse,
    ds: date,
    cfg: LifecycleConfig = LifecycleConfig(),
    allow_cold_start: bool = False,
) -> int:
    """State of one day from the state of the day before.

    Starting over would make every subscription new. So when older state exists
    but the day before is missing, this raises unless a cold start is asked for.
    """
    with logged(warehouse, "load_subscription_cumulated", ds) as run:
        older = [d for d in warehouse.partitions(STATE) if d < ds]
        yesterday = warehouse.read(STATE, day_before(ds))
        # By rows: a date that was emptied still has its partition.
        if older and not allow_cold_start and yesterday.isEmpty():
            raise ValueError(f"no state for {day_before(ds)}, but there is a partition for {older[0]}")
        today = warehouse.read(DAILY, ds)
        has_snapshot = not today.isEmpty()
        feed = today.select("opco_code") if cfg.feed_key else has_snapshot
        run.rows = warehouse.replace_day(STATE, step_cumulated(yesterday, today, ds, feed, cfg), ds)
        if not has_snapshot:
            run.message = "feed missing: payers carried, everybody else aged by a day"
        elif cfg.feed_key:
            late = yesterday.select("opco_code").distinct().join(today.select("opco_code").distinct(), "opco_code", "left_anti")
            some = [r["opco_code"] for r in late.orderBy("opco_code").limit(20).collect()]
            run.message = f"feed missing for {', '.join(some)}: their payers carried" if some else None
    return run.rows


def load_subscription_cumulated_range(
    warehouse: Warehouse, start: date, end: date, cfg: LifecycleConfig = LifecycleConfig()
) -> int:
    """State of a whole range in one job, on from the stored state of the day before, like the daily step.

    Only where that day has no state, from the daily rows since the first one stored.
    """
    with logged(warehouse, "load_subscription_cumulated", end) as run:
        earlier = warehouse.read(STATE, day_before(start))
        if earlier.isEmpty():
            earlier, first = None, _history_start(warehouse, start)
        else:
            first = start
        states = bulk_cumulated(
            warehouse.read(DAILY, first, end), first, end, cfg, emit_from=start, distributed=True, earlier=earlier
        )
        run.rows = warehouse.replace_range(STATE, states, start, end)
        run.message = f"range {start}..{end}"
    return run.rows


def load_ott_kpi_daily(
    warehouse: Warehouse,
    start: date,
    end: date,
    cfg: LifecycleConfig = LifecycleConfig(),
    source: str = "state",
) -> int:
    """KPIs of a range from stored state or, for KPIs alone, from the stored daily rows."""
    with logged(warehouse, "load_ott_kpi_daily", end) as run:
        if source == "state":
            kpi = build_kpi_daily(warehouse.table(STATE), start, end)
        elif source == "daily":
            first = _history_start(warehouse, start)
            daily = warehouse.read(DAILY, first, end)
            kpi = in_range(kpi_from_daily(daily, first, end, cfg, distributed=True), start, end)
        else:
            raise ValueError(f"unknown source {source!r}")
        run.rows = warehouse.replace_range(KPI, kpi, start, end)
        run.message = f"range {start}..{end}"
    return run.rows


def _history_start(warehouse: Warehouse, start: date) -> date:
    """The first date with daily rows, from which state has to be worked out.

    If state is stored from before that date, its daily rows are gone, and every life would start
    over. So this raises.
    """
    listed = [d for d in warehouse.partitions(DAILY) if d < start]
    first = next((d for d in listed if not warehouse.read(DAILY, d).isEmpty()), start)
    older = [d for d in warehouse.partitions(STATE) if d < first]
    if older and not warehouse.read(STATE, older[0], older[-1]).isEmpty():
        raise ValueError(f"no state for {day_before(start)}; daily rows begin on {first}, but there is state from before")
    return first


def run_pipeline(
    warehouse: Warehouse,
    ds: date,
    cfg: LifecycleConfig = LifecycleConfig(),
    allow_cold_start: bool = False,
) -> None:
    """One day: daily rows, state, KPIs."""
    load_subscription_daily(warehouse, ds, cfg=cfg)
    load_subscription_cumulated(warehouse, ds, cfg, allow_cold_start)
    load_ott_kpi_daily(warehouse, ds, ds)


def backfill(
    warehouse: Warehouse,
    start: date,
    end: date,
    cfg: LifecycleConfig = LifecycleConfig(),
    mode: str = "bulk",
    allow_cold_start: bool = False,
    source: str = "state",
) -> None:
    """Every date of start..end, inclusive.

    "bulk" runs three jobs for the whole range, whatever its length. "step" runs the
    days one by one and stops at the first failure. Both go on from the stored state
    of the day before `start`; where there is none, "bulk" works it out from all
    stored daily rows. Later dates are not redone by either: after a
    correction, use `repair`. `allow_cold_start` lets the first step begin without the day before;
    `source` is where KPIs come from in bulk.
    """
    if start > end:
        return
    if mode == "bulk":
        load_subscription_daily(warehouse, start, end, cfg)
        load_subscription_cumulated_range(warehouse, start, end, cfg)
        load_ott_kpi_daily(warehouse, start, end, cfg, source)
    elif mode == "step":
        ds = start
        while ds <= end:
            run_pipeline(warehouse, ds, cfg, allow_cold_start and ds == start)
            ds += timedelta(days=1)
    else:
        raise ValueError(f"unknown mode {mode!r}")


def changed_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keys whose daily rows differ between two sets of them, compared by a hash of all other columns.

    Both are grouped by key first, so between rows distributed on the key nothing is shuffled.
    """
    on = ["subscription_key", "snapshot_date"]
    hashed = [
        rows.select(*on, F.xxhash64(*[c for c in SUBSCRIPTION_DAILY.names if c not in on]).alias("content"), F.lit(side).alias("side"))
        for side, rows in ((1, old), (-1, new))
    ]
    each = hashed[0].unionByName(hashed[1]).groupBy(*on).agg(F.sum("side").alias("sides"), F.min("content").alias("low"), F.max("content").alias("high"))
    return each.where("sides <> 0 OR low <> high").select("subscription_key").distinct()


def repair(warehouse: Warehouse, start: date, end: date, cfg: LifecycleConfig = LifecycleConfig()) -> int:
    """Redo corrected dates and all that follows from them; returns how many subscriptions changed.

    The daily rows of start..end are built again and compared with the stored ones. The state of the
    subscriptions that differ is built from the state of the day before `start` up to the latest
    stored date, and takes the place of their rows; the others' rows stay. Only if the feed calendar
    changed, all are built again, since a missing feed day says something about every payer. KPIs follow
    for the same dates. Equal to a backfill from `start` to the latest date.
    """
    if start > end:
        return 0
    latest = max([end, *warehouse.partitions(STATE)[-1:]])
    with written(build_subscription_daily(warehouse.table(SNAPSHOT), start, end, cfg)) as fresh:
        old = warehouse.read(DAILY, start, end)
        with written(changed_keys(old, fresh)) as changed:
            count = changed.count()
            if not count and start in warehouse.partitions(STATE):
                return 0
            calendars = [feed_calendar(rows, start, end, cfg) for rows in (old, fresh)]
            same_feed = calendars[0].exceptAll(calendars[1]).isEmpty() and calendars[1].exceptAll(calendars[0]).isEmpty()
            with logged(warehouse, "load_subscription_daily", end) as run:
                run.rows = warehouse.replace_range(DAILY, fresh.repartition(warehouse.buckets, BUCKET_KEY), start, end)
                run.message = f"repair of {start}..{end}: {count} subscriptions differ"
            if same_feed:
                _repair_state(warehouse, changed, start, latest, cfg)
            else:
                load_subscription_cumulated_range(warehouse, start, latest, cfg)
    load_ott_kpi_daily(warehouse, start, latest, cfg)
    return count


def rebuilt_states(warehouse: Warehouse, changed: DataFrame, start: date, end: date, cfg: LifecycleConfig = LifecycleConfig()) -> DataFrame:
    """State of the keys in `changed` for start..end, from their stored daily rows and their state of the day before."""
    earlier, first = warehouse.read(STATE, day_before(start)), start
    if earlier.isEmpty():
        earlier, first = None, _history_start(warehouse, start)
    daily = warehouse.read(DAILY, first, end)
    mine = lambda rows: rows.join(changed, BUCKET_KEY, "left_semi")
    return bulk_cumulated(
        mine(daily), first, end, cfg, feed_calendar(daily, first, end, cfg), emit_from=start, distributed=True,
        earlier=None if earlier is None else mine(earlier),
    )


def _repair_state(warehouse: Warehouse, changed: DataFrame, start: date, end: date, cfg: LifecycleConfig) -> None:
    with logged(warehouse, "load_subscription_cumulated", end) as run:
        kept = warehouse.read(STATE, start, end).join(changed, BUCKET_KEY, "left_anti")
        states = kept.unionByName(rebuilt_states(warehouse, changed, start, end, cfg))
        run.rows = warehouse.replace_range(STATE, states, start, end)
        run.message = f"repair of {start}..{end}"


def kpi_view(warehouse: Warehouse) -> DataFrame:
    return kpi_daily_view(warehouse.table(KPI))


def register_views(warehouse: Warehouse, raw: DataFrame | None = None, opco: str | None = None) -> None:
    """Make the views available to SQL: the reporting view, and the landing view if `raw` is given.

    The landing view has every delivered row; `reject_reason` says which column of one can't be read.
    """
    kpi_view(warehouse).createOrReplaceTempView("vw_ott_kpi_daily")
    if raw is not None:
        landing_view(raw, opco).createOrReplaceTempView("opco_raw_subscribers_vw")


def stored_tables(warehouse: Warehouse) -> Tables:
    return Tables(
        *[warehouse.table(name) for name in (SNAPSHOT, DAILY, STATE, "test_expected_events")]
    )


def validate(
    warehouse: Warehouse,
    start: date,
    end: date,
    cfg: LifecycleConfig = LifecycleConfig(),
    now: datetime | None = None,
    run_id: str = "default",
    tolerate_feed_gaps: bool = False,
) -> DataFrame:
    """Run the twelve checks, replace today's results of `run_id` with theirs, raise if one failed.

    Results of other runs of the day stay, and don't count. Today is the date of `now` (an instant; without a
    zone it is UTC) in the session's time zone, as in the table. Fewer or more than twelve stored rows are a
    failure too. `tolerate_feed_gaps` leaves days without feed out of T04.
    """
    if not run_id:
        raise ValueError("a run needs an id")
    now = now or datetime.now(timezone.utc)
    now = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
    today = warehouse.spark.range(1).select(F.to_date(F.lit(now))).first()[0]
    results = run_checks(stored_tables(warehouse), start, end, now, cfg, tolerate_feed_gaps)
    warehouse.replace_touched("test_results", results.withColumn("run_id", F.lit(run_id)).coalesce(1))
    mine = (F.col("run_id") == run_id) & (F.col("test_run_ts") == F.lit(now))
    stored = warehouse.read("test_results", today).where(mine).drop("run_date")
    if (rows := stored.count()) != len(CHECK_NAMES):
        raise ChecksFailed(f"{rows} results are stored instead of {len(CHECK_NAMES)}")
    failed = stored.where((F.col("status") == "FAIL") & (F.col("severity") == "ERROR")).count()
    if failed:
        raise ChecksFailed(f"{failed} checks failed; see {warehouse.database}.test_results")
    return stored
