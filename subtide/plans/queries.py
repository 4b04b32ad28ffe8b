"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack, suppress
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subtide.config import LifecycleConfig
from subtide.functions.columns import to_day
from subtide.operators.checks import (
    CHECK_NAMES,
    CHECKS,
    DETAIL_LIMIT,
    EXPECTED,
    SEVERITY,
    ChecksFailed,
    Tables,
    checked_state,
    marked_rows,
    missing_days,
    run_checks,
    state_days,
    with_variance,
)
from subtide.operators.daily import build_subscription_daily
from subtide.operators.events import EVENT_KEYS, events_from_daily, lifecycle_events
from subtide.operators.kpi import build_kpi_daily, kpi_from_daily
from subtide.operators.state_bulk import (
    CONTINUED,
    NEW,
    REACQUISITION,
    RENEWED,
    WINBACK,
    bulk_cumulated,
    paying_spans,
)
from subtide.operators.state_step import step_all_days, step_cumulated
from subtide.operators.upsert import SNAPSHOT_KEYS, upsert_snapshots
from subtide.operators.views import kpi_daily_view
from subtide.plans import oracles as sql
from subtide.plans.pipeline import (
    DAILY,
    SNAPSHOT,
    STATE,
    backfill,
    kpi_view,
    load_golden_events,
    load_snapshots,
    load_subscription_cumulated,
    load_subscription_daily,
    rejects_by_load,
    repair,
    replay_rejects,
    run_pipeline,
    validate,
)
from subtide.plans.runlog import LoadFailed
from subtide.plans.shapes import STATE_SCALARS, STATE_TOTALS, state_total
from subtide.schemas import HISTORY_COLUMNS, OTT_KPI_DAILY, RAW_SNAPSHOT, SUBSCRIPTION_CUMULATED, SUBSCRIPTION_DAILY
from subtide.sources import fixtures
from subtide.sources.golden import parse_golden_events
from subtide.sources.landing import normalize_raw, read_raw_snapshots, rejected_raw
from subtide.sources.scratch import delete_folder, scratch_folder, written
from subtide.sources.tables import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str):
    """Register the decorated query under its name, with SQL for the same result."""

    def register(function):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = oracle
        return function

    return register


@dataclass(frozen=True)
class Inputs:
    bronze: DataFrame
    daily: DataFrame
    feed: DataFrame
    start: date
    end: date
    cfg: LifecycleConfig

    def spans(self) -> DataFrame:
        return paying_spans(self.daily, self.start, self.end, self.cfg, self.feed)

    def states(self, **options) -> DataFrame:
        return bulk_cumulated(self.daily, self.start, self.end, self.cfg, self.feed, **options)

    def events(self) -> DataFrame:
        return events_from_daily(self.daily, self.start, self.end, self.cfg, self.feed)

    def kpi(self) -> DataFrame:
        return kpi_from_daily(self.daily, self.start, self.end, self.cfg, self.feed)

    def stored_kpi(self) -> DataFrame:
        return build_kpi_daily(self.states(with_arrays=False), self.start, self.end)


def orders_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    cfg = fixtures.ORDERS_CONFIG
    bronze = fixtures.order_snapshots(spark, sf_dir)
    feed = fixtures.order_feed_dates(spark, sf_dir)
    start, end = fixtures.window_of(feed)
    return Inputs(bronze, build_subscription_daily(bronze, start, end, cfg), feed, start, end, cfg)


def events_inputs(
    spark: SparkSession, sf_dir: str, gaps: bool | str = False, minutes: Column | None = None, cfg: LifecycleConfig = fixtures.EVENTS_CONFIG
) -> Inputs:
    bronze = fixtures.event_snapshots(spark, sf_dir, gaps, minutes)
    feed = fixtures.event_feed_dates(spark, sf_dir, gaps, cfg.feed_key)
    start, end = fixtures.window_of(feed)
    return Inputs(bronze, build_subscription_daily(bronze, start, end, cfg), feed, start, end, cfg)


def _lists_as_text(states: DataFrame) -> DataFrame:
    """History arrays as text; minutes are whole numbers in these inputs."""
    return states.withColumns(
        {a: F.array_join(F.col(a).cast("array<bigint>").cast("array<string>"), ",") for a in HISTORY_COLUMNS}
    )


_LISTS_SQL = ", ".join(
    f"array_to_string(CAST(CAST({a} AS BIGINT[]) AS VARCHAR[]), ',') AS {a}" for a in HISTORY_COLUMNS
)
_STATE_SQL = ", ".join(STATE_SCALARS)
_KPI_SQL = ", ".join(OTT_KPI_DAILY.names)

# --- landing and snapshot ---------------------------------------------------

_RAW_SQL = """
raw AS (
  SELECT *, CAST(event_id AS BIGINT) AS n, CAST(ts AS DATE) AS day,
    CASE WHEN event_id % 103 = 5 THEN 'snapshot_date' WHEN event_id % 109 = 2 THEN 'subscription_end_date'
         WHEN event_id % 101 = 3 THEN 'minutes_of_usage' END AS reject_reason
  FROM events)"""
_NORMALIZED_SQL = f"""WITH {_RAW_SQL}
SELECT 'OPX' AS opco_code, CAST(user_id AS VARCHAR) AS subscriber_id,
  event_type || ', ' || props AS subscription_name, CAST(n // 1000 AS VARCHAR) AS subscription_id,
  day AS subscription_start_date, CASE WHEN n % 5 <> 0 THEN day END AS subscription_end_date,
  CAST(CASE WHEN n % 50 = 7 THEN 0
       ELSE round(CAST((n % 300) || '.' || lpad(CAST(n % 1000 AS VARCHAR), 3, '0') AS DECIMAL(38, 9)), 2) END AS DOUBLE)
    AS minutes_of_usage,
  day AS snapshot_date
FROM raw WHERE reject_reason IS NULL"""


@query(_NORMALIZED_SQL)
def normalize_landing(spark, sf_dir):
    return normalize_raw(fixtures.event_landing(spark, sf_dir), "OPX")


@query(_NORMALIZED_SQL)
def landing_csv_scan(spark, sf_dir):
    folder = scratch_folder(spark)
    raw = fixtures.event_landing(spark, sf_dir)
    raw.write.csv(f"{folder}/landing", header=True, quote='"', escape='"')
    return _kept(normalize_raw(read_raw_snapshots(spark, f"{folder}/landing/*.csv"), "OPX"), folder)


@query(f"""WITH {_RAW_SQL}
SELECT reject_reason, CAST(user_id AS VARCHAR) AS subscriber_id, CAST(n // 1000 AS VARCHAR) AS subscription_id,
  CASE WHEN n % 103 = 5 THEN 'unknown' WHEN n % 107 = 1 THEN CAST(day AS VARCHAR)
       ELSE month(day) || '/' || day(day) || '/' || year(day) END AS snapshot_date
FROM raw WHERE reject_reason IS NOT NULL""")
def rejected_landing(spark, sf_dir):
    bad = rejected_raw(fixtures.event_landing(spark, sf_dir))
    return bad.select("reject_reason", "subscriber_id", "subscription_id", "snapshot_date")


# Lines with a value too few or too many, each file with its header.
_LINE_SQL = """concat_ws(',', month(day) || '/' || day(day) || '/' || year(day), n, event_type, user_id, '2024-01-01', '', 5)"""
_JAGGED_SQL = f"""
jagged AS (
  SELECT n, user_id, CASE WHEN n % 11 = 3 THEN regexp_replace(line, ',[^,]*$', '') WHEN n % 13 = 4 THEN line || ',more' ELSE line END AS line
  FROM (SELECT CAST(event_id AS BIGINT) AS n, user_id, {_LINE_SQL} AS line
        FROM (SELECT *, CAST(event_id AS BIGINT) AS n, CAST(ts AS DATE) AS day FROM events)))"""


@query(f"""WITH {_JAGGED_SQL}
SELECT 'columns' AS reject_reason, line AS snapshot_date FROM jagged WHERE n % 11 = 3 OR n % 13 = 4""")
def landing_jagged_rejects(spark, sf_dir):
    """Lines with too few or too many values come back whole."""
    n, day = F.col("event_id").cast("long"), F.to_date("ts")
    slashed = F.concat_ws("/", F.month(day), F.day(day), F.year(day))
    line = F.concat_ws(",", slashed, n, "event_type", "user_id", F.lit("2024-01-01"), F.lit(""), F.lit(5))
    line = F.when(n % 11 == 3, F.regexp_replace(line, ",[^,]*$", "")).when(n % 13 == 4, F.concat(line, F.lit(",more"))).otherwise(line)
    files = 4
    lines = fixtures.read_table(spark, sf_dir, "events").select((n % files).alias("file"), n.alias("place"), line.alias("value"))
    headers = spark.range(files).select(F.col("id").alias("file"), F.lit(-1).cast("long").alias("place"), F.lit(",".join(RAW_SNAPSHOT.names)).alias("value"))
    folder = scratch_folder(spark)
    whole = lines.unionByName(headers).repartition(files, "file").sortWithinPartitions("file", "place")
    whole.drop("place").write.partitionBy("file").text(folder)
    bad = rejected_raw(read_raw_snapshots(spark, f"{folder}/file=*"))
    return _kept(bad.select("reject_reason", "snapshot_date"), folder)


_EARLY_END, _LATE_START = date(1999, 1, 1), date(1997, 1, 1)


@query(
    sql.orders(
        f"""SELECT opco_code, subscriber_id, subscription_name, subscription_id, subscription_start_date,
  subscription_end_date, minutes_of_usage + CAST(snapshot_date >= DATE '{_LATE_START}' AS INT) AS minutes_of_usage,
  snapshot_date
FROM one""",
        """
one AS (
  SELECT opco_code, subscriber_id, max(subscription_name) AS subscription_name, subscription_id,
    min(subscription_start_date) AS subscription_start_date, max(subscription_end_date) AS subscription_end_date,
    sum(minutes_of_usage) AS minutes_of_usage, snapshot_date
  FROM bronze GROUP BY opco_code, subscriber_id, subscription_id, snapshot_date)""",
        state=False,
    )
)
def upsert_snapshot_halves(spark, sf_dir):
    """The later part of the snapshots, corrected, on top of an overlapping earlier part."""
    one = (
        fixtures.order_snapshots(spark, sf_dir)
        .groupBy(*SNAPSHOT_KEYS)
        .agg(
            F.max("subscription_name").alias("subscription_name"),
            F.min("subscription_start_date").alias("subscription_start_date"),
            F.max("subscription_end_date").alias("subscription_end_date"),
            F.sum("minutes_of_usage").alias("minutes_of_usage"),
        )
    )
    early = one.where(F.col("snapshot_date") <= F.lit(_EARLY_END))
    late = one.where(F.col("snapshot_date") >= F.lit(_LATE_START))
    return upsert_snapshots(early, late.withColumn("minutes_of_usage", F.col("minutes_of_usage") + 1))


# --- daily grain ------------------------------------------------------------

_DAILY_SQL = f"SELECT {', '.join(SUBSCRIPTION_DAILY.names)} FROM daily"


@query(sql.orders(_DAILY_SQL, state=False))
def subscription_daily(spark, sf_dir):
    return orders_inputs(spark, sf_dir).daily


@query(sql.events(_DAILY_SQL, state=False))
def subscription_daily_events(spark, sf_dir):
    return events_inputs(spark, sf_dir).daily


# --- lifecycle --------------------------------------------------------------

_ARRIVALS = {
    NEW: "NEW", CONTINUED: "CONTINUED", RENEWED: "RENEWAL", WINBACK: "WINBACK", REACQUISITION: "REACQUISITION",
}


def _gaps(inputs: Inputs) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in _ARRIVALS.items() for x in pair])
    return inputs.spans().select(
        "subscription_key",
        to_day(F.col("day")).alias("paying_date"),
        to_day(F.col("covered_to")).alias("covered_to"),
        names[F.col("arrival")].alias("arrival"),
    )


# On its paying days, how a key arrives can be read off the state flags.
_GAPS_SQL = """
SELECT subscription_key, snapshot_date AS paying_date, covered_to,
  CASE WHEN is_new_subscription = 1 THEN 'NEW' WHEN is_winback_event = 1 THEN 'WINBACK'
       WHEN is_reacquisition_event = 1 THEN 'REACQUISITION' WHEN is_renewal_event = 1 THEN 'RENEWAL'
       ELSE 'CONTINUED' END AS arrival
FROM state JOIN daily USING (subscription_key, snapshot_date) JOIN covers USING (snapshot_date)"""


def _covers_sql(end: str) -> str:
    return f"""
covers AS (SELECT snapshot_date, coalesce(lead(snapshot_date) OVER (ORDER BY snapshot_date), {end} + 1) - 1
             AS covered_to FROM (SELECT DISTINCT snapshot_date FROM daily))"""


@query(sql.orders(_GAPS_SQL, _covers_sql(sql.ORDERS_END)))
def paying_gaps(spark, sf_dir):
    return _gaps(orders_inputs(spark, sf_dir))


@query(sql.events(_GAPS_SQL, _covers_sql(sql.EVENTS_END), gaps=True))
def paying_gaps_with_feed_gaps(spark, sf_dir):
    return _gaps(events_inputs(spark, sf_dir, gaps=True))


@query(sql.orders("SELECT * FROM happened", sql.EVENT_ROWS))
def lifecycle_event_rows(spark, sf_dir):
    return orders_inputs(spark, sf_dir).events()


@query(sql.events("SELECT * FROM happened", sql.EVENT_ROWS))
def lifecycle_event_rows_from_state(spark, sf_dir):
    inputs = events_inputs(spark, sf_dir)
    return lifecycle_events(inputs.states(with_arrays=False), inputs.start, inputs.end)


_COUNTS_SQL = "SELECT opco_code, event_type, count(*) AS events FROM happened GROUP BY ALL"


@query(sql.orders(_COUNTS_SQL, sql.EVENT_ROWS))
def event_counts_by_type(spark, sf_dir):
    events = orders_inputs(spark, sf_dir).events()
    return events.groupBy("opco_code", "event_type").agg(F.count(F.lit(1)).alias("events"))


@query(sql.orders(f"SELECT {_STATE_SQL} FROM state WHERE snapshot_date = {sql.ORDERS_END}"))
def state_asof(spark, sf_dir):
    inputs = orders_inputs(spark, sf_dir)
    return inputs.states(emit_from=inputs.end, with_arrays=False)


_ORDERS_LISTS_SQL = f"""
SELECT subscription_key, snapshot_date, {_LISTS_SQL} FROM (
  SELECT subscription_key, snapshot_date, list_reverse(list(paying) OVER h) AS activity_array,
    list_reverse(list(viewer) OVER h) AS viewer_array, list_reverse(list(minutes) OVER h) AS mou_array
  FROM (SELECT *, max(first_active_date) OVER (PARTITION BY subscription_key) AS last_life FROM state)
  WHERE first_active_date = last_life AND snapshot_date > {sql.ORDERS_END} - 90
  WINDOW h AS (PARTITION BY subscription_key ORDER BY snapshot_date ROWS 89 PRECEDING))
WHERE snapshot_date = {sql.ORDERS_END}"""


@query(sql.orders(_ORDERS_LISTS_SQL))
def state_arrays_asof(spark, sf_dir):
    inputs = orders_inputs(spark, sf_dir)
    states = inputs.states(emit_from=inputs.end)
    return _lists_as_text(states).select("subscription_key", "snapshot_date", *HISTORY_COLUMNS)


_totals_sql = ", ".join(
    f"CAST(sum({state_total(c)}) AS {'DOUBLE' if c.startswith('mou') else 'BIGINT'}) AS {c}" for c in STATE_TOTALS
)


@query(
    sql.orders(
        f"SELECT opco_code, snapshot_date, count(*) AS state_rows, {_totals_sql} FROM state GROUP BY ALL"
    )
)
def state_totals_per_day(spark, sf_dir):
    """Every state row of every day, each column added up per opco and day."""
    states = orders_inputs(spark, sf_dir).states(with_arrays=False)
    stand_ins = {"subscription_id": F.col("subscription_id").cast("long")}
    for c in STATE_TOTALS:
        if c.endswith("_date"):
            stand_ins[c] = F.date_diff(c, F.lit(date(1990, 1, 1))).cast("long")
    return _added_up(states, ["opco_code", "snapshot_date"], {c: stand_ins.get(c, F.col(c)) for c in STATE_TOTALS})


def _added_up(states: DataFrame, by: list[str], columns: dict[str, Column]) -> DataFrame:
    """Rows and sums of many columns per group; minutes are double, all else long.

    They reach the aggregate as two arrays: with a parameter for each column, the generated method that builds state
    rows gets more than the JVM's optimizing compiler can pass on, and it leaves the method to the quick one.
    """
    minutes = [name for name in columns if name.startswith("mou")]
    lists = {"numbers": [name for name in columns if name not in minutes], "minutes": minutes}
    rows = states.select(*by, *[F.array(*[columns[n] for n in names]).alias(kind) for kind, names in lists.items()])
    place = {name: F.col(kind)[i] for kind, names in lists.items() for i, name in enumerate(names)}
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("state_rows"), *[F.sum(place[n]).alias(n) for n in columns])


_ALL_SQL = f"SELECT {_STATE_SQL}, {_LISTS_SQL} FROM state"


@query(sql.events(_ALL_SQL))
def state_bulk_rows(spark, sf_dir):
    return _lists_as_text(events_inputs(spark, sf_dir).states())


@query(sql.events(f"SELECT subscription_key, snapshot_date, {_LISTS_SQL} FROM state"))
def state_arrays(spark, sf_dir):
    states = _lists_as_text(events_inputs(spark, sf_dir).states())
    return states.select("subscription_key", "snapshot_date", *HISTORY_COLUMNS)


_MOU = [f"mou_{w}" for w in ("1d", "7d", "30d", "90d")]


@query(sql.events(f"SELECT subscription_key, snapshot_date, {', '.join(f'round({m}, 2) AS {m}' for m in _MOU)} FROM state",
                  minutes="round(value, 2)"))
def state_bulk_fractional(spark, sf_dir):
    """Trailing minutes where they are no whole numbers."""
    states = events_inputs(spark, sf_dir, minutes=F.round("value", 2)).states(with_arrays=False)
    return states.select("subscription_key", "snapshot_date", *[F.round(m, 2).alias(m) for m in _MOU])


_PREFIX = [c for c in STATE_SCALARS if c.startswith(("is_viewer_", "active_days_", "mou_"))]


@query(sql.orders(f"SELECT snapshot_date, {', '.join(f'CAST(sum({c}) AS DOUBLE) AS {c}' for c in _PREFIX)} "
                  "FROM state GROUP BY snapshot_date"))  # fmt: skip
def state_prefix_sums(spark, sf_dir):
    states = orders_inputs(spark, sf_dir).states(with_arrays=False)
    return states.groupBy("snapshot_date").agg(*[F.sum(c).cast("double").alias(c) for c in _PREFIX])


@query(sql.events(f"{_ALL_SQL} WHERE snapshot_date = {sql.EVENTS_END}"))
def state_step(spark, sf_dir):
    """One daily step on top of the state of the day before."""
    inputs = events_inputs(spark, sf_dir)
    ds = inputs.end
    before = replace(inputs, end=ds - timedelta(days=1))
    today = build_subscription_daily(inputs.bronze, ds, ds, inputs.cfg)
    yesterday = before.states(emit_from=before.end)
    return _lists_as_text(step_cumulated(yesterday, today, ds, True, inputs.cfg))


@query(sql.events(_ALL_SQL, gaps=True))
def state_step_on_every_day(spark, sf_dir):
    inputs = events_inputs(spark, sf_dir, gaps=True)
    stepped = step_all_days(inputs.states(), inputs.daily, inputs.feed, inputs.end, inputs.cfg)
    return _lists_as_text(stepped)


@query(sql.orders(f"SELECT {_STATE_SQL} FROM state WHERE snapshot_date = {sql.ORDERS_END}"))
def state_step_orders(spark, sf_dir):
    inputs = orders_inputs(spark, sf_dir)
    ds = inputs.end
    before = replace(inputs, end=ds - timedelta(days=1))
    today = build_subscription_daily(inputs.bronze, ds, ds, inputs.cfg)
    yesterday = before.states(emit_from=before.end)
    return step_cumulated(yesterday, today, ds, True, inputs.cfg).drop(*HISTORY_COLUMNS)


@query(sql.events("SELECT opco_code, count(*) AS state_rows, CAST(0 AS BIGINT) AS differences FROM state GROUP BY ALL", gaps=True))
def state_step_equals_bulk(spark, sf_dir):
    """State rows of the bulk build on which the daily step disagrees, out of all; minutes in hundredths."""
    inputs = events_inputs(spark, sf_dir, gaps=True, minutes=F.round("value", 2))
    bulk = inputs.states()
    stepped = step_all_days(bulk, inputs.daily, inputs.feed, inputs.end, inputs.cfg)
    on = ["subscription_key", "snapshot_date"]
    rest = [c for c in SUBSCRIPTION_CUMULATED.names if c not in on]
    left = bulk.select(*on, "opco_code", F.xxhash64(*rest).alias("bulk"))
    right = stepped.select(*on, F.col("opco_code").alias("step_opco"), F.xxhash64(*rest).alias("step"))
    return (
        left.join(right, on, "full_outer")
        .groupBy(F.coalesce("opco_code", "step_opco").alias("opco_code"))
        .agg(
            F.count("bulk").alias("state_rows"),
            F.count_if(~F.col("bulk").eqNullSafe(F.col("step"))).alias("differences"),
        )
    )


# One opco's feed is late, the other's is not.
_LATE = "OP1"
_OWN_FEED = replace(fixtures.EVENTS_CONFIG, feed_scope="opco")


@query(sql.events(_ALL_SQL, gaps=_LATE, cfg=_OWN_FEED))
def state_feed_scope_opco(spark, sf_dir):
    """Each opco has a feed calendar of its own: only the late one's payers are carried."""
    return _lists_as_text(events_inputs(spark, sf_dir, gaps=_LATE, cfg=_OWN_FEED).states())


@query(sql.events(_ALL_SQL, gaps=_LATE, cfg=_OWN_FEED))
def state_step_feed_scope_opco(spark, sf_dir):
    inputs = events_inputs(spark, sf_dir, gaps=_LATE, cfg=_OWN_FEED)
    return _lists_as_text(step_all_days(inputs.states(), inputs.daily, inputs.feed, inputs.end, inputs.cfg))


@query(sql.events(f"SELECT {_KPI_SQL} FROM kpi", sql.KPI, gaps=_LATE, cfg=_OWN_FEED))
def kpi_feed_scope_opco(spark, sf_dir):
    return events_inputs(spark, sf_dir, gaps=_LATE, cfg=_OWN_FEED).kpi()


@query(sql.events(f"SELECT {_STATE_SQL} FROM state WHERE snapshot_date IN "
                  f"({', '.join(f'DATE {str(d)!r}' for d in fixtures.EVENTS_MISSING)})", gaps=True))  # fmt: skip
def feed_gap_carry(spark, sf_dir):
    """What the state says on the days without any feed."""
    states = events_inputs(spark, sf_dir, gaps=True).states(with_arrays=False)
    return states.where(F.col("snapshot_date").isin(fixtures.EVENTS_MISSING))


@query(
    sql.orders(
        """SELECT subscription_key, event_date AS restarted_on,
  event_date - lag(event_date) OVER (PARTITION BY subscription_key ORDER BY event_date) AS days_since_first_life
FROM happened WHERE event_type = 'NEW'
QUALIFY row_number() OVER (PARTITION BY subscription_key ORDER BY event_date) > 1""",
        sql.EVENT_ROWS,
    )
)
def retention_drop_restart(spark, sf_dir):
    """Keys that came back after the retention drop and count as new again."""
    by_key = Window.partitionBy("subscription_key").orderBy("event_date")
    starts = orders_inputs(spark, sf_dir).events().where(F.col("event_type") == "NEW")
    return starts.select(
        "subscription_key",
        F.col("event_date").alias("restarted_on"),
        F.date_diff("event_date", F.lag("event_date").over(by_key)).cast("long").alias("days_since_first_life"),
    ).where(F.col("days_since_first_life").isNotNull())


# --- KPIs and reporting -----------------------------------------------------


@query(sql.orders(f"SELECT {_KPI_SQL} FROM kpi", sql.KPI))
def kpi_daily(spark, sf_dir):
    return orders_inputs(spark, sf_dir).kpi()


@query(sql.orders(f"SELECT {_KPI_SQL} FROM kpi", sql.KPI))
def kpi_daily_from_state(spark, sf_dir):
    return orders_inputs(spark, sf_dir).stored_kpi()


@query(sql.events(f"SELECT {_KPI_SQL} FROM kpi", sql.KPI))
def kpi_daily_events(spark, sf_dir):
    return events_inputs(spark, sf_dir).stored_kpi()


_PEOPLE = [
    "unique_additions", "subscriber_churn", "active_subscribers",
    "unique_viewers_1d", "unique_viewers_7d", "unique_viewers_30d",
]


@query(sql.events(f"SELECT opco_code, snapshot_date, {', '.join(_PEOPLE)} FROM kpi", sql.KPI))
def kpi_subscriber_level(spark, sf_dir):
    return events_inputs(spark, sf_dir).kpi().select("opco_code", "snapshot_date", *_PEOPLE)


@query(sql.orders("SELECT * FROM gold", sql.KPI, sql.VIEW))
def kpi_reporting_view(spark, sf_dir):
    return kpi_daily_view(orders_inputs(spark, sf_dir).kpi())


_BALANCES = [
    "opco_code", "snapshot_date", "opening_subscriptions", "additions", "subscription_churn",
    "closing_subscriptions", "unique_opening_subscribers", "unique_closing_subscribers",
]


@query(sql.events(f"SELECT {', '.join(_BALANCES)} FROM gold", sql.KPI, sql.VIEW))
def kpi_opening_closing(spark, sf_dir):
    return kpi_daily_view(events_inputs(spark, sf_dir).kpi()).select(*_BALANCES)


@query(
    sql.orders(
        """SELECT opco_code, count(*) AS days, CAST(count(roll_forward_variance) AS BIGINT) AS checked_days,
  CAST(count(*) FILTER (roll_forward_variance <> 0) AS BIGINT) AS days_off FROM gold GROUP BY ALL""",
        sql.KPI,
        sql.VIEW,
    )
)
def kpi_roll_forward(spark, sf_dir):
    view = kpi_daily_view(orders_inputs(spark, sf_dir).kpi())
    return view.groupBy("opco_code").agg(
        F.count(F.lit(1)).alias("days"),
        F.count("roll_forward_variance").alias("checked_days"),
        F.count_if(F.col("roll_forward_variance") != 0).alias("days_off"),
    )


_BUCKETS = ["opco_code", "week_start", "month_start", "quarter_start"]


@query(
    sql.orders(
        f"""SELECT {', '.join(_BUCKETS)}, count(*) AS days, CAST(sum(additions) AS BIGINT) AS additions
FROM gold GROUP BY ALL""",
        sql.KPI,
        sql.VIEW,
    )
)
def calendar_buckets(spark, sf_dir):
    view = kpi_daily_view(orders_inputs(spark, sf_dir).kpi())
    return view.groupBy(*_BUCKETS).agg(F.count(F.lit(1)).alias("days"), F.sum("additions").alias("additions"))


# --- checks, each on tables that break its rule -----------------------------


def _healthy(inputs: Inputs) -> Tables:
    states = inputs.states()
    return Tables(inputs.bronze, inputs.daily, states, _golden(states, inputs))


def _golden(states: DataFrame, inputs: Inputs) -> DataFrame:
    return lifecycle_events(states, inputs.start, inputs.end).select(*EVENT_KEYS)


def _check(test_id: str, spark: SparkSession, sf_dir: str, gaps: bool = False, **broken) -> DataFrame:
    """A check on the event tables after `broken` has changed some of them."""
    inputs = events_inputs(spark, sf_dir, gaps)
    tables = _healthy(inputs)
    tables = replace(tables, **{name: change(getattr(tables, name)) for name, change in broken.items()})
    return CHECKS[test_id](tables, inputs.start, inputs.end, inputs.cfg)


def _count_sql(rows: str, condition: str = "true", what: str = "*", gaps: bool = False) -> str:
    select = f"SELECT CAST(count({what}) AS BIGINT) AS bad, CAST(NULL AS VARCHAR) AS detail FROM {rows} WHERE {condition}"
    return sql.events(select, sql.EVENT_ROWS, gaps=gaps)


_FIRST, _LAST = sql.EVENTS_START, sql.EVENTS_END


@query(_count_sql("daily", "is_viewer_today = 1"))
def check_t01(spark, sf_dir):
    repeat = lambda df: df.unionByName(df.where("is_viewer_today = 1"))
    return _check("T01", spark, sf_dir, daily=repeat)


@query(_count_sql("state", "is_churn_event = 1"))
def check_t02(spark, sf_dir):
    repeat = lambda df: df.unionByName(df.where("is_churn_event = 1"))
    return _check("T02", spark, sf_dir, cumulated=repeat)


@query(_count_sql("daily", "subscription_name = 'click' AND opco_code = 'OP1'", "DISTINCT snapshot_date"))
def check_t03(spark, sf_dir):
    lose = lambda df: df.where("NOT (subscription_name = 'click' AND opco_code = 'OP1')")
    return _check("T03", spark, sf_dir, daily=lose)


# On a day without feed nobody has a daily row, but payers are carried.
@query(_count_sql("state", "is_paying = 1 AND snapshot_date NOT IN (SELECT snapshot_date FROM daily)",
                  "DISTINCT snapshot_date", gaps=True))
def check_t04(spark, sf_dir):
    return _check("T04", spark, sf_dir, gaps=True)


@query(_count_sql("state", "is_renewal_event = 1"))
def check_t05(spark, sf_dir):
    longer = F.when(F.col("is_renewal_event") == 1, F.array_append("mou_array", F.lit(0.0))).otherwise(F.col("mou_array"))
    return _check("T05", spark, sf_dir, cumulated=lambda df: df.withColumn("mou_array", longer))


@query(_count_sql("state", "is_winback_event = 1"))
def check_t06(spark, sf_dir):
    both = F.greatest("is_in_grace", "is_winback_event")
    return _check("T06", spark, sf_dir, cumulated=lambda df: df.withColumn("is_in_grace", both))


@query(_count_sql("state", "is_addition = 1"))
def check_t07(spark, sf_dir):
    off = F.col("mou_1d") + F.col("is_addition")
    return _check("T07", spark, sf_dir, cumulated=lambda df: df.withColumn("mou_1d", off))


@query(_count_sql("state", f"is_churned = 1 AND snapshot_date = {_LAST}"))
def check_t08(spark, sf_dir):
    off = F.col("mou_30d") + F.col("is_churned")
    return _check("T08", spark, sf_dir, cumulated=lambda df: df.withColumn("mou_30d", off))


@query(_count_sql("state", f"is_churn_event = 1 AND snapshot_date > {_FIRST}", "DISTINCT snapshot_date"))
def check_t09(spark, sf_dir):
    silent = lambda df: df.withColumn("is_churn_event", F.lit(0).cast("long"))
    return _check("T09", spark, sf_dir, cumulated=silent)


@query(_count_sql("state", "dayofweek(snapshot_date) = 0", "DISTINCT snapshot_date"))
def check_t10(spark, sf_dir):
    no_sundays = lambda df: df.where(F.dayofweek("snapshot_date") != 1)
    return _check("T10", spark, sf_dir, cumulated=no_sundays)


@query(_count_sql("state", "is_churned = 1 AND is_in_winback_window = 0"))
def check_t11(spark, sf_dir):
    undated = F.when(F.col("is_in_winback_window") == 1, F.col("churn_date"))
    return _check("T11", spark, sf_dir, cumulated=lambda df: df.withColumn("churn_date", undated))


_T12_SQL = sql.events(
    """SELECT (SELECT CAST(count(*) AS BIGINT) FROM differences) AS bad, string_agg(line, ',' ORDER BY line) AS detail
FROM (SELECT line FROM differences ORDER BY line LIMIT 50)""",
    sql.EVENT_ROWS,
    """
differences AS (
  SELECT subscriber_id || '|' || event_date || '|REACQUISITION|UNEXPECTED' AS line
  FROM happened WHERE event_type = 'REACQUISITION'
  UNION ALL SELECT DISTINCT opco_code || '|' || DATE '2024-01-15' || '|NEW|MISSING' FROM bronze)""",
)


@query(_T12_SQL)
def check_t12(spark, sf_dir):
    """Golden events without the reacquisitions, plus one that never happened per opco."""
    inputs = events_inputs(spark, sf_dir)
    invented = inputs.bronze.select(
        F.col("opco_code").alias("subscriber_id"),
        F.lit(date(2024, 1, 15)).alias("event_date"),
        F.lit("NEW").alias("event_type"),
    ).distinct()
    change = lambda df: df.where("event_type <> 'REACQUISITION'").unionByName(invented)
    return _check("T12", spark, sf_dir, expected_events=change)


def _suite_sql(bad: dict[str, str], detail: str = "NULL", run_id: str = "") -> str:
    """The result rows for what each check counts."""
    rows = ", ".join(f"('{t}', '{name}', {bad[t]})" for t, name in CHECK_NAMES.items())
    run = f"'{run_id}' AS run_id, " if run_id else ""
    return f"""SELECT {run}test_id, test_name, '{SEVERITY}' AS severity,
  CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(bad AS BIGINT) AS failed_rows,
  '{EXPECTED}' AS expected, CAST(bad AS VARCHAR) AS actual, CASE WHEN test_id = 'T12' THEN CAST({detail} AS VARCHAR) END AS detail
FROM (VALUES {rows}) results(test_id, test_name, bad)"""


_LINES = f"(SELECT string_agg(line, ',' ORDER BY line) FROM (SELECT line FROM differences ORDER BY line LIMIT {DETAIL_LIMIT}))"


def _suite_of(inputs: Inputs, tables: Tables | None = None) -> DataFrame:
    """The stored result rows but for the time of the run."""
    with ExitStack() as held:
        # Several checks read the daily rows, the golden events and the state rows that pay, have an event or are
        # the last: these are stored. Storing all state rows takes longer than building them again for the counts.
        hold = lambda df: held.enter_context(written(df))
        if tables is None:
            inputs = replace(inputs, daily=hold(inputs.daily))
            states = checked_state(inputs.states())
            marked = hold(marked_rows(states, inputs.start, inputs.end))
            tables = Tables(inputs.bronze, inputs.daily, states, hold(_golden(marked, inputs)), marked)
        else:
            states = checked_state(tables.cumulated)
            marked = hold(marked_rows(states, inputs.start, inputs.end))
            tables = replace(tables, cumulated=states, expected_events=hold(tables.expected_events), marked=marked)
        results = run_checks(tables, inputs.start, inputs.end, datetime(2024, 2, 1), inputs.cfg)
        return _small(results.drop("test_run_ts"))


def _small(df: DataFrame) -> DataFrame:
    """A result of a few rows, worked out now, for when what it reads is about to go."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


_events_counts = sql.counts(sql.EVENTS_START, sql.EVENTS_END, fixtures.EVENTS_CONFIG)
_orders_counts = sql.counts(sql.ORDERS_START, sql.ORDERS_END, fixtures.ORDERS_CONFIG, arrays=False)
_SAME_EVENTS = sql.differences("happened", "happened")


@query(sql.events(_suite_sql(_events_counts, _LINES), sql.EVENT_ROWS, _SAME_EVENTS))
def check_suite_events(spark, sf_dir):
    return _suite_of(events_inputs(spark, sf_dir))


@query(sql.events(_suite_sql(_events_counts, _LINES), sql.EVENT_ROWS, _SAME_EVENTS, gaps=True))
def check_suite_with_feed_gaps(spark, sf_dir):
    """On a day without feed the fourth check compares carried payers with no daily rows."""
    return _suite_of(events_inputs(spark, sf_dir, gaps=True))


@query(sql.orders(_suite_sql(_orders_counts, _LINES), sql.EVENT_ROWS, _SAME_EVENTS))
def check_suite_orders(spark, sf_dir):
    return _suite_of(orders_inputs(spark, sf_dir))


_PLANTED = [
    "bad_daily AS (SELECT * FROM daily UNION ALL SELECT * FROM daily WHERE is_viewer_today = 1 AND subscription_name = 'click')",
    f"""
bad_state AS (
  SELECT * REPLACE (greatest(is_in_grace, is_winback_event) AS is_in_grace, mou_1d + is_reacquisition_event AS mou_1d,
    CASE WHEN is_in_winback_window = 1 THEN churn_date END AS churn_date,
    CASE WHEN is_renewal_event = 1 THEN list_append(mou_array, 0.0) ELSE mou_array END AS mou_array,
    mou_30d + is_churned AS mou_30d)
  FROM (SELECT * FROM state UNION ALL SELECT * FROM state WHERE is_churn_event = 1 AND opco_code = 'OP1')
  WHERE snapshot_date <> {_FIRST} + 8)""",
    "golden AS (SELECT * FROM happened WHERE event_type <> 'REACQUISITION')",
]
_planted_counts = sql.counts(sql.EVENTS_START, sql.EVENTS_END, fixtures.EVENTS_CONFIG, "bad_daily", "bad_state")


@query(sql.events(_suite_sql(_planted_counts, _LINES), sql.EVENT_ROWS, *_PLANTED,
                  sql.events_of("bad_state", "bad_events"), sql.differences("golden", "bad_events")))
def check_suite_planted(spark, sf_dir):
    """The suite over tables in which every rule is broken."""
    inputs = events_inputs(spark, sf_dir)
    tables = _healthy(inputs)
    repeated = "is_viewer_today = 1 AND subscription_name = 'click'"
    states = tables.cumulated.unionByName(tables.cumulated.where("is_churn_event = 1 AND opco_code = 'OP1'"))
    states = states.where(F.col("snapshot_date") != F.lit(inputs.start + timedelta(days=8))).withColumns(
        {
            "is_in_grace": F.greatest("is_in_grace", "is_winback_event"),
            "mou_1d": F.col("mou_1d") + F.col("is_reacquisition_event"),
            "churn_date": F.when(F.col("is_in_winback_window") == 1, F.col("churn_date")),
            "mou_array": F.when(F.col("is_renewal_event") == 1, F.array_append("mou_array", F.lit(0.0))).otherwise(F.col("mou_array")),
            "mou_30d": F.col("mou_30d") + F.col("is_churned"),
        }
    )
    golden = tables.expected_events.where("event_type <> 'REACQUISITION'")
    return _suite_of(inputs, Tables(tables.bronze, tables.daily.unionByName(tables.daily.where(repeated)), states, golden))


@query(sql.events(f"""SELECT ds AS snapshot_date FROM ({sql.days_sql(sql.EVENTS_START, sql.EVENTS_END)})
WHERE ds NOT IN (SELECT snapshot_date FROM daily)""", state=False, gaps=True))  # fmt: skip
def missing_calendar_days(spark, sf_dir):
    """Calendar days on which the feed, taken as the table to look at, has nothing."""
    inputs = events_inputs(spark, sf_dir, gaps=True)
    tables = Tables(inputs.bronze, inputs.daily, inputs.daily, inputs.daily)
    return missing_days(tables, inputs.start, inputs.end)


@query(
    sql.events(
        """SELECT snapshot_date, active, added, churned,
  active - (lag(active) OVER (ORDER BY snapshot_date) + added - churned) AS variance
FROM (SELECT snapshot_date, CAST(sum(is_active_subscription) AS BIGINT) AS active,
        CAST(sum(is_addition) AS BIGINT) AS added, CAST(sum(is_churn_event) AS BIGINT) AS churned
      FROM state GROUP BY snapshot_date)"""
    )
)
def rollforward_identity(spark, sf_dir):
    inputs = events_inputs(spark, sf_dir)
    days = state_days(_healthy(inputs), inputs.start, inputs.end, inputs.cfg)
    return with_variance(days).select("snapshot_date", "active", "added", "churned", "variance")


@query(
    sql.orders(
        f"""SELECT s.subscription_key, s.mou_30d, coalesce(sum(d.minutes_of_usage), 0) AS recomputed
FROM state s LEFT JOIN daily d ON d.subscription_key = s.subscription_key
 AND d.snapshot_date BETWEEN s.snapshot_date - 29 AND s.snapshot_date
WHERE s.snapshot_date = {sql.ORDERS_END} GROUP BY ALL"""
    )
)
def trailing_30d_recompute(spark, sf_dir):
    inputs = orders_inputs(spark, sf_dir)
    states = inputs.states(emit_from=inputs.end, with_arrays=False).select("subscription_key", "mou_30d")
    month = inputs.daily.where(F.col("snapshot_date") > F.date_sub(F.lit(inputs.end), 30))
    sums = month.groupBy("subscription_key").agg(F.sum("minutes_of_usage").alias("recomputed"))
    joined = states.join(sums, "subscription_key", "left")
    return joined.withColumn("recomputed", F.coalesce("recomputed", F.lit(0.0)))


# --- pipeline on stored tables ----------------------------------------------


def _kept(df: DataFrame, *folders: str) -> DataFrame:
    """`df` as a table of its own; what it was read from goes."""
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    for gone in folders:
        delete_folder(spark, gone)
    return spark.read.schema(df.schema).parquet(folder)


def _done_with(warehouse: Warehouse, result: DataFrame) -> DataFrame:
    """The result of a query on stored tables; the tables go."""
    result = _kept(result)
    warehouse.drop()
    delete_folder(warehouse.spark, warehouse.root)
    return result


def _stored(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The event snapshots in tables of their own, with every load run over them."""
    inputs = events_inputs(spark, sf_dir)
    return _loaded(spark, inputs, inputs.end)


def _loaded(spark: SparkSession, inputs: Inputs, end: date) -> Warehouse:
    """The snapshots in a table, and every load up to `end`."""
    warehouse = _empty_warehouse(spark)
    warehouse.replace_touched(SNAPSHOT, inputs.bronze.hint("rebalance", "snapshot_date"))
    backfill(warehouse, inputs.start, end, inputs.cfg)
    return warehouse


def _empty_warehouse(spark: SparkSession) -> Warehouse:
    # As many buckets as the cluster has cores.
    buckets = spark.sparkContext.defaultParallelism
    return Warehouse(spark, scratch_folder(spark), f"subtide_{uuid4().hex[:12]}", buckets)


@query(sql.events("SELECT * FROM gold", sql.KPI, sql.VIEW))
def stored_reporting_view(spark, sf_dir):
    warehouse = _stored(spark, sf_dir)
    return _done_with(warehouse, kpi_view(warehouse))


@query(
    sql.events(
        f"""SELECT proc_name, {sql.EVENTS_END} AS ds, CAST(n AS BIGINT) AS rows_affected, 'SUCCESS' AS status,
  'range ' || {sql.EVENTS_START} || '..' || {sql.EVENTS_END} AS message
FROM (SELECT 'load_subscription_daily' AS proc_name, count(*) AS n FROM daily
      UNION ALL SELECT 'load_subscription_cumulated', count(*) FROM state
      UNION ALL SELECT 'load_ott_kpi_daily', count(*) FROM kpi)""",
        sql.KPI,
    )
)
def run_log_rows(spark, sf_dir):
    warehouse = _stored(spark, sf_dir)
    log = warehouse.table("etl_run_log").select("proc_name", "ds", "rows_affected", "status", "message")
    return _done_with(warehouse, log)


@query(sql.events(f"{_ALL_SQL} WHERE snapshot_date > DATE '{fixtures.EVENTS_MISSING[0]}'", gaps=True))
def stored_range_after_pruned_history(spark, sf_dir):
    """A range that goes on from stored state in the middle of a feed gap, when older daily rows are gone."""
    inputs = events_inputs(spark, sf_dir, gaps=True)
    last = fixtures.EVENTS_MISSING[0]
    warehouse = _loaded(spark, inputs, last)
    warehouse.replace_range(DAILY, inputs.daily.where("false"), inputs.start, last)
    backfill(warehouse, last + timedelta(days=1), inputs.end, inputs.cfg)
    return _done_with(warehouse, _state_rows(warehouse, last + timedelta(days=1), inputs.end))


def _state_rows(warehouse: Warehouse, start: date, end: date) -> DataFrame:
    return _lists_as_text(warehouse.read(STATE, start, end)).select(*STATE_SCALARS, *HISTORY_COLUMNS)


@query(sql.events(f"{_ALL_SQL} WHERE snapshot_date > {_LAST} - 3", gaps=True))
def stored_step_backfill(spark, sf_dir):
    """The last three days, one by one, on the stored tables of the days before."""
    inputs = events_inputs(spark, sf_dir, gaps=True)
    warehouse = _loaded(spark, inputs, inputs.end - timedelta(days=3))
    first = inputs.end - timedelta(days=2)
    backfill(warehouse, first, inputs.end, inputs.cfg, mode="step")
    return _done_with(warehouse, _state_rows(warehouse, first, inputs.end))


# What was wrong before the correction: a third of the users missing and minutes too high, on a few dates.
_CORRECTED = (timedelta(days=9), timedelta(days=12))


def _repaired(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Every load over snapshots that are wrong on a few dates; then these are corrected and repaired."""
    inputs = events_inputs(spark, sf_dir)
    first, last = (inputs.start + d for d in _CORRECTED)
    wrong = F.col("snapshot_date").between(F.lit(first), F.lit(last)) & (F.col("subscriber_id").cast("long") % 9 < 4)
    missing = wrong & (F.col("subscriber_id").cast("long") % 3 == 1)
    more = F.when(wrong, F.col("minutes_of_usage") + 2).otherwise(F.col("minutes_of_usage"))
    before = inputs.bronze.where(~missing).withColumn("minutes_of_usage", more)
    warehouse = _loaded(spark, replace(inputs, bronze=before), inputs.end)
    warehouse.replace_touched(SNAPSHOT, inputs.bronze.where(F.col("snapshot_date").between(F.lit(first), F.lit(last))))
    repair(warehouse, first, last, inputs.cfg)
    return warehouse


@query(sql.events(_ALL_SQL))
def repair_forward(spark, sf_dir):
    """State after a repair of corrected dates: equal to building everything from the corrected rows."""
    warehouse = _repaired(spark, sf_dir)
    return _done_with(warehouse, _lists_as_text(warehouse.table(STATE)).select(*STATE_SCALARS, *HISTORY_COLUMNS))


@query(sql.events("SELECT * FROM gold", sql.KPI, sql.VIEW))
def repair_forward_view(spark, sf_dir):
    warehouse = _repaired(spark, sf_dir)
    return _done_with(warehouse, kpi_view(warehouse))


@query(sql.events(f"""SELECT ds AS snapshot_date, CAST(count(daily.snapshot_date) AS BIGINT) AS daily_rows, count(daily.snapshot_date) > 0 AS listed
FROM ({sql.days_sql(sql.EVENTS_START, sql.EVENTS_END)}) LEFT JOIN daily ON snapshot_date = ds AND ds NOT IN ({_FIRST} + 4, {_FIRST} + 6)
GROUP BY ds""", state=False))
def emptied_date_stays_empty(spark, sf_dir):
    """Two dates are taken out of the snapshots; loaded again, their daily rows and partitions are gone."""
    inputs = events_inputs(spark, sf_dir)
    warehouse = _empty_warehouse(spark)
    warehouse.replace_touched(SNAPSHOT, inputs.bronze.hint("rebalance", "snapshot_date"))
    load_subscription_daily(warehouse, inputs.start, inputs.end, inputs.cfg)
    gone = [inputs.start + timedelta(days=n) for n in (4, 6)]
    warehouse.replace_range(SNAPSHOT, inputs.bronze.where(F.col("snapshot_date") == F.lit(gone[0] + timedelta(days=1))), *gone)
    load_subscription_daily(warehouse, inputs.start, inputs.end, inputs.cfg)
    listed = F.col("day").isin(warehouse.partitions(DAILY))
    rows = warehouse.table(DAILY).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("daily_rows"))
    days = spark.range(1).select(F.explode(F.sequence(F.lit(inputs.start), F.lit(inputs.end))).alias("day"))
    result = days.join(rows, F.col("day") == F.col("snapshot_date"), "left").select(
        F.col("day").alias("snapshot_date"), F.coalesce("daily_rows", F.lit(0)).alias("daily_rows"), listed.alias("listed")
    )
    return _done_with(warehouse, result)


@query(sql.events(f"""SELECT * FROM (VALUES
  ('load_subscription_daily', {_FIRST}, 'SUCCESS', (SELECT count(*) FROM daily WHERE snapshot_date = {_FIRST}), false, true),
  ('load_subscription_cumulated', {_FIRST}, 'SUCCESS', (SELECT count(*) FROM daily WHERE snapshot_date = {_FIRST}), false, true),
  ('load_ott_kpi_daily', {_FIRST}, 'SUCCESS', (SELECT count(DISTINCT opco_code) FROM daily WHERE snapshot_date = {_FIRST}), true, true),
  ('load_subscription_daily', {_LAST} + 5, 'SKIPPED', 0, true, true),
  ('load_subscription_cumulated', {_FIRST} + 2, 'FAILED', 0, true, true)
) log(proc_name, ds, status, rows_affected, has_message, duration_not_negative)""", state=False))  # fmt: skip
def run_log_statuses(spark, sf_dir):
    """A day that works, a date without snapshots, and a step without the day before."""
    inputs = events_inputs(spark, sf_dir)
    warehouse = _empty_warehouse(spark)
    warehouse.replace_touched(SNAPSHOT, inputs.bronze.hint("rebalance", "snapshot_date"))
    run_pipeline(warehouse, inputs.start, inputs.cfg)
    load_subscription_daily(warehouse, inputs.end + timedelta(days=5), cfg=inputs.cfg)
    with suppress(LoadFailed):
        load_subscription_cumulated(warehouse, inputs.start + timedelta(days=2), inputs.cfg)
    log = warehouse.table("etl_run_log").select(
        "proc_name", "ds", "status", "rows_affected", F.col("message").isNotNull().alias("has_message"), (F.col("duration_sec") >= 0).alias("duration_not_negative")
    )
    return _done_with(warehouse, log)


# --- landing to stored snapshots --------------------------------------------

_DELIVERED = "month(day) || '/' || day(day) || '/' || year(day)"
_DELIVERED_SQL = "delivered AS (SELECT *, CAST(event_id AS BIGINT) AS n, CAST(ts AS DATE) AS day FROM events)"


def _delivered(spark: SparkSession, sf_dir: str, minutes: int = 0) -> DataFrame:
    """Events as delivered rows, each with a key of its own."""
    day = F.to_date("ts")
    return fixtures.read_table(spark, sf_dir, "events").select(
        F.concat_ws("/", F.month(day), F.day(day), F.year(day)).alias("snapshot_date"),
        F.col("event_id").cast("long").cast("string").alias("subscription_id"),
        F.col("event_type").alias("subscription_name"),
        F.col("user_id").cast("string").alias("subscriber_id"),
        day.cast("string").alias("subscription_start_date"),
        F.lit(None).cast("string").alias("subscription_end_date"),
        (F.col("event_id").cast("long") % 300 + minutes).cast("string").alias("minutes_of_usage"),
        day.alias("day"),
    )


def _landed_sql(minutes: str, where: str = "true") -> str:
    return f"""WITH {_DELIVERED_SQL}
SELECT 'OPX' AS opco_code, CAST(user_id AS VARCHAR) AS subscriber_id, event_type AS subscription_name, CAST(n AS VARCHAR) AS subscription_id,
  day AS subscription_start_date, CAST(NULL AS DATE) AS subscription_end_date, CAST({minutes} AS DOUBLE) AS minutes_of_usage, day AS snapshot_date
FROM delivered WHERE {where}"""


@query(_landed_sql(f"n % 300 + CAST(day >= {_FIRST} + 9 AS INT)"))
def stored_landing_upsert(spark, sf_dir):
    """Two loads: the later days, corrected, over an overlapping earlier part."""
    warehouse = _empty_warehouse(spark)
    start, _ = fixtures.window_of(fixtures.event_feed_dates(spark, sf_dir))
    early, late = F.lit(start + timedelta(days=19)), F.lit(start + timedelta(days=9))
    load_snapshots(warehouse, _delivered(spark, sf_dir).where(F.col("day") <= early).drop("day"), "OPX")
    load_snapshots(warehouse, _delivered(spark, sf_dir, 1).where(F.col("day") >= late).drop("day"), "OPX")
    return _done_with(warehouse, warehouse.table(SNAPSHOT))


_WITHOUT_KEY = {"subscriber_id": 17, "subscription_id": 19}
_UNREAD = 23


def _with_faults(delivered: DataFrame) -> DataFrame:
    n = F.col("subscription_id").cast("long")
    faults = {c: F.when(n % k != 0, F.col(c)) for c, k in _WITHOUT_KEY.items()}
    return delivered.drop("day").withColumns(faults | {"snapshot_date": F.when(n % _UNREAD == 0, "soon").otherwise(F.col("snapshot_date"))})


@query(f"""WITH {_DELIVERED_SQL}
SELECT 'first' AS load_id, 'OPX' AS opco_code,
  CASE WHEN n % {_UNREAD} = 0 THEN 'snapshot_date' WHEN n % 17 = 0 THEN 'no subscriber_id' ELSE 'no subscription_id' END AS reject_reason,
  CASE WHEN n % {_UNREAD} = 0 THEN 'soon' ELSE {_DELIVERED} END AS snapshot_date,
  CASE WHEN n % 17 <> 0 THEN CAST(user_id AS VARCHAR) END AS subscriber_id, CASE WHEN n % 19 <> 0 THEN CAST(n AS VARCHAR) END AS subscription_id,
  event_type AS subscription_name, CAST(n % 300 AS VARCHAR) AS minutes_of_usage
FROM delivered WHERE n % 17 = 0 OR n % 19 = 0 OR n % {_UNREAD} = 0""")
def landing_null_keys(spark, sf_dir):
    """Rows without a key and rows that can't be read are stored as delivered, under their load; a second
    load of the same rows under the same id changes nothing."""
    warehouse = _empty_warehouse(spark)
    for _ in range(2):
        load_snapshots(warehouse, _with_faults(_delivered(spark, sf_dir)), "OPX", allow_rejects=True, load_id="first")
    columns = ["load_id", "opco_code", "reject_reason", "snapshot_date", "subscriber_id", "subscription_id", "subscription_name", "minutes_of_usage"]
    return _done_with(warehouse, warehouse.table("landing_rejects").select(*columns))


@query(f"""WITH {_DELIVERED_SQL}
SELECT 'rejected' AS kept_as, CASE WHEN n % 17 = 0 THEN 'no subscriber_id' ELSE 'no subscription_id' END AS reason, count(*) AS kept_rows
FROM delivered WHERE n % 17 = 0 OR n % 19 = 0 GROUP BY ALL
UNION ALL SELECT 'snapshot', CAST(CASE WHEN n % {_UNREAD} = 0 THEN {_FIRST} ELSE day END AS VARCHAR), count(*)
FROM delivered WHERE n % 17 <> 0 AND n % 19 <> 0 GROUP BY ALL""")
def landing_rejects_replayed(spark, sf_dir):
    """The unreadable dates are mended and loaded again; what still has no key stays with the rejects."""
    warehouse = _empty_warehouse(spark)
    start, _ = fixtures.window_of(fixtures.event_feed_dates(spark, sf_dir))
    load_snapshots(warehouse, _with_faults(_delivered(spark, sf_dir)), "OPX", allow_rejects=True, load_id="first")
    date_of = F.when(F.col("snapshot_date") == "soon", F.lit(str(start))).otherwise(F.col("snapshot_date"))
    replay_rejects(warehouse, "first", lambda raw: raw.withColumn("snapshot_date", date_of))
    rejected = rejects_by_load(warehouse).select(F.lit("rejected").alias("kept_as"), F.col("reject_reason").alias("reason"), F.col("rejected_rows").alias("kept_rows"))
    stored = warehouse.table(SNAPSHOT).groupBy(F.col("snapshot_date").cast("string").alias("reason")).agg(F.count(F.lit(1)).alias("kept_rows"))
    return _done_with(warehouse, rejected.unionByName(stored.withColumn("kept_as", F.lit("snapshot"))))


# --- validation on stored tables ---------------------------------------------

_GOLDEN_DATES = f"{_FIRST} + 9"


@query(f"""WITH {_DELIVERED_SQL}, golden AS (
  SELECT CAST(user_id AS VARCHAR) AS subscriber_id, day AS event_date, CASE event_type WHEN 'click' THEN 'NEW' ELSE 'CHURN' END AS event_type, n
  FROM delivered WHERE n % 29 <> 3 AND n % 31 <> 4 AND n % 37 <> 5)
SELECT subscriber_id, event_date, event_type FROM golden WHERE event_date < {_GOLDEN_DATES}
UNION ALL SELECT subscriber_id, event_date, 'WINBACK' FROM golden WHERE event_date >= {_GOLDEN_DATES} AND n % 2 = 0""")
def golden_events_loaded(spark, sf_dir):
    """Golden events from delivered strings, then those of the later dates replaced."""
    n, day = F.col("event_id").cast("long"), F.to_date("ts")
    start, end = fixtures.window_of(fixtures.event_feed_dates(spark, sf_dir))
    raw = fixtures.read_table(spark, sf_dir, "events").select(
        n.alias("n"),
        F.when(n % 29 != 3, F.col("user_id").cast("string")).alias("subscriber_id"),
        F.when(n % 31 == 4, "soon").when(n % 2 == 0, day.cast("string")).otherwise(F.concat_ws("/", F.month(day), F.day(day), F.year(day))).alias("event_date"),
        F.when(n % 37 == 5, "BORN").when(F.col("event_type") == "click", " new").otherwise("Churn").alias("event_type"),
    )
    warehouse = _empty_warehouse(spark)
    load_golden_events(warehouse, raw, allow_rejects=True)
    readable = parse_golden_events(raw.where("n % 2 = 0")).where("reject_reason IS NULL")
    again = readable.where(F.col("event_date") >= F.lit(start + timedelta(days=9))).select(
        F.col("raw_subscriber_id").alias("subscriber_id"), F.col("raw_event_date").alias("event_date"), F.lit("winback").alias("event_type")
    )
    load_golden_events(warehouse, again, start + timedelta(days=9), end)
    return _done_with(warehouse, warehouse.table("test_expected_events"))


_FEWER = "golden AS (SELECT * FROM happened WHERE event_type <> 'REACQUISITION')"
_NONE = sql.differences("happened", "happened").replace("differences AS", "none AS")
_first_run = _suite_sql(_events_counts, _LINES, "first")
_second_run = _suite_sql(_events_counts, _LINES, "second").replace("FROM differences", "FROM none")


def _two_runs(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, dict[str, bool]]:
    """Two runs of a day: one without some golden events, one with all; and whether each raised."""
    inputs = events_inputs(spark, sf_dir)
    warehouse = _loaded(spark, inputs, inputs.end)
    golden = lifecycle_events(warehouse.table(STATE), inputs.start, inputs.end).select(*EVENT_KEYS)
    now, raised = datetime(2024, 2, 1, 12), {}
    for run_id, events in (("first", golden.where("event_type <> 'REACQUISITION'")), ("second", golden)):
        warehouse.replace_all("test_expected_events", events)
        try:
            validate(warehouse, inputs.start, inputs.end, inputs.cfg, now, run_id)
            raised[run_id] = False
        except ChecksFailed:
            raised[run_id] = True
    return warehouse, raised


@query(sql.events(f"{_first_run} UNION ALL {_second_run}", sql.EVENT_ROWS, _FEWER, sql.differences("golden", "happened"), _NONE))
def validate_stored_results(spark, sf_dir):
    """What two runs of a day have stored; the first finds unexpected events."""
    warehouse, _ = _two_runs(spark, sf_dir)
    return _done_with(warehouse, warehouse.table("test_results").drop("test_run_ts", "run_date"))


@query(sql.events("""SELECT run_id, CAST(12 AS BIGINT) AS results, CAST(bad > 0 AS BIGINT) AS failed, bad > 0 AS raised
FROM (SELECT 'first' AS run_id, (SELECT count(*) FROM differences) AS bad UNION ALL SELECT 'second', (SELECT count(*) FROM none))""",
                  sql.EVENT_ROWS, _FEWER, sql.differences("golden", "happened"), _NONE))
def validate_gate_outcomes(spark, sf_dir):
    """A run's gate counts its own results: the failed run of the same day doesn't stop the second."""
    warehouse, raised = _two_runs(spark, sf_dir)
    outcome = F.create_map(*[F.lit(x) for pair in raised.items() for x in pair])
    runs = warehouse.table("test_results").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("results"), F.count_if(F.col("status") == "FAIL").alias("failed")
    )
    return _done_with(warehouse, runs.withColumn("raised", outcome[F.col("run_id")]))
