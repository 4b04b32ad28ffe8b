"""Plain SQL for the results of the registered queries, to check them on another engine.

The SQL does not follow the Spark jobs. State over the order snapshots comes from
a dense grid of days with window functions; state over the event snapshots from a
recursive query that goes day by day.
"""

from __future__ import annotations

from subtide.config import LifecycleConfig
from subtide.plans.shapes import KPI_MINUTES, KPI_SUMS, KPI_UNIQUES
from subtide.sources.fixtures import (
    EVENTS_CONFIG,
    EVENTS_MISSING,
    ORDERS_CONFIG,
)

# The first and the last feed date; those of EVENTS_MISSING lie between.
ORDERS_START, ORDERS_END = (f"(SELECT {f}(CAST(l_shipdate AS DATE)) FROM lineitem)" for f in ("min", "max"))
EVENTS_START, EVENTS_END = (f"(SELECT {f}(CAST(ts AS DATE)) FROM events)" for f in ("min", "max"))

_MISSING = ", ".join(f"DATE '{d}'" for d in EVENTS_MISSING)

ORDERS_BRONZE = """
bronze AS (
  SELECT r_name AS opco_code, CAST(o_custkey AS VARCHAR) AS subscriber_id,
         l_linestatus AS subscription_name, CAST(l_orderkey AS VARCHAR) AS subscription_id,
         CAST(o_orderdate AS DATE) AS subscription_start_date,
         CAST(l_shipdate AS DATE) + 30 AS subscription_end_date,
         CAST(greatest(l_quantity - 10, 0) AS DOUBLE) AS minutes_of_usage,
         CAST(l_shipdate AS DATE) AS snapshot_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""



def _events_bronze(gaps: bool | str, minutes: str) -> str:
    of = f" AND (user_id % 2 = 0) = ('{gaps}' = 'OP0')" if isinstance(gaps, str) else ""
    feed = f"WHERE NOT (CAST(ts AS DATE) IN ({_MISSING}){of})" if gaps else ""
    return f"""
bronze AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'OP0' ELSE 'OP1' END AS opco_code,
         CAST(user_id AS VARCHAR) AS subscriber_id, event_type AS subscription_name,
         CAST(CAST(event_id AS BIGINT) // 1000 AS VARCHAR) AS subscription_id,
         CAST(ts AS DATE) AS subscription_start_date, CAST(ts AS DATE) + 5 AS subscription_end_date,
         CAST({minutes} AS DOUBLE) AS minutes_of_usage, CAST(ts AS DATE) AS snapshot_date
  FROM events {feed})"""


DAILY = """
daily AS (
  SELECT opco_code, opco_code || '|' || subscriber_id || '|' || subscription_name AS subscription_key,
         subscriber_id, subscription_name,
         first(subscription_id ORDER BY subscription_start_date DESC NULLS LAST,
               subscription_id DESC NULLS LAST) AS subscription_id,
         CAST(1 AS BIGINT) AS is_paying_today,
         CAST(sum(coalesce(minutes_of_usage, 0)) >= 1 AS BIGINT) AS is_viewer_today,
         sum(coalesce(minutes_of_usage, 0)) AS minutes_of_usage,
         min(subscription_start_date) AS subscription_start_date,
         max(subscription_end_date) AS paid_through_date, snapshot_date
  FROM bronze WHERE subscriber_id IS NOT NULL AND subscription_name IS NOT NULL
  GROUP BY opco_code, subscriber_id, subscription_name, snapshot_date)"""


def days_sql(start: str, end: str) -> str:
    return f"SELECT CAST(unnest(generate_series({start}, {end}, INTERVAL 1 DAY)) AS DATE) AS ds"


def _grid_state(cfg: LifecycleConfig, start, end) -> str:
    """State from dense days: every property is a window over the key's calendar."""
    grace, winback, keep, cap = cfg.grace_days, cfg.winback_days, cfg.retention_days, cfg.array_size
    week, month = cfg.window(7), cfg.window(30)
    return f"""
feed AS (SELECT DISTINCT snapshot_date FROM daily),
keys AS (SELECT subscription_key, any_value(opco_code) AS opco_code, any_value(subscriber_id) AS subscriber_id,
                any_value(subscription_name) AS subscription_name, min(snapshot_date) AS born
         FROM daily GROUP BY subscription_key),
grid AS (
  SELECT keys.*, ds, CASE WHEN feed.snapshot_date IS NULL THEN NULL
                          WHEN daily.subscription_key IS NULL THEN 0 ELSE 1 END AS seen,
         coalesce(is_viewer_today, 0) AS viewer, coalesce(minutes_of_usage, 0.0) AS minutes,
         subscription_id AS id, paid_through_date AS paid_through
  FROM keys JOIN ({days_sql(start, end)}) ON ds >= born
  LEFT JOIN feed ON feed.snapshot_date = ds
  LEFT JOIN daily ON daily.subscription_key = keys.subscription_key AND daily.snapshot_date = ds),
carried AS (
  SELECT *, last_value(seen IGNORE NULLS) OVER w AS paying FROM grid
  WINDOW w AS (PARTITION BY subscription_key ORDER BY ds ROWS UNBOUNDED PRECEDING)),
aged AS (
  SELECT *, ds - max(CASE WHEN paying = 1 THEN ds END) OVER w AS idle FROM carried
  WINDOW w AS (PARTITION BY subscription_key ORDER BY ds ROWS UNBOUNDED PRECEDING)),
yesterday AS (
  SELECT *, idle <= {keep} AS alive, lag(idle) OVER w AS idle_before,
         coalesce(lag(idle) OVER w <= {keep}, false) AS lived FROM aged
  WINDOW w AS (PARTITION BY subscription_key ORDER BY ds)),
moves AS (
  SELECT *, paying = 1 AND NOT lived AS is_new,
         idle > {grace} AND NOT (lived AND idle_before > {grace}) AND alive AS churns,
         lived AND idle_before > {grace} AS was_churned, lived AND idle_before <= {grace} AS was_active
  FROM yesterday),
lives AS (
  SELECT *, sum(CAST(is_new AS INT)) OVER w AS life, max(CASE WHEN is_new THEN ds END) OVER w AS first_active,
         max(CASE WHEN churns THEN ds END) OVER w AS churned_on
  FROM moves WINDOW w AS (PARTITION BY subscription_key ORDER BY ds ROWS UNBOUNDED PRECEDING)),
returns AS (
  SELECT *, CASE WHEN was_churned THEN ds - lag(churned_on) OVER w END AS open_days,
         last_value(id IGNORE NULLS) OVER r AS known_id,
         last_value(paid_through IGNORE NULLS) OVER r AS known_paid
  FROM lives WHERE alive
  WINDOW w AS (PARTITION BY subscription_key, life ORDER BY ds),
         r AS (PARTITION BY subscription_key, life ORDER BY ds ROWS UNBOUNDED PRECEDING)),
state AS (
  SELECT opco_code, subscription_key, subscriber_id, subscription_name, known_id AS subscription_id,
    first_active AS first_active_date, ds - CAST(idle AS INTEGER) AS last_active_date, known_paid AS paid_through_date,
    CASE WHEN idle > {grace} THEN churned_on END AS churn_date,
    max(CASE WHEN churns THEN ds END) OVER r AS last_churn_date,
    max(CASE WHEN paying = 1 AND open_days <= {winback} THEN ds END) OVER r AS last_winback_date,
    CAST(paying AS BIGINT) AS is_paying, CAST(idle BETWEEN 1 AND {grace} AS BIGINT) AS is_in_grace,
    CAST(idle <= {grace} AS BIGINT) AS is_active_subscription, CAST(idle > {grace} AS BIGINT) AS is_churned,
    CAST(idle > {grace} AND ds - churned_on <= {winback} AS BIGINT) AS is_in_winback_window,
    CAST(paying = 1 AND NOT was_active AS BIGINT) AS is_addition, CAST(is_new AS BIGINT) AS is_new_subscription,
    CAST(paying = 1 AND coalesce(open_days <= {winback}, false) AS BIGINT) AS is_winback_event,
    CAST(paying = 1 AND coalesce(open_days > {winback}, false) AS BIGINT) AS is_reacquisition_event,
    CAST(churns AS BIGINT) AS is_churn_event,
    CAST(paying = 1 AND was_active AND coalesce(known_id <> lag(known_id) OVER p, false) AS BIGINT)
      AS is_renewal_event,
    CAST(idle AS BIGINT) AS days_since_last_active,
    CAST(CASE WHEN idle > {grace} THEN ds - churned_on WHEN paying = 1 THEN open_days END AS BIGINT)
      AS days_since_churn,
    CAST(ds - first_active AS BIGINT) AS tenure_days,
    CAST(viewer AS BIGINT) AS is_viewer_1d, CAST(max(viewer) OVER w7 AS BIGINT) AS is_viewer_7d,
    CAST(max(viewer) OVER w30 AS BIGINT) AS is_viewer_30d, CAST(max(viewer) OVER w90 AS BIGINT) AS is_viewer_90d,
    CAST(sum(paying) OVER w7 AS BIGINT) AS active_days_7d, CAST(sum(paying) OVER w30 AS BIGINT) AS active_days_30d,
    CAST(sum(paying) OVER w90 AS BIGINT) AS active_days_90d,
    minutes AS mou_1d, sum(minutes) OVER w7 AS mou_7d, sum(minutes) OVER w30 AS mou_30d,
    sum(minutes) OVER w90 AS mou_90d, ds AS snapshot_date, paying, viewer, minutes
  FROM returns
  WINDOW p AS (PARTITION BY subscription_key, life ORDER BY ds),
    r AS (PARTITION BY subscription_key, life ORDER BY ds ROWS UNBOUNDED PRECEDING),
    w7 AS (PARTITION BY subscription_key, life ORDER BY ds ROWS {week - 1} PRECEDING),
    w30 AS (PARTITION BY subscription_key, life ORDER BY ds ROWS {month - 1} PRECEDING),
    w90 AS (PARTITION BY subscription_key, life ORDER BY ds ROWS {cap - 1} PRECEDING))"""


def _replayed_state(cfg: LifecycleConfig, start, end) -> str:
    """State day by day: each recursion step makes the rows of the next date."""
    grace, winback, keep, cap = cfg.grace_days, cfg.winback_days, cfg.retention_days, cfg.array_size
    week, month = cfg.window(7), cfg.window(30)
    per_opco = cfg.feed_scope == "opco"
    feed_key, own_feed = ("opco_code,", "AND f.opco_code = k.opco_code") if per_opco else ("", "")
    kept = (
        "activity", "views", "mou", "first_active", "last_active", "paid_through", "id",
        "churned_on", "last_churn", "last_winback", "is_churned", "is_active",
    )
    nothing = """CAST(NULL AS BIGINT[]) AS activity, CAST(NULL AS BIGINT[]) AS views, CAST(NULL AS DOUBLE[]) AS mou,
         CAST(NULL AS DATE) AS first_active, CAST(NULL AS DATE) AS last_active, CAST(NULL AS DATE) AS paid_through,
         CAST(NULL AS VARCHAR) AS id, CAST(NULL AS DATE) AS churned_on, CAST(NULL AS DATE) AS last_churn,
         CAST(NULL AS DATE) AS last_winback, CAST(NULL AS BIGINT) AS is_churned, CAST(NULL AS BIGINT) AS is_active,
         CAST(0 AS BIGINT) AS is_new, CAST(0 AS BIGINT) AS is_addition, CAST(0 AS BIGINT) AS is_winback,
         CAST(0 AS BIGINT) AS is_reacquired, CAST(0 AS BIGINT) AS is_churn, CAST(0 AS BIGINT) AS is_renewal,
         CAST(NULL AS BIGINT) AS since_churn, false AS alive"""
    return f"""
feed AS (SELECT DISTINCT {feed_key} snapshot_date FROM daily),
keys AS (SELECT DISTINCT subscription_key, opco_code, subscriber_id, subscription_name FROM daily),
grid AS (
  SELECT k.subscription_key, ds, f.snapshot_date IS NOT NULL AS has_feed,
         d.subscription_key IS NOT NULL AS present, d.is_viewer_today, d.minutes_of_usage,
         d.subscription_id, d.paid_through_date
  FROM keys k CROSS JOIN ({days_sql(start, end)}) LEFT JOIN feed f ON f.snapshot_date = ds {own_feed}
  LEFT JOIN daily d ON d.subscription_key = k.subscription_key AND d.snapshot_date = ds),
replay AS (
  SELECT subscription_key, {start} - 1 AS ds, {nothing} FROM keys
  UNION ALL
  SELECT subscription_key, ds, {", ".join(f"CASE WHEN alive THEN {c} END AS {c}" for c in kept)},
         is_new, is_addition, is_winback, is_reacquired, is_churn, is_renewal, since_churn, alive
  FROM (
    SELECT *, CASE WHEN is_churn = 1 THEN ds WHEN paying = 1 THEN NULL ELSE y_churned_on END AS churned_on,
      CASE WHEN is_churn = 1 THEN ds ELSE y_last_churn END AS last_churn,
      CASE WHEN is_winback = 1 THEN ds ELSE y_last_winback END AS last_winback,
      CAST(ds - CASE WHEN is_churn = 1 THEN ds ELSE y_churned_on END AS BIGINT) AS since_churn,
      CAST(paying = 1 OR idle <= {grace} AS BIGINT) AS is_active,
      paying = 1 OR coalesce(idle <= {keep}, false) AS alive
    FROM (
      SELECT *, CAST(paying = 0 AND idle > {grace} AS BIGINT) AS is_churned,
        CAST(paying = 0 AND idle > {grace} AND coalesce(y_is_churned, 0) = 0 AS BIGINT) AS is_churn,
        CAST(paying = 1 AND coalesce(y_is_churned, 0) = 1 AND ds - y_churned_on <= {winback} AS BIGINT) AS is_winback,
        CAST(paying = 1 AND coalesce(y_is_churned, 0) = 1 AND ds - y_churned_on > {winback} AS BIGINT)
          AS is_reacquired,
        CAST(paying = 1 AND y_first IS NULL AS BIGINT) AS is_new,
        CAST(paying = 1 AND coalesce(y_is_active, 0) = 0 AS BIGINT) AS is_addition,
        CAST(paying = 1 AND coalesce(y_is_active, 0) = 1 AND coalesce(id <> y_id, false) AS BIGINT) AS is_renewal
      FROM (
        SELECT *, CAST(ds - last_active AS BIGINT) AS idle FROM (
          SELECT g.subscription_key, g.ds, t.paying,
            list_prepend(t.paying, coalesce(y.activity, []))[1:{cap}] AS activity,
            list_prepend(t.viewer, coalesce(y.views, []))[1:{cap}] AS views,
            list_prepend(t.minutes, coalesce(y.mou, []))[1:{cap}] AS mou,
            CASE WHEN t.paying = 1 THEN g.ds ELSE y.last_active END AS last_active,
            coalesce(y.first_active, CASE WHEN t.paying = 1 THEN g.ds END) AS first_active,
            coalesce(g.paid_through_date, y.paid_through) AS paid_through, coalesce(g.subscription_id, y.id) AS id,
            y.first_active AS y_first, y.churned_on AS y_churned_on, y.last_churn AS y_last_churn,
            y.last_winback AS y_last_winback, y.id AS y_id, y.is_churned AS y_is_churned, y.is_active AS y_is_active
          FROM replay y JOIN grid g ON g.subscription_key = y.subscription_key AND g.ds = y.ds + 1,
          LATERAL (SELECT CAST(CASE WHEN g.has_feed THEN CAST(g.present AS INT)
                                    ELSE coalesce(y.activity[1], 0) END AS BIGINT) AS paying,
                          CAST(coalesce(g.is_viewer_today, 0) AS BIGINT) AS viewer,
                          CAST(coalesce(g.minutes_of_usage, 0) AS DOUBLE) AS minutes) t))))),
state AS (
  SELECT opco_code, subscription_key, subscriber_id, subscription_name, id AS subscription_id,
    activity AS activity_array, views AS viewer_array, mou AS mou_array,
    first_active AS first_active_date, last_active AS last_active_date, paid_through AS paid_through_date,
    churned_on AS churn_date, last_churn AS last_churn_date, last_winback AS last_winback_date,
    activity[1] AS is_paying, CAST(is_active = 1 AND activity[1] = 0 AS BIGINT) AS is_in_grace,
    is_active AS is_active_subscription, is_churned,
    CAST(is_churned = 1 AND since_churn <= {winback} AS BIGINT) AS is_in_winback_window,
    is_addition, is_new AS is_new_subscription, is_winback AS is_winback_event,
    is_reacquired AS is_reacquisition_event, is_churn AS is_churn_event, is_renewal AS is_renewal_event,
    CAST(ds - last_active AS BIGINT) AS days_since_last_active, since_churn AS days_since_churn,
    CAST(ds - first_active AS BIGINT) AS tenure_days,
    views[1] AS is_viewer_1d, CAST(list_sum(views[1:{week}]) > 0 AS BIGINT) AS is_viewer_7d,
    CAST(list_sum(views[1:{month}]) > 0 AS BIGINT) AS is_viewer_30d, CAST(list_sum(views) > 0 AS BIGINT) AS is_viewer_90d,
    CAST(list_sum(activity[1:{week}]) AS BIGINT) AS active_days_7d,
    CAST(list_sum(activity[1:{month}]) AS BIGINT) AS active_days_30d,
    CAST(list_sum(activity) AS BIGINT) AS active_days_90d,
    mou[1] AS mou_1d, list_sum(mou[1:{week}]) AS mou_7d, list_sum(mou[1:{month}]) AS mou_30d,
    list_sum(mou) AS mou_90d, ds AS snapshot_date
  FROM replay JOIN keys USING (subscription_key) WHERE alive)"""


_uniques = ",\n    ".join(
    f"CAST(sum(CAST({condition} AS INT)) AS BIGINT) AS {name}" for name, condition in KPI_UNIQUES.items()
)
KPI = f"""
people AS (
  SELECT opco_code, snapshot_date, subscriber_id, max(is_active_subscription) AS any_active,
         max(is_addition) AS any_added, max(is_churn_event) AS any_churned, max(is_viewer_1d) AS any_1d,
         max(is_viewer_7d) AS any_7d, max(is_viewer_30d) AS any_30d,
         {", ".join(f"sum({source}) AS {name}" for name, source in {**KPI_SUMS, **KPI_MINUTES}.items())}
  FROM state GROUP BY ALL),
totals AS (
  SELECT opco_code, snapshot_date,
    {", ".join(f"CAST(sum({name}) AS BIGINT) AS {name}" for name in KPI_SUMS)},
    {", ".join(f"sum({name}) AS {name}" for name in KPI_MINUTES)},
    {_uniques}
  FROM people GROUP BY opco_code, snapshot_date),
kpi AS (
  SELECT *, active_subscriptions AS closing_subscriptions, active_subscribers AS unique_closing_subscribers,
    minutes_of_usage_1d / nullif(unique_viewers_1d, 0) AS avg_viewing_time_1d,
    minutes_of_usage_7d / nullif(unique_viewers_7d, 0) AS avg_viewing_time_7d,
    minutes_of_usage_30d / nullif(unique_viewers_30d, 0) AS avg_viewing_time_30d
  FROM totals)"""

VIEW = """
opened AS (
  SELECT *, lag(closing_subscriptions) OVER w AS opening_subscriptions,
         lag(unique_closing_subscribers) OVER w AS unique_opening_subscribers
  FROM kpi WINDOW w AS (PARTITION BY opco_code ORDER BY snapshot_date)),
gold AS (
  SELECT snapshot_date, CAST(date_trunc('week', snapshot_date) AS DATE) AS week_start,
    CAST(date_trunc('month', snapshot_date) AS DATE) AS month_start,
    CAST(date_trunc('quarter', snapshot_date) AS DATE) AS quarter_start,
    opco_code, additions, unique_additions, closing_subscriptions, unique_closing_subscribers,
    opening_subscriptions, unique_opening_subscribers, subscription_churn, subscriber_churn,
    winback_subscriptions AS winback_subscription, active_subscribers, active_subscriptions,
    unique_viewers_1d AS unique_viewers, minutes_of_usage_1d AS minutes_of_usage,
    avg_viewing_time_1d AS average_viewing_time, new_subscriptions, reacquisition_subscriptions,
    renewal_subscriptions, paying_subscriptions, grace_subscriptions, unique_viewers_7d, unique_viewers_30d,
    minutes_of_usage_7d, minutes_of_usage_30d, avg_viewing_time_7d, avg_viewing_time_30d,
    closing_subscriptions - (opening_subscriptions + additions - subscription_churn) AS roll_forward_variance
  FROM opened)"""

EVENT_ROWS = """
happened AS (
  SELECT opco_code, subscription_key, subscriber_id, snapshot_date AS event_date, event_type
  FROM (SELECT *, unnest([CASE WHEN is_new_subscription = 1 THEN 'NEW' END,
                          CASE WHEN is_churn_event = 1 THEN 'CHURN' END,
                          CASE WHEN is_winback_event = 1 THEN 'WINBACK' END,
                          CASE WHEN is_reacquisition_event = 1 THEN 'REACQUISITION' END,
                          CASE WHEN is_renewal_event = 1 THEN 'RENEWAL' END]) AS event_type FROM state)
  WHERE event_type IS NOT NULL)"""


def events_of(state: str, name: str) -> str:
    """EVENT_ROWS of another state table, under another name."""
    return EVENT_ROWS.replace("happened AS", f"{name} AS").replace("FROM state)", f"FROM {state})")


def differences(golden: str, actual: str) -> str:
    """Golden events without an actual one and the reverse, a line each."""
    line = "subscriber_id || '|' || event_date || '|' || event_type || '|{}'"
    same = "a.subscriber_id = b.subscriber_id AND a.event_date = b.event_date AND a.event_type = b.event_type"
    return f"""
differences AS (
  SELECT {line.format("MISSING")} AS line FROM {golden} a WHERE NOT EXISTS (SELECT 1 FROM {actual} b WHERE {same})
  UNION ALL
  SELECT {line.format("UNEXPECTED")} FROM {actual} a WHERE NOT EXISTS (SELECT 1 FROM {golden} b WHERE {same}))"""


def counts(start: str, end: str, cfg: LifecycleConfig, daily: str = "daily", state: str = "state", arrays: bool = True) -> dict[str, str]:
    """What each of the twelve checks counts, worked out from the tables; `differences` must be there."""
    twice = "(SELECT count(*) FROM (SELECT 1 FROM {} GROUP BY subscription_key, snapshot_date HAVING count(*) > 1))"
    by_day = f"""(SELECT snapshot_date, count(*) AS daily_rows, sum(minutes_of_usage) AS minutes FROM {daily} GROUP BY 1)"""
    source = """(SELECT snapshot_date, count(DISTINCT opco_code || '|' || subscriber_id || '|' || subscription_name) AS keys,
      sum(coalesce(minutes_of_usage, 0)) AS minutes FROM bronze WHERE subscriber_id IS NOT NULL AND subscription_name IS NOT NULL GROUP BY 1)"""
    paying = f"(SELECT snapshot_date, sum(is_paying) AS paying FROM {state} GROUP BY 1)"
    of_state = lambda condition: f"(SELECT count(*) FROM {state} WHERE {condition})"
    both = lambda a, b: f"({a} = 1 AND {b} = 1)"
    rules = [
        both("is_paying", "is_in_grace"), both("is_paying", "is_churned"), both("is_in_grace", "is_churned"),
        both("is_churn_event", "is_active_subscription"), "(is_winback_event = 1 AND is_addition = 0)",
        "(is_reacquisition_event = 1 AND is_addition = 0)", both("is_winback_event", "is_reacquisition_event"),
        "days_since_last_active < 0",
    ]
    lengths = "len(activity_array) <> len(viewer_array) OR len(activity_array) <> len(mou_array)"
    return {
        "T01": twice.format(daily),
        "T02": twice.format(state),
        "T03": f"""(SELECT count(*) FROM {source} s FULL JOIN {by_day} d USING (snapshot_date)
          WHERE coalesce(keys, -1) <> coalesce(daily_rows, -1) OR abs(coalesce(s.minutes, 0) - coalesce(d.minutes, 0)) > 0.0001)""",
        "T04": f"(SELECT count(*) FROM {by_day} FULL JOIN {paying} USING (snapshot_date) WHERE coalesce(daily_rows, 0) <> coalesce(paying, 0))",
        "T05": of_state(f"len(activity_array) NOT BETWEEN 1 AND {cfg.array_size} OR {lengths}") if arrays else "0",
        "T06": of_state(" OR ".join(rules)),
        "T07": f"""(SELECT count(*) FROM {state} s LEFT JOIN {daily} d USING (subscription_key, snapshot_date)
          WHERE is_paying = 1 AND abs(coalesce(mou_1d, 0) - coalesce(minutes_of_usage, 0)) > 0.0001)""",
        "T08": f"""(SELECT count(*) FROM (SELECT subscription_key, mou_30d FROM {state} WHERE snapshot_date = {end}) LEFT JOIN
          (SELECT subscription_key, sum(minutes_of_usage) AS again FROM {daily}
           WHERE snapshot_date > {end} - {cfg.window(30)} GROUP BY 1) USING (subscription_key) WHERE abs(mou_30d - coalesce(again, 0)) > 0.001)""",
        "T09": f"""(SELECT count(*) FROM (SELECT snapshot_date, active - (lag(active) OVER (ORDER BY snapshot_date) + added - churned) AS off
          FROM (SELECT snapshot_date, sum(is_active_subscription) AS active, sum(is_addition) AS added, sum(is_churn_event) AS churned
                FROM {state} GROUP BY 1)) WHERE snapshot_date > {start} AND off <> 0)""",
        "T10": f"(SELECT count(*) FROM ({days_sql(start, end)}) WHERE ds NOT IN (SELECT snapshot_date FROM {state}))",
        "T11": of_state("is_churned = 1 AND churn_date IS NULL"),
        "T12": "(SELECT count(*) FROM differences)",
    }


def _with(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{','.join(ctes)}\n{select}"


def orders(select: str, *more: str, state: bool = True) -> str:
    grid = [_grid_state(ORDERS_CONFIG, ORDERS_START, ORDERS_END)] if state else []
    return _with(ORDERS_BRONZE, DAILY, *grid, *more, select=select)


def events(
    select: str, *more: str, state: bool = True, gaps: bool | str = False, minutes: str = "floor(value)",
    cfg: LifecycleConfig = EVENTS_CONFIG,
) -> str:
    replay = [_replayed_state(cfg, EVENTS_START, EVENTS_END)] if state else []
    return _with(_events_bronze(gaps, minutes), DAILY, *replay, *more, select=select, recursive=True)
