"""Twelve data-quality checks over the pipeline tables.

Each check is a one-row frame (bad BIGINT, detail STRING); it passes when `bad`
is 0. All of them take an inclusive date range.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtide.config import MONTH_WINDOW_DAYS, LifecycleConfig
from subtide.functions.columns import bit_of, day_number, day_word
from subtide.operators.daily import in_range
from subtide.operators.events import EVENT_FLAGS, EVENT_KEYS, lifecycle_events
from subtide.schemas import HISTORY_COLUMNS, TEST_RESULTS

# Test names as reported.
CHECK_NAMES = {
    "T01": "daily grain unique",
    "T02": "cumulated grain unique",
    "T03": "source -> daily reconciliation",
    "T04": "daily rows = SUM(is_paying) (feed-gap tolerant)",
    "T05": "array integrity",
    "T06": "state-machine integrity",
    "T07": "mou_1d = daily fact",
    "T08": "mou_30d = independent 30d recompute",
    "T09": "roll-forward identity",
    "T10": "no missing calendar day",
    "T11": "is_churned has churn_date",
    "T12": "golden lifecycle events",
}
SEVERITY, EXPECTED = "ERROR", "0"
DETAIL_LIMIT = 50


class ChecksFailed(RuntimeError):
    """At least one check of severity ERROR failed."""


@dataclass(frozen=True)
class Tables:
    """What the checks read. Frames may cover more than the checked range; `cumulated` may come from `checked_state`.

    `marked` are the `marked_rows` of `cumulated` for that range, where they are kept; else `cumulated` is read for them.
    """

    bronze: DataFrame
    daily: DataFrame
    cumulated: DataFrame
    expected_events: DataFrame
    marked: DataFrame | None = None


# The columns of the state that some check reads, but for the history arrays; of those, how long they are.
_READ = [
    "opco_code", "subscription_key", "subscriber_id", "snapshot_date", "churn_date", "is_paying", "is_in_grace",
    "is_active_subscription", "is_churned", "is_addition", "is_new_subscription", "is_winback_event",
    "is_reacquisition_event", "is_churn_event", "is_renewal_event", "days_since_last_active", "mou_1d", "mou_30d",
]


def checked_state(cumulated: DataFrame) -> DataFrame:
    """Every state row with what the checks read: the length of each history array in the place of the array.

    A table of this to be read by several checks is a small part of the state table.
    """
    return cumulated.select(*_READ, *[F.array_size(a).alias(f"{a}_size") for a in HISTORY_COLUMNS])


def marked_rows(cumulated: DataFrame, start: date, end: date) -> DataFrame:
    """The state rows that pay, have an event or belong to the last day: all that T07, T08 and T12 read.

    They grow with the paying days, not with the state days.
    """
    read = ["opco_code", "subscription_key", "subscriber_id", "snapshot_date", "is_paying", *EVENT_FLAGS.values(), "mou_1d", "mou_30d"]
    of_use = (F.col("is_paying") == 1) | (F.greatest(*EVENT_FLAGS.values()) == 1) | (F.col("snapshot_date") == F.lit(end))
    return in_range(cumulated, start, end).where(of_use).select(*read)


def _marked(tables: Tables) -> DataFrame:
    return tables.cumulated if tables.marked is None else tables.marked


def _history_size(cumulated: DataFrame, array: str) -> Column:
    return F.array_size(array) if array in cumulated.columns else F.col(f"{array}_size")


def _one_row(df: DataFrame, bad: Column) -> DataFrame:
    return df.agg(F.coalesce(bad, F.lit(0)).cast("long").alias("bad")).withColumn(
        "detail", F.lit(None).cast("string")
    )


def _duplicates(df: DataFrame, start: date, end: date) -> DataFrame:
    # Key first: with tables bucketed on the key the grouping needs no shuffle.
    groups = in_range(df, start, end).groupBy("subscription_key", "snapshot_date").count()
    return _one_row(groups.where(F.col("count") > 1), F.count(F.lit(1)))


def _repeated(df: DataFrame, start: date, end: date) -> bool:
    """Whether any key has a day twice, by the bits of up to 64 days at a time: far fewer groups than days."""
    day = day_number("snapshot_date")
    words = (
        in_range(df, start, end)
        .groupBy("subscription_key", day_word(day).alias("word"))
        .agg(F.count(F.lit(1)).alias("rows"), F.bit_or(bit_of(day)).alias("days"))
    )
    return words.agg(F.max(F.col("rows") > F.bit_count("days"))).first()[0] or False


def _calendar(tables: Tables, start: date, end: date) -> DataFrame:
    if start > end:
        raise ValueError("start must not be after end")
    one = tables.daily.sparkSession.range(1)
    return one.select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("snapshot_date"))


def _bronze_days(tables: Tables, start: date, end: date) -> DataFrame:
    key = F.concat("opco_code", F.lit("|"), "subscriber_id", F.lit("|"), "subscription_name")
    rows = in_range(tables.bronze, start, end).where(
        F.col("subscriber_id").isNotNull() & F.col("subscription_name").isNotNull()
    )
    # Per key first, so that a busy day is not counted in one task.
    per_key = rows.groupBy("snapshot_date", key.alias("key")).agg(
        F.sum(F.coalesce("minutes_of_usage", F.lit(0.0))).alias("minutes")
    )
    return per_key.groupBy("snapshot_date").agg(
        F.count("key").alias("bronze_keys"), F.round(F.sum("minutes"), 4).alias("bronze_minutes")
    )


def _daily_days(tables: Tables, start: date, end: date) -> DataFrame:
    return (
        in_range(tables.daily, start, end)
        .groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("daily_rows"),
            F.round(F.sum("minutes_of_usage"), 4).alias("daily_minutes"),
        )
    )


def state_days(tables: Tables, start: date, end: date, cfg: LifecycleConfig) -> DataFrame:
    """Per day: sums the date-level checks need and counts of rows that break a rule."""
    c = F.col
    lengths = [_history_size(tables.cumulated, a) for a in HISTORY_COLUMNS]
    arrays_broken = (
        (lengths[0] > cfg.array_size)
        | (lengths[0] < 1)
        | (lengths[0] != lengths[1])
        | (lengths[0] != lengths[2])
    )
    both = lambda a, b: (c(a) == 1) & (c(b) == 1)
    state_broken = (
        both("is_paying", "is_in_grace")
        | both("is_paying", "is_churned")
        | both("is_in_grace", "is_churned")
        | both("is_churn_event", "is_active_subscription")
        | ((c("is_winback_event") == 1) & (c("is_addition") == 0))
        | ((c("is_reacquisition_event") == 1) & (c("is_addition") == 0))
        | both("is_winback_event", "is_reacquisition_event")
        | (c("days_since_last_active") < 0)
        | c("subscription_key").isNull()
    )
    return (
        in_range(tables.cumulated, start, end)
        .groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("state_rows"),
            F.sum("is_paying").alias("paying"),
            F.sum("is_active_subscription").alias("active"),
            F.sum("is_addition").alias("added"),
            F.sum("is_churn_event").alias("churned"),
            F.count_if(arrays_broken).alias("arrays_broken"),
            F.count_if(state_broken).alias("state_broken"),
            F.count_if((c("is_churned") == 1) & c("churn_date").isNull()).alias("undated_churn"),
        )
    )


# What makes a calendar day fail. The columns come from the per-day frames above;
# a day without rows in a table has NULL there.
def _unreconciled() -> Column:
    keys = F.coalesce("bronze_keys", F.lit(-1)) != F.coalesce("daily_rows", F.lit(-1))
    minutes = F.abs(F.coalesce("bronze_minutes", F.lit(0.0)) - F.coalesce("daily_minutes", F.lit(0.0)))
    return keys | (minutes > 0.0001)


def _paying_differs(tolerate_feed_gaps: bool = False) -> Column:
    """With tolerance, only on days that have daily rows: on others payers are carried."""
    if tolerate_feed_gaps:
        return F.col("daily_rows") != F.coalesce("paying", F.lit(0))
    return F.coalesce("daily_rows", F.lit(0)) != F.coalesce("paying", F.lit(0))


def with_variance(state_days: DataFrame) -> DataFrame:
    """Closing balance minus (opening + additions - churn), over all opcos.

    The window has one row per calendar day, whatever the size of the tables.
    """
    by_day = Window.partitionBy(F.lit(1)).orderBy("snapshot_date")
    opening = F.lag("active").over(by_day)
    variance = F.col("active") - (opening + F.col("added") - F.col("churned"))
    return state_days.withColumn("variance", variance)


def _off_balance(start: date) -> Column:
    return (F.col("snapshot_date") > F.lit(start)) & (F.col("variance") != 0)


def check_t01(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    return _duplicates(tables.daily, start, end)


def check_t02(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    """Days are counted one by one only if some are repeated; to know that, a job runs here."""
    if _repeated(tables.cumulated, start, end):
        return _duplicates(tables.cumulated, start, end)
    none = F.lit(0).cast("long").alias("bad")
    return tables.cumulated.sparkSession.range(1).select(none, F.lit(None).cast("string").alias("detail"))


def check_t03(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    days = _bronze_days(tables, start, end).join(
        _daily_days(tables, start, end), "snapshot_date", "full_outer"
    )
    return _one_row(days, F.count_if(_unreconciled()))


def check_t04(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    days = _daily_days(tables, start, end).join(
        state_days(tables, start, end, cfg), "snapshot_date", "full_outer"
    )
    return _one_row(days, F.count_if(_paying_differs()))


def check_t05(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    return _one_row(state_days(tables, start, end, cfg), F.sum("arrays_broken"))


def check_t06(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    return _one_row(state_days(tables, start, end, cfg), F.sum("state_broken"))


def check_t07(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    on = ["subscription_key", "snapshot_date"]
    paying = in_range(_marked(tables), start, end).where(F.col("is_paying") == 1).select(*on, "mou_1d")
    facts = in_range(tables.daily, start, end).select(*on, "minutes_of_usage")
    off = F.abs(F.coalesce("mou_1d", F.lit(0.0)) - F.coalesce("minutes_of_usage", F.lit(0.0))) > 0.0001
    return _one_row(paying.join(facts, on, "left"), F.count_if(off))


def check_t08(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    """Trailing minutes of the last day against a sum over the daily rows.

    The day is the same for every row, so the lookback is one grouped slice.
    """
    states = in_range(_marked(tables), end, end).select("subscription_key", "mou_30d")
    first = end - timedelta(days=cfg.window(MONTH_WINDOW_DAYS) - 1)
    sums = (
        in_range(tables.daily, first, end)
        .groupBy("subscription_key")
        .agg(F.sum("minutes_of_usage").alias("recomputed"))
    )
    off = F.abs(F.col("mou_30d") - F.coalesce("recomputed", F.lit(0.0))) > 0.001
    return _one_row(states.join(sums, "subscription_key", "left"), F.count_if(off))


def check_t09(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    days = with_variance(state_days(tables, start, end, cfg))
    return _one_row(days, F.count_if(_off_balance(start)))


def missing_days(tables: Tables, start: date, end: date) -> DataFrame:
    present = in_range(tables.cumulated, start, end).select("snapshot_date").distinct()
    return _calendar(tables, start, end).join(present, "snapshot_date", "left_anti")


def check_t10(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    return _one_row(missing_days(tables, start, end), F.count(F.lit(1)))


def check_t11(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    return _one_row(state_days(tables, start, end, cfg), F.sum("undated_churn"))


def event_differences(tables: Tables, start: date, end: date) -> DataFrame:
    """Golden events without an actual one (MISSING) and the reverse (UNEXPECTED).

    Events are matched by subscriber, date and type only. Counting both sides per
    event gives what a full outer join would leave unmatched, without pairing up
    the repeats of a subscriber with many subscriptions. `rows` says how often the
    event occurs.
    """
    golden = in_range(tables.expected_events, start, end, "event_date").select(
        *EVENT_KEYS, F.lit(1).alias("golden"), F.lit(0).alias("actual")
    )
    actual = lifecycle_events(_marked(tables), start, end).select(
        *EVENT_KEYS, F.lit(0).alias("golden"), F.lit(1).alias("actual")
    )
    counts = golden.unionByName(actual).groupBy(*EVENT_KEYS).agg(
        F.sum("golden").alias("golden"), F.sum("actual").alias("actual")
    )
    return counts.where((F.col("golden") == 0) | (F.col("actual") == 0)).select(
        *EVENT_KEYS,
        F.when(F.col("actual") == 0, "MISSING").otherwise("UNEXPECTED").alias("problem"),
        (F.col("golden") + F.col("actual")).alias("rows"),
    )


def check_t12(tables: Tables, start: date, end: date, cfg=LifecycleConfig()) -> DataFrame:
    differences = event_differences(tables, start, end)
    bad = differences.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("bad"))
    line = F.concat_ws("|", "subscriber_id", F.col("event_date").cast("string"), "event_type", "problem")
    # The report names the first fifty; a sorted limit never gathers more than that.
    repeats = F.least("rows", F.lit(DETAIL_LIMIT)).cast("int")
    lines = differences.select(F.explode(F.array_repeat(line, repeats)).alias("line"))
    text = (
        lines.orderBy("line")
        .limit(DETAIL_LIMIT)
        .agg(F.array_join(F.sort_array(F.collect_list("line")), ",").alias("detail"))
        .select(F.when(F.col("detail") != "", F.col("detail")).alias("detail"))
    )
    parts = bad.unionByName(text, allowMissingColumns=True)
    return parts.agg(F.max("bad").alias("bad"), F.max("detail").alias("detail"))


CHECKS = {
    "T01": check_t01, "T02": check_t02, "T03": check_t03, "T04": check_t04,
    "T05": check_t05, "T06": check_t06, "T07": check_t07, "T08": check_t08,
    "T09": check_t09, "T10": check_t10, "T11": check_t11, "T12": check_t12,
}


def _per_day_checks(tables: Tables, start: date, end: date, cfg: LifecycleConfig, tolerate_feed_gaps: bool = False) -> DataFrame:
    """T03-T06 and T09-T11 together: one pass over each table, then one row per calendar day."""
    days = (
        _calendar(tables, start, end)
        .join(with_variance(state_days(tables, start, end, cfg)), "snapshot_date", "left")
        .join(_daily_days(tables, start, end), "snapshot_date", "left")
        .join(_bronze_days(tables, start, end), "snapshot_date", "left")
    )
    counts = days.agg(
        F.count_if(_unreconciled()).alias("T03"),
        F.count_if(_paying_differs(tolerate_feed_gaps)).alias("T04"),
        F.sum("arrays_broken").alias("T05"),
        F.sum("state_broken").alias("T06"),
        F.count_if(_off_balance(start)).alias("T09"),
        F.count_if(F.col("state_rows").isNull()).alias("T10"),
        F.sum("undated_churn").alias("T11"),
    )
    pairs = [
        F.struct(F.lit(t).alias("test_id"), F.coalesce(F.col(t), F.lit(0)).alias("bad")) for t in counts.columns
    ]
    return counts.select(F.inline(F.array(*pairs))).withColumn("detail", F.lit(None).cast("string"))


def run_checks(
    tables: Tables,
    start: date,
    end: date,
    run_ts: datetime,
    cfg: LifecycleConfig = LifecycleConfig(),
    tolerate_feed_gaps: bool = False,
) -> DataFrame:
    """Twelve result rows, of no run yet."""
    results = _per_day_checks(tables, start, end, cfg, tolerate_feed_gaps)
    for test_id in ("T01", "T02", "T07", "T08", "T12"):
        results = results.unionByName(
            CHECKS[test_id](tables, start, end, cfg).withColumn("test_id", F.lit(test_id))
        )
    names = F.create_map(*[F.lit(part) for pair in CHECK_NAMES.items() for part in pair])
    return results.select(
        F.lit(run_ts).alias("test_run_ts"),
        "test_id",
        names[F.col("test_id")].alias("test_name"),
        F.lit(SEVERITY).alias("severity"),
        F.when(F.col("bad") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.col("bad").alias("failed_rows"),
        F.lit(EXPECTED).alias("expected"),
        F.col("bad").cast("string").alias("actual"),
        "detail",
    ).select(*[c for c in TEST_RESULTS.names if c != "run_id"])
