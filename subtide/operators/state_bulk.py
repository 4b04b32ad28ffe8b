"""Lifecycle state of a whole date range in one job, without a day-by-day loop.

The state machine is serial as written: a day needs the day before. But what a
day looks like depends only on the paying days around it, so the range can be
solved per key:

* a paying day covers itself and the feed-less days that follow it;
* the gap to the previous cover says how the key came back (or that it is new);
* the distance from the end of the cover says whether a later day is in grace,
  churned or past retention.

`paying_spans` works on paying days only (one shuffle on the key, one sort);
`expand_spans` then generates the state days inside the same partitions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtide.config import MONTH_WINDOW_DAYS, SHORT_WINDOW_DAYS, LifecycleConfig
from subtide.functions.columns import day_number, epoch_day, minute_parts, to_day, whole_minutes
from subtide.functions.sizes import broadcast_if_small
from subtide.operators.daily import in_range
from subtide.schemas import HISTORY_COLUMNS, SUBSCRIPTION_CUMULATED

# How a paying day follows the one before it. The additions are the last three.
QUIET, CONTINUED, RENEWED, WINBACK, REACQUISITION, NEW = range(6)
NO_DAY = -1_000_000

# The history arrays that hold running totals (minutes in exact parts) rather than the values of single days.
TOTALS = ["paid_days", "minutes"]

# What a cover taken from stored state knows of the time before it; NULL for daily rows.
CARRIED = ["life_day", "carried_churn_day", "carried_winback_day"]

# What state days need from their span, apart from the key and the lifetime.
LIFE_COLUMNS = [
    "opco_code", "subscriber_id", "subscription_name", "first_active_date",
    "minutes_before_life", "paid_days_before_life",
]
SPAN_COLUMNS = [
    "day", "covered_to", "last_day", "arrival", "churned_for", "last_viewer_day",
    "subscription_id", "paid_through_date", "churn_date", "last_churn_date", "last_winback_date",
    "is_viewer_today", "minutes_of_usage", "minutes_to_date", "paid_days_earlier",
]


def feed_calendar(rows: DataFrame, start: date, end: date, cfg: LifecycleConfig = LifecycleConfig()) -> DataFrame:
    """Dates of the range on which any row arrived, for any opco; or each opco's own, by `feed_scope`."""
    return in_range(rows, start, end).select(*cfg.feed_key, "snapshot_date").distinct()


def _feed_steps(feed_dates: DataFrame, start: date, end: date, by: list[str]) -> DataFrame:
    """(day, next_feed_day) per feed date; the last one reaches to the end of the range.

    Bounded by the number of calendar days (and of opcos, if each has its own), whatever the size of the data.
    """
    days = (
        in_range(feed_dates, start, end)
        .groupBy(*by)
        .agg(F.array_sort(F.collect_set(day_number("snapshot_date"))).alias("days"))
        .where(F.size("days") > 0)
    )
    following = F.concat(
        F.slice("days", 2, F.size("days")), F.array(F.lit(epoch_day(end) + 1))
    )
    return days.select(*by, F.inline(F.arrays_zip(F.col("days").alias("day"), following.alias("next_feed_day"))))


def paying_spans(
    daily: DataFrame,
    start: date,
    end: date,
    cfg: LifecycleConfig = LifecycleConfig(),
    feed_dates: DataFrame | None = None,
    distributed: bool = False,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """One row per paying day with everything its following days depend on.

    `day` .. `covered_to` is the paying cover, `last_day` the last state day
    before the next paying day, the retention drop or the end of the range. All
    window functions share one partitioning and ordering. A key holds at most
    one row per calendar day here, so no window group can grow with the data.
    Pass `feed_dates` when the feed calendar is already known; otherwise it is
    read from `daily`. Pass `distributed` when `daily` comes from a table bucketed
    on the key: nothing is shuffled then. `earlier` is the state of the day before
    `start`; its lives go on (see `_earlier_covers`).
    """
    if feed_dates is None:
        feed_dates = feed_calendar(daily, start, end, cfg)
    grace, winback, retention = cfg.grace_days, cfg.winback_days, cfg.retention_days
    by = cfg.feed_key
    steps = _feed_steps(feed_dates, start, end, by)
    # At most one row per calendar day: safe to broadcast. With a calendar per opco they are counted.
    steps = broadcast_if_small(steps) if by else F.broadcast(steps)
    covers = (
        in_range(daily, start, end)
        .withColumn("day", _never_null(day_number("snapshot_date")))
        .join(steps, [*by, "day"])
        .select(
            *["opco_code", "subscription_key", "subscriber_id", "subscription_name", "subscription_id"],
            *["paid_through_date", "day"],
            _never_null(F.col("next_feed_day") - 1).alias("covered_to"),
            _never_null("is_viewer_today").alias("is_viewer_today"),
            _never_null("minutes_of_usage").alias("minutes_of_usage"),
            *[F.lit(None).cast("int").alias(name) for name in CARRIED],
        )
    )
    if earlier is not None:
        covers = covers.unionByName(_earlier_covers(_with_next_feed_day(earlier, feed_dates, start, end, by), start))
    if not distributed:
        # A fixed number of partitions, because a span can turn into many state
        # days: merged to the size of the spans, partitions would be far too few.
        partitions = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        covers = covers.repartition(partitions, "subscription_key")
    by_key = Window.partitionBy("subscription_key").orderBy("day")
    so_far = by_key.rowsBetween(Window.unboundedPreceding, 0)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)

    def latest_known(column: str, frame) -> Column:
        known = F.when(F.col(column).isNotNull(), F.struct("day", column))
        return F.last(known, ignorenulls=True).over(frame)

    def latest_day(condition: Column, day: Column) -> Column:
        return F.last(F.when(condition, day), ignorenulls=True).over(so_far)

    def at_life_start(column: str) -> Column:
        return F.last(F.when(F.col("arrival") == NEW, F.col(column)), ignorenulls=True).over(so_far)

    paid_days = F.greatest(F.lit(0), F.col("covered_to") - F.col("day") + 1).cast("long")
    idle = F.col("day") - F.col("prev_covered_to") - 1
    churned_for = idle - grace
    return (
        covers.withColumns(
            {
                "prev_covered_to": F.lag("covered_to").over(by_key),
                "next_day": F.lead("day").over(by_key),
                "minutes_to_date": _never_null(F.sum(minute_parts("minutes_of_usage")).over(so_far)),
                "minutes_earlier": _never_null(F.sum(minute_parts("minutes_of_usage")).over(before)),
                "paid_days_earlier": _never_null(F.sum(paid_days).over(before)),
            }
        )
        .withColumns(
            {
                "arrival": F.when(idle.isNull() | ((idle > retention) & F.col("life_day").isNull()), F.lit(NEW))
                .when((idle <= grace) | F.col("life_day").isNotNull(), F.lit(CONTINUED))
                .when(churned_for <= winback, F.lit(WINBACK))
                .otherwise(F.lit(REACQUISITION)),
                "churned_for": churned_for,
                "last_day": F.least(
                    F.col("next_day") - 1, F.col("covered_to") + retention, F.lit(epoch_day(end))
                ),
            }
        )
        .withColumns(
            {
                "life_day": F.coalesce("life_day", "day"),
            }
        )
        .withColumns(
            {
                "first_active_day": _never_null(at_life_start("life_day")),
                "minutes_before_life": at_life_start("minutes_earlier"),
                "paid_days_before_life": at_life_start("paid_days_earlier"),
                "known_id": latest_known("subscription_id", so_far),
                "previous_id": latest_known("subscription_id", before),
                "known_paid_through": latest_known("paid_through_date", so_far),
                "closed_churn_day": latest_day(
                    F.col("arrival").isin(WINBACK, REACQUISITION) | F.col("carried_churn_day").isNotNull(),
                    F.coalesce("carried_churn_day", F.col("prev_covered_to") + grace + 1),
                ),
                "winback_day": latest_day(
                    (F.col("arrival") == WINBACK) | F.col("carried_winback_day").isNotNull(),
                    F.coalesce("carried_winback_day", "day"),
                ),
                "last_viewer_day": latest_day(F.col("is_viewer_today") == 1, F.col("day")),
            }
        )
        .withColumns(
            {
                # Whatever was known before the retention drop is forgotten with it.
                "subscription_id": _this_life(F.col("known_id.day"), F.col("known_id.subscription_id")),
                "previous_id": _this_life(F.col("previous_id.day"), F.col("previous_id.subscription_id")),
                "paid_through_date": _this_life(
                    F.col("known_paid_through.day"), F.col("known_paid_through.paid_through_date")
                ),
                "last_churn_date": to_day(_this_life(F.col("closed_churn_day"))),
                "last_winback_date": to_day(_this_life(F.col("winback_day"))),
                "last_viewer_day": F.coalesce(_this_life(F.col("last_viewer_day")), F.lit(NO_DAY)),
                "first_active_date": to_day(F.col("first_active_day")),
                "churn_date": to_day(F.col("covered_to") + grace + 1),
            }
        )
        .withColumn(
            "arrival",
            F.when(
                (F.col("arrival") == CONTINUED) & (F.col("subscription_id") != F.col("previous_id")),
                F.lit(RENEWED),
            ).otherwise(F.col("arrival")),
        )
        .drop("known_id", "known_paid_through", "previous_id", "closed_churn_day", "winback_day", "minutes_earlier", *CARRIED)
    )


def _with_next_feed_day(state: DataFrame, feed_dates: DataFrame, start: date, end: date, by: list[str]) -> DataFrame:
    """`state` with the first feed date of the range; the day after the range where there is none."""
    first = in_range(feed_dates, start, end).groupBy(*by).agg(F.min(day_number("snapshot_date")).alias("next_feed_day"))
    if by:
        known = state.join(broadcast_if_small(first), by, "left")  # one row per opco
        return known.withColumn("next_feed_day", F.coalesce("next_feed_day", F.lit(epoch_day(end) + 1)))
    found = first.first()[0]
    return state.withColumn("next_feed_day", F.lit(epoch_day(end) + 1 if found is None else found))


def _earlier_covers(state: DataFrame, start: date) -> DataFrame:
    """The history arrays of the day before `start` as covers, no more than an array has days.

    The oldest day of the arrays comes first, paying or not, so that the history reaches back as
    far; where no day of the arrays pays, its cover ends earlier, on the last active day. A payer
    is carried up to the next feed day. What is older than the arrays is in the CARRIED columns.
    """
    c = F.col
    today = epoch_day(start) - 1
    oldest = F.lit(today + 1) - F.size("activity_array")
    days = state.select(
        *["opco_code", "subscription_key", "subscriber_id", "subscription_name", "subscription_id", "paid_through_date"],
        day_number("first_active_date").alias("life_day"),
        day_number("last_churn_date").alias("carried_churn_day"),
        day_number("last_winback_date").alias("carried_winback_day"),
        day_number("last_active_date").alias("active_day"),
        "next_feed_day",
        oldest.alias("oldest"),
        F.posexplode(F.arrays_zip(*HISTORY_COLUMNS)).alias("ago", "then"),
    ).withColumn("day", F.lit(today) - c("ago"))
    paying = c("then.activity_array") == 1
    covered_to = (
        F.when(paying & (c("day") == today), c("next_feed_day") - 1)
        .when(paying, c("day"))
        .otherwise(F.least(c("active_day"), c("day") - 1))
    )
    return days.where(paying | (c("day") == c("oldest"))).select(
        *["opco_code", "subscription_key", "subscriber_id", "subscription_name", "subscription_id", "paid_through_date"],
        _never_null("day").alias("day"),
        _never_null(covered_to).alias("covered_to"),
        _never_null("then.viewer_array").alias("is_viewer_today"),
        _never_null("then.mou_array").alias("minutes_of_usage"),
        *CARRIED,
    )


def _never_null(column: str | Column) -> Column:
    """Zero for NULL; mostly to let the generated code drop its NULL branches."""
    return F.coalesce(column, F.lit(0))


def _this_life(known_on: Column, value: Column | None = None) -> Column:
    return F.when(known_on >= F.col("first_active_day"), known_on if value is None else value)


def with_history(
    spans: DataFrame, cfg: LifecycleConfig = LifecycleConfig(), with_arrays: bool = True
) -> DataFrame:
    """Add `<name>_history` arrays and `history_end` to every span.

    The arrays hold one value per day, newest first, from `history_end` back to
    at least array_size days before the span (or to the start of the lifetime), so
    the history of any day of the span is a slice, and a trailing sum is the
    running total minus an earlier one. They are put together once per block of
    about array_size days of a lifetime instead of once per day. The spans of a
    lifetime follow each other without holes, and the two blocks before one
    always reach back far enough. Everything stays within the partitioning by key.
    """
    cap = cfg.array_size
    names = ["paid_days", "minutes", *(["activity", "viewer", "mou"] if with_arrays else [])]
    life = ["subscription_key", "first_active_day"]
    block = F.floor((F.col("day") - F.col("first_active_day")) / cap).cast("int")
    blocks = (
        spans.withColumn("block", block)
        .groupBy(*life, "block")
        .agg(
            *[F.first(name).alias(name) for name in LIFE_COLUMNS],
            F.max("last_day").alias("history_end"),
            F.sort_array(F.collect_list(F.struct(*SPAN_COLUMNS))).alias("spans"),
        )
    )
    earlier = Window.partitionBy(*life).orderBy("block")
    # What is sorted and kept for the lag are spans; days are put together from them afterwards, one block at a time.
    blocks = blocks.withColumns({f"spans_{n}_before": F.lag("spans", n).over(earlier) for n in (1, 2)})

    # Of the blocks before, only the spans that the history of the first span's first day reaches.
    reached = F.col("spans")[0]["day"] - cap
    before = F.concat(*[F.coalesce(f"spans_{n}_before", F.array()) for n in (2, 1)])
    blocks = blocks.withColumn("known", F.concat(F.filter(before, lambda span: span["last_day"] >= reached), "spans"))

    def reach_back(name: str) -> Column:
        newest_first = F.reverse(F.flatten(F.transform("known", lambda span: _days_of(span)[name])))
        if name in TOTALS:
            # Running totals stand at their starting value before the lifetime.
            newest_first = F.concat(newest_first, F.array_repeat(f"{name}_before_life", cap))
        return newest_first.alias(f"{name}_history")

    return (
        blocks.select(*life, *LIFE_COLUMNS, "history_end", "spans", *map(reach_back, names))
        .select("*", F.inline("spans"))
        .drop("spans")
    )


def _days_of(span: Column) -> dict[str, Column]:
    """Arrays with one value per day of a span, oldest first."""
    paid_to = F.least(span["covered_to"], span["last_day"])
    paid_to = F.greatest(paid_to, span["day"] - 1)  # a cover from stored state may end before its day
    paid, unpaid = paid_to - span["day"] + 1, span["last_day"] - paid_to
    idle_days = span["last_day"] - span["day"]
    one, no_days, no_minutes = F.lit(1).cast("long"), F.lit(0).cast("long"), F.lit(0.0)
    paid_days = span["paid_days_earlier"] + paid
    return {
        "paid_days": F.when(paid == 1, F.array_repeat(paid_days, unpaid + 1)).otherwise(
            F.concat(
                F.slice(F.sequence(span["paid_days_earlier"], paid_days), F.lit(2), paid), F.array_repeat(paid_days, unpaid)
            )
        ),
        "minutes": F.array_repeat(span["minutes_to_date"], idle_days + 1),
        "activity": F.concat(F.array_repeat(one, paid), F.array_repeat(no_days, unpaid)),
        "viewer": F.concat(F.array(span["is_viewer_today"]), F.array_repeat(no_days, idle_days)),
        "mou": F.concat(F.array(span["minutes_of_usage"]), F.array_repeat(no_minutes, idle_days)),
    }


def expand_spans(
    spans: DataFrame,
    cfg: LifecycleConfig = LifecycleConfig(),
    emit_from: date | None = None,
) -> DataFrame:
    """State days from paying spans.

    From plain spans, every column that needs no history; from spans that went
    through `with_history`, all columns of the state table.
    """
    first = F.col("day") if emit_from is None else F.greatest("day", F.lit(epoch_day(emit_from)))
    dense = (
        spans.withColumn("first_day", first)
        .where(F.col("first_day") <= F.col("last_day"))
        .withColumn("state_day", F.explode(F.sequence("first_day", "last_day")))
    )
    c = F.col
    dense = dense.withColumns(
        {
            "idle": F.greatest(F.lit(0), c("state_day") - c("covered_to")),
            "arriving": F.when(c("state_day") == c("day"), c("arrival")).otherwise(F.lit(QUIET)),
        }
    )
    churned, paying = c("idle") > cfg.grace_days, c("idle") == 0
    arriving = c("arriving")
    since_churn = F.when(churned, c("idle") - (cfg.grace_days + 1)).when(
        arriving.between(WINBACK, REACQUISITION), c("churned_for")
    )
    columns = {
        "last_active_date": to_day(c("state_day") - c("idle")),
        "churn_date": F.when(churned, c("churn_date")),
        "last_churn_date": F.when(churned, c("churn_date")).otherwise(c("last_churn_date")),
        "is_paying": paying.cast("long"),
        "is_in_grace": c("idle").between(1, cfg.grace_days).cast("long"),
        "is_active_subscription": (c("idle") <= cfg.grace_days).cast("long"),
        "is_churned": churned.cast("long"),
        "is_in_winback_window": c("idle")
        .between(cfg.grace_days + 1, cfg.grace_days + 1 + cfg.winback_days)
        .cast("long"),
        "is_addition": (arriving >= WINBACK).cast("long"),
        "is_new_subscription": (arriving == NEW).cast("long"),
        "is_winback_event": (arriving == WINBACK).cast("long"),
        "is_reacquisition_event": (arriving == REACQUISITION).cast("long"),
        "is_churn_event": (c("idle") == cfg.grace_days + 1).cast("long"),
        "is_renewal_event": (arriving == RENEWED).cast("long"),
        "days_since_last_active": c("idle").cast("long"),
        "days_since_churn": since_churn.cast("long"),
        "tenure_days": (c("state_day") - c("first_active_day")).cast("long"),
        "is_viewer_1d": F.when(arriving != QUIET, c("is_viewer_today")).otherwise(F.lit(0).cast("long")),
        "mou_1d": F.when(arriving != QUIET, c("minutes_of_usage")).otherwise(F.lit(0.0)),
        "snapshot_date": to_day(c("state_day")),
    }
    if "history_end" in spans.columns:
        newest = c("history_end") - c("state_day")
        paid_days = c("paid_days_earlier") + F.greatest(F.lit(0), c("state_day") - c("idle") - c("day") + 1)
        days_of = {"7d": SHORT_WINDOW_DAYS, "30d": MONTH_WINDOW_DAYS, "90d": cfg.array_size}
        for name, wanted in days_of.items():
            days = cfg.window(wanted)
            columns[f"is_viewer_{name}"] = (c("state_day") - c("last_viewer_day") < days).cast("long")
            columns[f"active_days_{name}"] = paid_days - c("paid_days_history")[newest + days]
            columns[f"mou_{name}"] = whole_minutes(c("minutes_to_date") - c("minutes_history")[newest + days])
        for source, array in zip(["activity_history", "viewer_history", "mou_history"], HISTORY_COLUMNS):
            if source in spans.columns:
                columns[array] = F.slice(source, newest + 1, cfg.array_size)
    return dense.select(
        *[
            columns.get(name, c(name)).alias(name)
            for name in SUBSCRIPTION_CUMULATED.names
            if name in columns or name in spans.columns
        ]
    )


def bulk_cumulated(
    daily: DataFrame,
    start: date,
    end: date,
    cfg: LifecycleConfig = LifecycleConfig(),
    feed_dates: DataFrame | None = None,
    emit_from: date | None = None,
    with_arrays: bool = True,
    distributed: bool = False,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """The state table of `start`..`end`, going on from `earlier`, the state of the day before.

    Without it, from empty state before `start`; with it, no older daily rows are needed.

    Equal to running the daily step over every date of the range. `emit_from`
    leaves out the rows of earlier dates (their history still counts), and
    `with_arrays=False` the three array columns.
    """
    spans = paying_spans(daily, start, end, cfg, feed_dates, distributed, earlier)
    if earlier is not None:
        emit_from = emit_from or start
    if emit_from is not None:
        # Earlier spans are too old to be in anybody's history arrays.
        spans = spans.where(F.col("last_day") >= epoch_day(emit_from) - cfg.array_size - 1)
    return expand_spans(with_history(spans, cfg, with_arrays), cfg, emit_from)
