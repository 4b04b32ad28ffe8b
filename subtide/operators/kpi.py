"""Daily KPIs per opco, from the state table or straight from the daily rows."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtide.config import MONTH_WINDOW_DAYS, SHORT_WINDOW_DAYS, LifecycleConfig
from subtide.functions.columns import WORD_DAYS, bit_of, day_number, day_word, epoch_day, to_day
from subtide.operators.daily import in_range
from subtide.operators.state_bulk import NEW, REACQUISITION, RENEWED, WINBACK, paying_spans
from subtide.schemas import OTT_KPI_DAILY


# What can be true of a subscriber on a day, and the state flag that says so for one of the subscriptions.
_SUBSCRIBER_FLAGS = {
    "unique_additions": "is_addition",
    "subscriber_churn": "is_churn_event",
    "active_subscribers": "is_active_subscription",
    "unique_viewers_1d": "is_viewer_1d",
    "unique_viewers_7d": "is_viewer_7d",
    "unique_viewers_30d": "is_viewer_30d",
}
# What is summed over the state rows of an opco's day.
_SUMS = {
    "additions": "is_addition",
    "new_subscriptions": "is_new_subscription",
    "winback_subscriptions": "is_winback_event",
    "reacquisition_subscriptions": "is_reacquisition_event",
    "renewal_subscriptions": "is_renewal_event",
    "subscription_churn": "is_churn_event",
    "paying_subscriptions": "is_paying",
    "grace_subscriptions": "is_in_grace",
    "active_subscriptions": "is_active_subscription",
    **{f"minutes_of_usage_{w}": f"mou_{w}" for w in ("1d", "7d", "30d")},
}


def _told(states: DataFrame, start: date, end: date) -> DataFrame:
    """A row of sums per opco and day, and a row of bits per subscriber and word of days (`of_subscriber`).

    Every state row tells of its opco; those in which any flag is set also tell of their subscriber.
    """
    of_subscriber, day = F.col("of_subscriber"), day_number("snapshot_date")
    return (
        in_range(states, start, end)
        .select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("of_subscriber"))
        .where(~of_subscriber | (F.greatest(*_SUBSCRIBER_FLAGS.values()) == 1))
        .groupBy(
            "opco_code",
            "of_subscriber",
            F.when(of_subscriber, F.col("subscriber_id")).alias("who"),
            F.when(of_subscriber, day_word(day)).otherwise(day).alias("word_or_day"),
        )
        .agg(
            *[F.sum(F.when(~of_subscriber, F.col(c))).alias(name) for name, c in _SUMS.items()],
            *[
                F.coalesce(F.bit_or(F.when(of_subscriber & (F.col(c) == 1), bit_of(day))), F.lit(0).cast("long")).alias(name)
                for name, c in _SUBSCRIBER_FLAGS.items()
            ],
        )
        .withColumn("subscriber_churn", F.col("subscriber_churn").bitwiseAND(F.bitwise_not("active_subscribers")))
    )


def build_kpi_daily(states: DataFrame, start: date, end: date) -> DataFrame:
    """KPIs of `start`..`end` from stored state rows, in one pass over them.

    Sums need no subscriber: they shrink to one row per opco and day before the shuffle. What has to be known per
    subscriber is one bit per day, and a row of bits is shuffled for each subscriber and 64 days in which a
    subscription is active, comes, goes or is watched. A subscriber is counted from the changes in these bits.
    """
    told = _told(states, start, end)
    of_subscriber = F.col("of_subscriber")
    # From the day before; a word's first day is held against nothing, so that no word needs another one.
    turned = {name: F.col(name).bitwiseXOR(F.shiftleft(name, 1)) for name in _SUBSCRIBER_FLAGS}
    any_turned = reduce(Column.bitwiseOR, turned.values())

    def set_in(bits: Column) -> Column:
        return F.call_function("shiftright", bits, F.col("nth")).bitwiseAND(F.lit(1)) == 1

    def change(name: str) -> Column:
        to = F.when(set_in(F.col(name)), F.lit(1)).otherwise(F.lit(-1))
        return F.when(of_subscriber & set_in(turned[name]), to).otherwise(F.lit(0))

    nth = F.sequence(F.lit(0), F.when(of_subscriber, F.lit(WORD_DAYS - 1)).otherwise(F.lit(0)))
    per_day = (
        told.select("*", F.explode(nth).alias("nth"))
        .where(~of_subscriber | set_in(any_turned))
        .groupBy(
            "opco_code",
            F.when(of_subscriber, F.col("word_or_day") * WORD_DAYS + F.col("nth")).otherwise(F.col("word_or_day")).alias("day"),
        )
        .agg(
            F.bool_or(~of_subscriber).alias("has_state"),
            *[F.sum(name).alias(name) for name in _SUMS],
            *[F.sum(change(name)).alias(name) for name in _SUBSCRIBER_FLAGS],
        )
    )
    # One row per opco and calendar day at most.
    so_far = Window.partitionBy("opco_code", day_word(F.col("day"))).orderBy("day")
    totals = per_day.withColumns({name: F.sum(name).over(so_far) for name in _SUBSCRIBER_FLAGS}).where("has_state")
    return _finish(totals.withColumn("snapshot_date", to_day(F.col("day"))))


def _finish(totals: DataFrame) -> DataFrame:
    """Columns that follow from the others, in table order."""
    return totals.withColumns(
        {
            "closing_subscriptions": F.col("active_subscriptions"),
            "unique_closing_subscribers": F.col("active_subscribers"),
            **{
                f"avg_viewing_time_{w}": F.try_divide(f"minutes_of_usage_{w}", f"unique_viewers_{w}")
                for w in ("1d", "7d", "30d")
            },
        }
    ).select(*OTT_KPI_DAILY.names)


# Balances that change on some days and hold in between.
_LEVELS = ["state_rows", "paying_subscriptions", "grace_subscriptions"]
# Counts that belong to one day.
_FLOWS = [
    "additions", "new_subscriptions", "winback_subscriptions", "reacquisition_subscriptions",
    "renewal_subscriptions", "subscription_churn",
]
_VIEWER_WINDOWS = ["1d", "7d", "30d"]


def kpi_from_daily(
    daily: DataFrame,
    start: date,
    end: date,
    cfg: LifecycleConfig = LifecycleConfig(),
    feed_dates: DataFrame | None = None,
    distributed: bool = False,
) -> DataFrame:
    """The same KPIs without building the state table.

    A subscription stays paying, in grace, active or a recent viewer for an
    interval of days. It is enough to note +1 where an interval starts and -1
    after it ends: the work grows with the paying days, not with the state days.

    Subscription counts only need their sum per opco and day, so those changes
    carry no subscriber and shrink to one row per opco and day before the
    shuffle. Only starts and ends of the intervals that say whether a
    *subscriber* is active or watching are kept per subscriber; there, being in
    the union of the subscriber's intervals means that the running sum of the
    changes is positive.
    """
    windows = {
        "1d": cfg.window(1),
        "7d": cfg.window(SHORT_WINDOW_DAYS),
        "30d": cfg.window(MONTH_WINDOW_DAYS),
    }
    if max(windows.values()) - 1 > cfg.retention_days:
        raise ValueError("a trailing window must not reach beyond retention_days; use build_kpi_daily")
    spans = paying_spans(daily, start, end, cfg, feed_dates, distributed)
    happened = _changes(spans, windows, cfg).where(F.col("day") <= epoch_day(end))
    by_subscriber = happened.groupBy("opco_code", "subscriber_id", "day")
    changes = by_subscriber.agg(
        *[F.sum(c).alias(c) for c in [*_LEVELS, *_FLOWS, "minutes"]],
        *[F.sum(c).alias(c) for c in ["active", "added", *[f"viewing_{w}" for w in windows]]],
    )
    # One row per subscriber and day at most; the rows without a subscriber form
    # one group per opco, with one row per day.
    running = Window.partitionBy("opco_code", "subscriber_id").orderBy("day")

    def turned(name: str) -> Column:
        """+1 on the day the subscriber enters the union, -1 on the day it leaves."""
        now = F.sum(name).over(running) > 0
        earlier = (F.sum(name).over(running) - F.col(name)) > 0
        return now.cast("long") - earlier.cast("long")

    of_subscriber = F.col("subscriber_id").isNotNull()
    turns = changes.withColumns(
        {
            "active_subscribers": F.when(of_subscriber, turned("active")),
            "unique_additions": (of_subscriber & (F.col("added") > 0)).cast("long"),
            **{f"unique_viewers_{w}": F.when(of_subscriber, turned(f"viewing_{w}")) for w in windows},
        }
    ).withColumn("subscriber_churn", (F.col("active_subscribers") == -1).cast("long"))
    levels = [*_LEVELS, "active_subscribers", *[f"unique_viewers_{w}" for w in windows]]
    flows = [*_FLOWS, "unique_additions", "subscriber_churn", "minutes"]
    per_day = turns.groupBy("opco_code", "day").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in [*levels, *flows]]
    )
    # From here on there is one row per opco and calendar day.
    by_opco = Window.partitionBy("opco_code").orderBy("day")
    held = per_day.withColumns(
        {
            **{c: F.sum(c).over(by_opco) for c in levels},
            "next_day": F.coalesce(F.lead("day").over(by_opco), F.lit(epoch_day(end) + 1)),
        }
    )
    calendar = held.withColumn("on_day", F.explode(F.sequence("day", F.col("next_day") - 1))).withColumns(
        {c: F.when(F.col("on_day") == F.col("day"), F.col(c)).otherwise(F.lit(0)) for c in flows}
    )
    trailing = Window.partitionBy("opco_code").orderBy("on_day")
    totals = calendar.withColumns(
        {
            f"minutes_of_usage_{w}": F.sum("minutes").over(trailing.rangeBetween(-(n - 1), 0)).cast("double")
            for w, n in windows.items()
        }
    ).where(F.col("state_rows") > 0)
    return _finish(
        totals.withColumns(
            {
                "active_subscriptions": F.col("paying_subscriptions") + F.col("grace_subscriptions"),
                "snapshot_date": to_day(F.col("on_day")),
            }
        )
    )


def _changes(spans: DataFrame, windows: dict[str, int], cfg: LifecycleConfig) -> DataFrame:
    """What starts, ends or happens because of a span, and on which day.

    Touching intervals of a key are joined here already: nothing is noted where
    one ends on the day the next one starts.
    """
    c, day = F.col, F.col("day")
    spans = spans.withColumn("viewer_day", F.when(c("is_viewer_today") == 1, day))
    by_key = "IGNORE NULLS OVER (PARTITION BY subscription_key ORDER BY day)"
    spans = spans.withColumns(
        {
            "viewed_before": F.expr(f"lag(viewer_day) {by_key}"),
            "viewed_next": F.expr(f"lead(viewer_day) {by_key}"),
            "next_day": F.coalesce("next_day", F.lit(epoch_day(date.max))),
        }
    )
    after_paying, after_grace = c("covered_to") + 1, c("covered_to") + cfg.grace_days + 1
    after_retention = c("covered_to") + cfg.retention_days + 1
    added = c("arrival") >= WINBACK
    resumed = (c("arrival") >= WINBACK) | (c("prev_covered_to") + 1 < day)
    lapsed, churned = c("next_day") > after_paying, c("next_day") > after_grace
    subscriber = c("subscriber_id")
    longs = [*_LEVELS, *_FLOWS, "active", "added", *[f"viewing_{w}" for w in windows]]

    def change(on: Column, of: Column | None, when: Column, **values) -> Column:
        """A change on a day, of a subscriber or of the opco; NULL unless it happens."""
        counts = [values.get(n, F.lit(0)).cast("long").alias(n) for n in longs]
        minutes = values.get("minutes", F.lit(0.0)).alias("minutes")
        who = F.lit(None).cast("string") if of is None else of
        return F.when(when, F.struct(on.alias("day"), who.alias("subscriber_id"), *counts, minutes))

    one, less = F.lit(1), F.lit(-1)
    starts_viewing = {
        f"viewing_{w}": c("viewer_day").isNotNull()
        & (c("viewed_before").isNull() | (c("viewed_before") + n < day))
        for w, n in windows.items()
    }
    happenings = [
        change(
            day, None, F.lit(True),
            state_rows=c("arrival") == NEW,
            paying_subscriptions=resumed,
            additions=added,
            new_subscriptions=c("arrival") == NEW,
            winback_subscriptions=c("arrival") == WINBACK,
            reacquisition_subscriptions=c("arrival") == REACQUISITION,
            renewal_subscriptions=c("arrival") == RENEWED,
            minutes=c("minutes_of_usage"),
        ),
        change(after_paying, None, lapsed, paying_subscriptions=less, grace_subscriptions=one),
        change(
            F.least("next_day", after_grace), None, lapsed,
            grace_subscriptions=less, subscription_churn=churned,
        ),
        change(after_retention, None, c("next_day") > after_retention, state_rows=less),
        change(
            day, subscriber, F.greatest(added, *starts_viewing.values()),
            active=added, added=added, **starts_viewing,
        ),
        change(after_grace, subscriber, churned, active=less),
        *[
            change(
                c("viewer_day") + n, subscriber,
                c("viewed_next").isNull() | (c("viewed_next") > c("viewer_day") + n),
                **{f"viewing_{w}": less},
            )
            for w, n in windows.items()
        ],
    ]
    return (
        spans.select("opco_code", F.explode(F.array(*happenings)).alias("change"))
        .where(F.col("change").isNotNull())
        .select("opco_code", "change.*")
        .where(F.col("day").isNotNull())
    )
