"""Snapshot inputs derived from the retail and event tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.config import LifecycleConfig
from subtide.schemas import RAW_SNAPSHOT, SUBSCRIPTION_SNAPSHOT

# Orders as long subscriptions: the default thresholds apply.
ORDERS_CONFIG = LifecycleConfig()

# Events as short subscriptions; where gaps are asked for, with days on which no feed arrived.
EVENTS_MISSING = [date(2024, 1, 10), date(2024, 1, 11), date(2024, 1, 20)]
EVENTS_CONFIG = LifecycleConfig(array_size=7, grace_days=2, winback_days=4, retention_days=9)


def window_of(feed: DataFrame) -> tuple[date, date]:
    """The first and the last feed date."""
    return tuple(feed.agg(F.min("snapshot_date"), F.max("snapshot_date")).first())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders in a line status, as snapshots of one subscription."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linestatus", "l_shipdate", "l_quantity"
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # region and nation are fixed lists; the optimizer broadcasts them by their size.
    places = (
        read_table(spark, sf_dir, "nation")
        .join(read_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    shipped = F.to_date("l_shipdate")
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("r_name").alias("opco_code"),
            F.col("o_custkey").cast("string").alias("subscriber_id"),
            F.col("l_linestatus").alias("subscription_name"),
            F.col("l_orderkey").cast("string").alias("subscription_id"),
            F.to_date("o_orderdate").alias("subscription_start_date"),
            F.date_add(shipped, 30).alias("subscription_end_date"),
            F.greatest(F.col("l_quantity") - 10, F.lit(0)).cast("double").alias("minutes_of_usage"),
            shipped.alias("snapshot_date"),
        )
        .select(*SUBSCRIPTION_SNAPSHOT.names)
    )


def order_feed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed calendar of `order_snapshots` from one column of one table.

    Every line belongs to an order, a customer and a nation, so the joins of the
    snapshot cannot take a date away.
    """
    return (
        read_table(spark, sf_dir, "lineitem")
        .select(F.to_date("l_shipdate").alias("snapshot_date"))
        .where(F.col("snapshot_date").isNotNull())
        .distinct()
    )


def event_opco() -> Column:
    return F.when(F.col("user_id") % 2 == 0, "OP0").otherwise("OP1")


def event_snapshots(
    spark: SparkSession, sf_dir: str, with_gaps: bool | str = False, minutes: Column | None = None
) -> DataFrame:
    """A user's events of one type, as snapshots of one subscription.

    `with_gaps` takes the feed of EVENTS_MISSING away, of all opcos or of the one it names, for what is about
    days without feed.
    """
    minutes = F.floor("value") if minutes is None else minutes
    day = F.to_date("ts")
    events = read_table(spark, sf_dir, "events")
    if with_gaps:
        missing = day.isin(EVENTS_MISSING)
        events = events.where(~(missing & (event_opco() == with_gaps) if isinstance(with_gaps, str) else missing))
    return events.select(
        event_opco().alias("opco_code"),
        F.col("user_id").cast("string").alias("subscriber_id"),
        F.col("event_type").alias("subscription_name"),
        F.floor(F.col("event_id").cast("long") / 1000).cast("long").cast("string").alias("subscription_id"),
        day.alias("subscription_start_date"),
        F.date_add(day, 5).alias("subscription_end_date"),
        minutes.cast("double").alias("minutes_of_usage"),
        day.alias("snapshot_date"),
    ).select(*SUBSCRIPTION_SNAPSHOT.names)


def event_feed_dates(spark: SparkSession, sf_dir: str, with_gaps: bool | str = False, by: list[str] = []) -> DataFrame:
    return event_snapshots(spark, sf_dir, with_gaps).select(*by, "snapshot_date").distinct()


def event_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a delivered file: all strings, some values missing or unreadable.

    The product name is free text with quotes and commas.
    """
    n, day = F.col("event_id").cast("long"), F.to_date("ts")
    slashed = F.concat_ws("/", F.month(day).cast("string"), F.day(day).cast("string"), F.year(day).cast("string"))
    thousandths = F.lpad((n % 1000).cast("string"), 3, "0")
    return read_table(spark, sf_dir, "events").select(
        F.when(n % 103 == 5, "unknown").when(n % 107 == 1, day.cast("string")).otherwise(slashed).alias("snapshot_date"),
        F.floor(n / 1000).cast("long").cast("string").alias("subscription_id"),
        F.concat("event_type", F.lit(", "), "props").alias("subscription_name"),
        F.col("user_id").cast("string").alias("subscriber_id"),
        slashed.alias("subscription_start_date"),
        F.when(n % 109 == 2, "n/a").when(n % 5 != 0, slashed).alias("subscription_end_date"),
        F.when(n % 101 == 3, "many")
        .when(n % 50 != 7, F.concat((n % 300).cast("string"), F.lit("."), thousandths))
        .alias("minutes_of_usage"),
    ).select(*RAW_SNAPSHOT.names)
