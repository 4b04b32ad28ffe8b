"""Golden events: the lifecycle events that check T12 expects, from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from subtide.operators.events import EVENT_FLAGS
from subtide.schemas import TEST_EXPECTED_EVENTS
from subtide.sources.landing import parse_date


def read_golden_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files with a header: subscriber_id, event_date, event_type, all strings."""
    schema = StructType([StructField(c, StringType()) for c in TEST_EXPECTED_EVENTS.names])
    return spark.read.csv(path, schema=schema, header=True, sep=",", quote='"', escape='"')


def parse_golden_events(raw: DataFrame) -> DataFrame:
    """Typed events with the raw columns as raw_*, and the first column that is missing or unreadable, if any."""
    named = raw.select(*[F.col(c).alias(f"raw_{c}") for c in TEST_EXPECTED_EVENTS.names])
    return named.select(
        "*",
        F.col("raw_subscriber_id").alias("subscriber_id"),
        parse_date("raw_event_date").alias("event_date"),
        F.upper(F.trim("raw_event_type")).alias("event_type"),
    ).withColumn(
        "reject_reason",
        F.when(F.col("subscriber_id").isNull(), "subscriber_id")
        .when(F.col("event_date").isNull(), "event_date")
        .when(~F.coalesce(F.col("event_type").isin(*EVENT_FLAGS), F.lit(False)), "event_type"),
    )


def golden_events(raw: DataFrame) -> DataFrame:
    """The events that can be read; the others are left to `rejected_golden_events`."""
    return parse_golden_events(raw).where("reject_reason IS NULL").select(*TEST_EXPECTED_EVENTS.names)


def rejected_golden_events(raw: DataFrame) -> DataFrame:
    bad = parse_golden_events(raw).where("reject_reason IS NOT NULL")
    return bad.select(*[F.col(f"raw_{c}").alias(c) for c in TEST_EXPECTED_EVENTS.names], "reject_reason")
