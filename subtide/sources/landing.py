"""Raw subscriber files -> typed snapshot rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from subtide.schemas import RAW_SNAPSHOT, SUBSCRIPTION_SNAPSHOT

# The date formats a landing file may use, in order of preference.
DATE_FORMATS = ["M/d/yyyy", "yyyy-MM-dd"]

MOST_MINUTES = 10**9  # of a row, either way; trailing sums of that many stay exact

JAGGED = "jagged_line"  # a line with too few or too many values, else null


def read_raw_snapshots(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files under a path or glob: one header row, comma, double quotes, all strings.

    A line with too few or too many values is delivered whole in `snapshot_date`, all else null, and
    so is rejected for its columns.
    """
    schema = StructType([*RAW_SNAPSHOT.fields, StructField(JAGGED, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": JAGGED, "columnPruning": False}
    read = spark.read.options(**options).csv(path, schema=schema, header=True, sep=",", quote='"', escape='"')
    even = F.col(JAGGED).isNull()
    rest = [F.when(even, F.col(c)).alias(c) for c in RAW_SNAPSHOT.names if c != "snapshot_date"]
    return read.select(F.coalesce(JAGGED, "snapshot_date").alias("snapshot_date"), *rest).select(*RAW_SNAPSHOT.names)


def parse_date(column: str) -> Column:
    return F.coalesce(*[F.try_to_date(F.col(column), fmt) for fmt in DATE_FORMATS])


def parse_raw(raw: DataFrame, opco: str) -> DataFrame:
    """Snapshot columns, the raw columns as raw_*, and the first column that is unreadable, if any."""
    dates = ["snapshot_date", "subscription_start_date", "subscription_end_date"]
    named = raw.select(*[F.col(c).alias(f"raw_{c}") for c in RAW_SNAPSHOT.names])
    minutes = F.col("raw_minutes_of_usage")
    typed = named.withColumns(
        {
            **{c: parse_date(f"raw_{c}") for c in dates},
            **{c: F.col(f"raw_{c}") for c in ["subscription_id", "subscription_name", "subscriber_id"]},
            "opco_code": F.lit(opco),
            "exact_minutes": minutes.try_cast("decimal(38,9)"),
        }
    )
    unread = lambda c: F.col(f"raw_{c}").isNotNull() & F.col(c).isNull()
    return typed.withColumns(
        {
            # An empty value means nothing was watched.
            "minutes_of_usage": F.coalesce(F.round("exact_minutes", 2).cast("double"), F.lit(0.0)),
            "reject_reason": F.when(F.col("snapshot_date").isNull() & F.contains("raw_snapshot_date", F.lit(",")), "columns")
            .when(F.col("snapshot_date").isNull(), "snapshot_date")
            .when(unread("subscription_start_date"), "subscription_start_date")
            .when(unread("subscription_end_date"), "subscription_end_date")
            .when(minutes.isNotNull() & F.col("exact_minutes").isNull(), "minutes_of_usage")
            .when(F.abs("exact_minutes") > MOST_MINUTES, "minutes_of_usage"),
        }
    )


def missing_key() -> Column:
    """Why a readable row of `parse_raw` has no key to be upserted by, if it has none."""
    keys = ["opco_code", "subscriber_id", "subscription_id"]
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in keys])


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).select(*SUBSCRIPTION_SNAPSHOT.names)


def as_delivered(parsed: DataFrame, *more: str | Column) -> DataFrame:
    """The raw columns of rows of `parse_raw`, and `more`."""
    return parsed.select(*[F.col(f"raw_{c}").alias(c) for c in RAW_SNAPSHOT.names], *more)


def normalize_raw(raw: DataFrame, opco: str) -> DataFrame:
    """Typed snapshot rows of one operating company; unreadable rows are left to `rejected_raw`."""
    return accepted(parse_raw(raw, opco))


def landing_view(raw: DataFrame, opco: str) -> DataFrame:
    """Every delivered row: what can be read of it, and the first column that can't, if any."""
    return parse_raw(raw, opco).select(*SUBSCRIPTION_SNAPSHOT.names, "reject_reason")


def rejected_raw(raw: DataFrame) -> DataFrame:
    """The rows `normalize_raw` leaves out, as delivered, with the first column that is unreadable."""
    return as_delivered(parse_raw(raw, "").where(F.col("reject_reason").isNotNull()), "reject_reason")
