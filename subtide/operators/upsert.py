"""Upsert of snapshot rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.schemas import SUBSCRIPTION_SNAPSHOT

SNAPSHOT_KEYS = ["snapshot_date", "opco_code", "subscriber_id", "subscription_id"]


def upsert_snapshots(bronze: DataFrame, source: DataFrame) -> DataFrame:
    """`bronze` with every row of `source` updated or inserted.

    An update sets all columns outside the key, so the updated row is the source
    row: what stays of `bronze` is what has no match. Columns go by name. Missing
    key parts count as equal, so that loading the same file twice changes nothing.
    """
    keys = source.select(*[F.col(k).alias(f"source_{k}") for k in SNAPSHOT_KEYS])
    matched = [F.col(k).eqNullSafe(F.col(f"source_{k}")) for k in SNAPSHOT_KEYS]
    kept = bronze.join(keys, matched, "left_anti")
    names = SUBSCRIPTION_SNAPSHOT.names
    return kept.select(*names).unionByName(source.select(*names))


def duplicate_keys(source: DataFrame) -> DataFrame:
    """Keys that occur more than once; an upsert from such a source has no defined result."""
    return source.groupBy(*SNAPSHOT_KEYS).count().where(F.col("count") > 1)
