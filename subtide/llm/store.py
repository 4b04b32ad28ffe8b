"""Tables between the jobs of an operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.sources.scratch import scratch_folder


BROADCAST_ROWS = 2_000_000  # of one long column; about 64 MB as a hash table


def broadcast_if_small(keys: DataFrame) -> DataFrame:
    """A stored table of one long column, sent to all executors if it has up to BROADCAST_ROWS rows.

    Beyond that it is left to the planner, which shuffles both sides of the join.
    """
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def stored(df: DataFrame) -> DataFrame:
    """`df` written to the cluster's shared folder and read from there.

    It is computed once, outlives lost executors, cuts the lineage, and its size is known to
    the planner, so that joins broadcast it only if it is small.
    """
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def all_columns(df: DataFrame) -> list[Column]:
    """The columns of `df`, also those with a dot or a backtick in their names."""
    return [F.col(quoted(name)) for name in df.columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
