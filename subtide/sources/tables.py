"""The pipeline tables: Parquet, one partition per day, replaced by date range."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide import schemas
from subtide.operators.daily import in_range
from subtide.sources.scratch import delete_folder, make_folder


@dataclass(frozen=True)
class Layout:
    schema: T.StructType
    partition: str | None
    bucketed: bool = False
    derived: tuple[str, str] | None = None  # partition column computed on write
    within: str | None = None  # a second partition column


LAYOUTS = {
    "subscription_snapshot_daily": Layout(schemas.SUBSCRIPTION_SNAPSHOT, "snapshot_date"),
    "subscription_daily": Layout(schemas.SUBSCRIPTION_DAILY, "snapshot_date", bucketed=True),
    "subscription_cumulated": Layout(schemas.SUBSCRIPTION_CUMULATED, "snapshot_date", bucketed=True),
    "ott_kpi_daily": Layout(schemas.OTT_KPI_DAILY, "snapshot_date"),
    "etl_run_log": Layout(schemas.ETL_RUN_LOG, "run_date", derived=("run_date", "run_ts")),
    "test_results": Layout(schemas.TEST_RESULTS, "run_date", derived=("run_date", "test_run_ts"), within="run_id"),
    "test_expected_events": Layout(schemas.TEST_EXPECTED_EVENTS, "event_date"),
    "landing_rejects": Layout(schemas.LANDING_REJECTS, "load_id"),
}
BUCKET_KEY = "subscription_key"
OPEN_FILES = 8  # per task; each one buffers a row group


class Warehouse:
    """Tables under one root folder, registered in one catalog database.

    The daily and the state table are bucketed on subscription_key with the same
    number of buckets, so the daily step (yesterday joined with today), the bulk
    build and the checks on the key read them without a shuffle.
    """

    def __init__(
        self, spark: SparkSession, root: str, database: str = "subtide", buckets: int | None = None
    ) -> None:
        self.spark, self.root, self.database = spark, root.rstrip("/"), database
        self.buckets = self._bucket_count(buckets)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, layout in LAYOUTS.items():
            if not spark.catalog.tableExists(f"{database}.{name}"):
                self._create(name, layout)

    def _bucket_count(self, wanted: int | None) -> int:
        """Buckets cannot change once files exist, so the number is kept with them."""
        path = f"{self.root}/layout"
        try:
            stored = self.spark.read.schema("buckets INT").json(path).first()["buckets"]
            if wanted and wanted != stored:
                warnings.warn(f"the tables under {self.root} have {stored} buckets and keep them; {wanted} is ignored", stacklevel=3)
            return stored
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            count = wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self.spark.range(1).select(F.lit(count).alias("buckets")).write.json(path)
            return count

    def _create(self, name: str, layout: Layout) -> None:
        columns = [f"{f.name} {f.dataType.simpleString()}" for f in layout.schema]
        if layout.derived:
            columns.append(f"{layout.partition} date")
        sql = f"CREATE TABLE {self.database}.{name} ({', '.join(columns)}) USING parquet"
        if layout.partition:
            sql += f" PARTITIONED BY ({', '.join(filter(None, [layout.partition, layout.within]))})"
        if layout.bucketed:
            # No SORTED BY: rows reach the writer in key order anyway, and without it
            # a wide state row need not be sorted again to be written.
            sql += f" CLUSTERED BY ({BUCKET_KEY}) INTO {self.buckets} BUCKETS"
        location = f"{self.root}/{name}"
        self.spark.sql(f"{sql} LOCATION '{location}'")
        if layout.partition:
            make_folder(self.spark, location)
            # Files of an earlier session, when the catalog does not outlive it.
            self.spark.sql(f"ALTER TABLE {self.database}.{name} RECOVER PARTITIONS")

    def drop(self) -> None:
        """Forget the tables in the catalog; the files stay."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def read(self, name: str, start: date, end: date | None = None) -> DataFrame:
        """Rows of a date range. There is no way to read a daily table without one."""
        return in_range(self.table(name), start, end or start, LAYOUTS[name].partition)

    def partitions(self, name: str) -> list[date]:
        """Dates that have a partition, ascending; at most one entry per calendar day."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.database}.{name}").collect()
        return sorted({date.fromisoformat(row[0].split("/", 1)[0].split("=", 1)[1]) for row in rows})

    def has_partition(self, name: str, value: str) -> bool:
        rows = self.spark.sql(f"SHOW PARTITIONS {self.database}.{name} PARTITION ({LAYOUTS[name].partition} = '{value}')")
        return not rows.isEmpty()

    def replace_range(self, name: str, df: DataFrame, start: date, end: date | None = None) -> int:
        """Make `df` the whole content of the dates start..end; returns the rows written.

        The job's commit swaps the dates in one after the other; then all dates that end up without rows
        are dropped together, without another job. A run that fails before has changed nothing; one that
        fails meanwhile is repeated. Where a rename is a copy, as in object stores, a date isn't swapped
        in at once.
        """
        end = end or start
        rows, dates = self._overwrite(name, df)
        self._drop(name, [d for d in self.partitions(name) if start <= d <= end and d not in dates])
        return rows

    def replace_touched(self, name: str, df: DataFrame) -> int:
        """Replace exactly the dates that occur in `df`; returns the rows written."""
        return self._overwrite(name, df)[0]

    def replace_day(self, name: str, df: DataFrame, day: date) -> int:
        return self.replace_range(name, df, day, day)

    def replace_partition(self, name: str, value: str, df: DataFrame) -> int:
        """Make `df` the whole content of the partition `value` of a table that isn't partitioned by date."""
        rows, values = self._overwrite(name, df)
        if set(values) - {value}:
            raise ValueError(f"rows of other partitions than {value!r}")
        if not rows:
            self._drop(name, [value])
        return rows

    def append(self, name: str, df: DataFrame) -> None:
        self._in_table_order(name, df).write.insertInto(f"{self.database}.{name}", overwrite=False)

    def replace_all(self, name: str, df: DataFrame) -> None:
        """Replace the whole table."""
        self._in_table_order(name, df).write.insertInto(f"{self.database}.{name}", overwrite=True)

    def _in_table_order(self, name: str, df: DataFrame) -> DataFrame:
        """Columns by name in table order, with NOT NULL checked and the partition column last."""
        layout = LAYOUTS[name]
        columns = []
        for f in layout.schema:
            column = F.col(f.name)
            if not f.nullable:
                missing = F.raise_error(F.lit(f"{name}.{f.name} must not be NULL")).cast(f.dataType)
                column = F.coalesce(column, missing)
            columns.append(column.cast(f.dataType).alias(f.name))
        if layout.derived:
            target, source = layout.derived
            columns.append(F.to_date(source).alias(target))
        last = [c for c in (layout.partition, layout.within) if c]
        names = [c for c in layout.schema.names if c not in last]
        return df.select(*columns).select(*names, *last)

    def _overwrite(self, name: str, df: DataFrame) -> tuple[int, list[date]]:
        metrics = Observation()
        observed = self._in_table_order(name, df).observe(
            metrics,
            F.count(F.lit(1)).alias("rows"),
            F.collect_set(LAYOUTS[name].partition).alias("dates"),  # at most one per calendar day, or one load
        )
        with self._replacing_partitions():
            observed.write.insertInto(f"{self.database}.{name}", overwrite=True)
        return metrics.get["rows"], metrics.get["dates"]

    def _drop(self, name: str, values: list[date] | list[str]) -> None:
        """Take partitions away: first their files, so that a run that stops here leaves them empty, then all
        of them from the catalog by one statement."""
        partition = LAYOUTS[name].partition
        if values:
            for value in values:
                literal = f"DATE'{value}'" if isinstance(value, date) else f"'{value}'"
                about = self.spark.sql(f"DESCRIBE EXTENDED {self.database}.{name} PARTITION ({partition} = {literal})").collect()
                delete_folder(self.spark, next(row["data_type"] for row in about if row["col_name"] == "Location"))
            listed = ", ".join(f"PARTITION ({partition} = '{value}')" for value in values)
            self.spark.sql(f"ALTER TABLE {self.database}.{name} DROP IF EXISTS {listed}")

    @contextmanager
    def _replacing_partitions(self) -> Iterator[None]:
        """Overwrite only the partitions that receive rows, not the table.

        A task that writes to few files keeps them all open instead of sorting its
        rows by file first; beyond that number it sorts.
        """
        settings = {
            "spark.sql.sources.partitionOverwriteMode": "dynamic",
            "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES),
        }
        before = {key: self.spark.conf.get(key) for key in settings}
        try:
            for key, value in settings.items():
                self.spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                self.spark.conf.set(key, value)


def day_before(day: date) -> date:
    return day - timedelta(days=1)
