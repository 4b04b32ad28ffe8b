"""Run log: one row per load, whether it worked, was skipped or failed."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timezone
from time import monotonic

from subtide.schemas import ETL_RUN_LOG
from subtide.sources.tables import Warehouse

SUCCESS, SKIPPED, FAILED = "SUCCESS", "SKIPPED", "FAILED"


@dataclass
class Run:
    """What a load reports about itself."""

    rows: int = 0
    status: str = SUCCESS
    message: str | None = None


class LoadFailed(RuntimeError):
    """A load failed; the run log has the message."""


@contextmanager
def logged(warehouse: Warehouse, proc_name: str, ds: date) -> Iterator[Run]:
    """Log the load in the body after its data is committed; log and re-raise a failure."""
    run, started, clock = Run(), datetime.now(timezone.utc), monotonic()
    try:
        yield run
    except Exception as error:
        log_run(warehouse, started, proc_name, ds, 0, FAILED, str(error), monotonic() - clock)
        raise LoadFailed(f"{proc_name} failed for {ds}: {error}") from error
    log_run(warehouse, started, proc_name, ds, run.rows, run.status, run.message, monotonic() - clock)


def log_run(
    warehouse: Warehouse,
    run_ts: datetime,
    proc_name: str,
    ds: date,
    rows_affected: int,
    status: str,
    message: str | None,
    duration_sec: float,
) -> None:
    row = (run_ts, proc_name, ds, rows_affected, status, message, round(duration_sec, 3))
    warehouse.append("etl_run_log", warehouse.spark.createDataFrame([row], ETL_RUN_LOG).coalesce(1))
