"""Command line of the jobs, for spark-submit and for a scheduler.

    python -m subtide --root /data/subtide load /landing/day=*/ --opco OPX
    python -m subtide --root /data/subtide backfill 2024-04-01 2024-04-01
    python -m subtide --root /data/subtide repair 2024-03-10 2024-03-12
    python -m subtide --root /data/subtide golden /golden/*.csv --start 2024-04-01 --end 2024-04-30
    python -m subtide --root /data/subtide validate 2024-04-01 2024-04-30
"""

from __future__ import annotations

import argparse
from dataclasses import fields
from datetime import date

from pyspark.sql import SparkSession

from subtide.config import LifecycleConfig
from subtide.plans.pipeline import backfill, load_golden_events, load_snapshots, repair, validate
from subtide.sources.golden import read_golden_events
from subtide.sources.landing import read_raw_snapshots
from subtide.sources.tables import Warehouse

THRESHOLDS = [(f.name, type(f.default)) for f in fields(LifecycleConfig)]


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="subtide")
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--database", default="subtide")
    parser.add_argument("--buckets", type=int, help="only used when the tables are created")
    for name, kind in THRESHOLDS:
        parser.add_argument(f"--{name.replace('_', '-')}", type=kind, default=getattr(LifecycleConfig, name))
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("load", help="upsert landing files into the snapshot table")
    load.add_argument("path")
    load.add_argument("--opco", required=True)
    load.add_argument("--load-id", help="names the load's rejects; a new one if not given")
    golden = jobs.add_parser("golden", help="store the events that validate expects")
    golden.add_argument("path")
    golden.add_argument("--start", type=date.fromisoformat, help="replace the events of a whole range of dates")
    golden.add_argument("--end", type=date.fromisoformat)
    for job in (load, golden):
        job.add_argument("--allow-rejects", action="store_true", help="load the other rows if some can't be read")
    helps = {
        "backfill": "daily rows, state and KPIs of a range",
        "repair": "redo corrected dates, and what follows from them up to the latest date",
        "validate": "run the twelve checks; fails if one does",
    }
    for name, text in helps.items():
        job = jobs.add_parser(name, help=text)
        job.add_argument("start", type=date.fromisoformat)
        job.add_argument("end", type=date.fromisoformat)
        if name == "backfill":
            job.add_argument("--mode", choices=["bulk", "step"], default="bulk", help="one job per table, or day by day; the rows are the same")
            job.add_argument("--allow-cold-start", action="store_true", help="step: begin without the state of the day before")
            job.add_argument("--kpi-source", choices=["state", "daily"], default="state")
        if name == "validate":
            job.add_argument("--run-id", default="default", help="results of other runs of the day stay")
            job.add_argument("--tolerate-feed-gaps", action="store_true", help="leave days without feed out of T04")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"subtide-{args.job}").getOrCreate()
    warehouse = Warehouse(spark, args.root, args.database, args.buckets)
    cfg = LifecycleConfig(**{name: getattr(args, name) for name, _ in THRESHOLDS})
    if args.job == "load":
        load_snapshots(warehouse, read_raw_snapshots(spark, args.path), args.opco, args.allow_rejects, args.load_id)
    elif args.job == "golden":
        load_golden_events(warehouse, read_golden_events(spark, args.path), args.start, args.end, args.allow_rejects)
    elif args.job == "backfill":
        backfill(warehouse, args.start, args.end, cfg, args.mode, args.allow_cold_start, args.kpi_source)
    elif args.job == "repair":
        repair(warehouse, args.start, args.end, cfg)
    else:
        validate(warehouse, args.start, args.end, cfg, run_id=args.run_id, tolerate_feed_gaps=args.tolerate_feed_gaps)


if __name__ == "__main__":
    main()
