"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the
input and the local cores. Every query is computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from subtide.plans.queries import QUERIES, orders_inputs  # noqa: E402

HEADLINE = [
    "subscription_daily",
    "lifecycle_event_rows",
    "kpi_daily",
    "kpi_reporting_view",
    "state_asof",
    "state_totals_per_day",
    "state_step",
    "upsert_snapshot_halves",
    "check_suite_events",
    "stored_reporting_view",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="subtide-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("subtide-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    queries = {name: QUERIES[name] for name in HEADLINE}
    # The state table itself, arrays included: every row is built.
    queries["state_bulk_with_arrays"] = lambda s, d: orders_inputs(s, d).states()
    small = str(Path(sf_dir).parent / "sf0.001")
    run(queries["kpi_daily"](spark, small if Path(small).exists() else sf_dir))
    seconds = {}
    for name, query in queries.items():
        start = time.perf_counter()
        run(query(spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
