"""Run registered queries next to their SQL and compare the results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
)


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    """None if equal, else what differs; also the seconds both took."""
    t0 = time.time()
    df = query(spark, sf_dir)
    actual = [tuple(r) for r in df.collect()]
    t1 = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    t2 = time.time()
    problem = None
    if sorted(df.columns) != sorted(names):
        problem = f"columns {sorted(set(df.columns) ^ set(names))}"
    else:
        a, b = rows_of(df.columns, actual), rows_of(names, expected)
        if len(a) != len(b):
            problem = f"{len(a)} rows, expected {len(b)}"
        elif a != b:
            bad = [(x, y) for x, y in zip(a, b) if x != y]
            problem = f"{len(bad)} rows differ, first {bad[0]} of {sorted(df.columns)}"
    return problem, len(actual), t1 - t0, t2 - t1


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        try:
            problem, rows, spark_s, sql_s = compare(spark, con, name, query, oracles[name], sf_dir)
            print(f"{'ok ' if problem is None else 'BAD'} {name} rows={rows} {spark_s:.1f}s sql={sql_s:.1f}s {problem or ''}"[:600], flush=True)
        except Exception as error:  # noqa: BLE001
            print(f"ERR {name} {str(error)[:500]}", flush=True)
