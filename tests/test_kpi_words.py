"""KPIs from state rows: subscribers are counted from bits of 64 days."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from subtide.operators.kpi import _SUBSCRIBER_FLAGS, _SUMS, _told, build_kpi_daily

START = date(1969, 11, 20)  # day numbers on both sides of zero
FLAGS = sorted({c for c in [*_SUMS.values(), *_SUBSCRIBER_FLAGS.values()] if c.startswith("is_")})
MINUTES = ["mou_1d", "mou_7d", "mou_30d"]
SCHEMA = "opco_code string, subscriber_id string, snapshot_date date, " + ", ".join(
    [*[f"{c} long" for c in FLAGS], *[f"{c} double" for c in MINUTES]]
)


def state_rows(seed):
    """Some subscriptions of each subscriber; days on which an opco has no row; repeated and missing subscribers."""
    rand = random.Random(seed)
    rows = []
    for opco in ("A", "B", None):
        for who in ("x", "y", "z", None):
            for _ in range(rand.randint(1, 3)):
                on = {c: rand.random() < 0.5 for c in FLAGS}
                for d in range(rand.randint(0, 30), rand.randint(60, 200)):
                    on = {c: (not v if rand.random() < 0.1 else v) for c, v in on.items()}
                    if d % 37 == 5 and opco == "A" or rand.random() < 0.05:
                        continue
                    minutes = [float(rand.randint(0, 9)) for _ in MINUTES]
                    rows.append((opco, who, START + timedelta(days=d), *[int(on[c]) for c in FLAGS], *minutes))
    return rows


def plain(rows):
    """(opco, day) -> KPI -> value."""
    names = ["opco_code", "subscriber_id", "snapshot_date", *FLAGS, *MINUTES]
    days = {}
    for row in (dict(zip(names, r)) for r in rows):
        days.setdefault((row["opco_code"], row["snapshot_date"]), []).append(row)
    found = {}
    for at, group in days.items():
        of = {name: {r["subscriber_id"] for r in group if r[c] == 1} for name, c in _SUBSCRIBER_FLAGS.items()}
        of["subscriber_churn"] -= of["active_subscribers"]
        found[at] = {name: sum(r[c] for r in group) for name, c in _SUMS.items()} | {n: len(w) for n, w in of.items()}
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_kpis_equal_plain_counts(spark, seed):
    rows = state_rows(seed)
    start, end = START + timedelta(days=3), START + timedelta(days=190)
    kpis = build_kpi_daily(spark.createDataFrame(rows, SCHEMA), start, end).collect()
    expected = plain([r for r in rows if start <= r[2] <= end])
    assert {(r.opco_code, r.snapshot_date): {n: r[n] for n in expected[r.opco_code, r.snapshot_date]} for r in kpis} == expected
    assert len(kpis) == len(expected)


def test_a_subscriber_is_one_row_per_word_of_days(spark):
    rows = [("A", "x", START + timedelta(days=d), *[1] * len(FLAGS), 1.0, 1.0, 1.0) for d in range(128)] * 2
    told = _told(spark.createDataFrame(rows, SCHEMA), START, START + timedelta(days=127))
    counts = {r.of_subscriber: r["count"] for r in told.groupBy("of_subscriber").count().collect()}
    assert counts == {False: 128, True: 3}
