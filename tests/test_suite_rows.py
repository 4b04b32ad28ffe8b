"""Which state rows the check suite keeps, and how it finds repeated days."""

from contextlib import contextmanager
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from subtide.operators.checks import Tables, _repeated, check_t02, check_t07, check_t08, check_t12, checked_state, marked_rows
from subtide.plans import queries
from tests.test_suite_state import CFG, END, START, inputs  # noqa: F401


def test_suite_stores_no_idle_state_rows(inputs, monkeypatch):  # noqa: F811
    stored, written = [], queries.written

    @contextmanager
    def noted(df):
        with written(df) as kept:
            stored.append(kept.count())
            yield kept

    monkeypatch.setattr(queries, "written", noted)
    assert [r.status for r in queries._suite_of(inputs).collect()] == ["PASS"] * 12
    states = inputs.states()
    assert max(stored) < states.count()
    assert marked_rows(states, START, END).count() in stored


def test_checks_of_marked_rows_equal_checks_of_all_rows(inputs):  # noqa: F811
    tables = queries._healthy(inputs)
    broken = tables.cumulated.withColumns(
        {
            "mou_1d": F.when(F.col("subscriber_id") != "b", F.col("mou_1d")) + F.col("is_addition"),
            "mou_30d": F.col("mou_30d") + F.col("is_churned"),
            "is_renewal_event": F.when(F.col("subscriber_id") == "a", F.lit(2).cast("long")).otherwise(F.col("is_renewal_event")),
            "is_churn_event": F.when(F.col("subscriber_id") != "c", F.col("is_churn_event")),
        }
    )
    marked = marked_rows(checked_state(broken), START, END)
    for check in (check_t07, check_t08, check_t12):
        rows = [
            check(Tables(tables.bronze, tables.daily, broken, tables.expected_events, kept), START, END, CFG).collect()
            for kept in (None, marked)
        ]
        assert rows[0] == rows[1]
        assert rows[0][0].bad > 0


@pytest.mark.parametrize("copies", [1, 2, 3, 5])
def test_repeated_days_are_all_counted(spark, copies):
    days = [date(1969, 12, 30), date(1970, 1, 1), date(2024, 1, 1), date(2024, 3, 4), date(2024, 3, 5)]
    rows = [(key, day) for key in ("a", "b", None) for day in days]
    more = [("a", days[0]), ("b", days[3]), (None, days[2])] * (copies - 1)
    late = [("a", END + timedelta(days=900))] * 2  # out of the range
    states = spark.createDataFrame(rows + more + late, "subscription_key string, snapshot_date date")
    tables = Tables(states, states, states, states)
    assert _repeated(states, days[0], days[-1]) == (copies > 1)
    [found] = check_t02(tables, days[0], days[-1], CFG).collect()
    assert (found.bad, found.detail) == (3 if copies > 1 else 0, None)


def test_no_state_rows_repeat_no_day(spark):
    none = spark.createDataFrame([], "subscription_key string, snapshot_date date")
    assert not _repeated(none, START, END)
