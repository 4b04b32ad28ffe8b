"""Column expressions shared by the operators. All of them stay on the JVM."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (a NULL condition counts as not holding)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")


def day_number(value: str | Column) -> Column:
    """Days since 1970-01-01, so that day arithmetic is integer arithmetic."""
    return F.unix_date(value)


def to_day(number: Column) -> Column:
    return F.date_from_unix_date(number.cast("int"))


def epoch_day(value: date) -> int:
    return (value - date(1970, 1, 1)).days


WORD_DAYS = 64


def day_word(day: Column) -> Column:
    """Which word of 64 days a day number belongs to."""
    return F.shiftright(day, 6)


def bit_of(day: Column) -> Column:
    """The bit of a day number in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), day.bitwiseAND(F.lit(WORD_DAYS - 1)))


PARTS = 1_000_000  # of a minute


def minute_parts(minutes: str | Column) -> Column:
    """Minutes as a whole number of parts. Sums and differences of them are exact in any order.

    A value beyond the range of a long number raises.
    """
    minutes = F.col(minutes) if isinstance(minutes, str) else minutes
    return F.round(minutes * PARTS).cast("long")


def whole_minutes(parts: Column) -> Column:
    return parts / F.lit(float(PARTS))
