"""Clock strings (HHMM) and schedule times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_number(hhmm: Column) -> Column:
    """A clock string as the integer HHMM, NULL when it is NULL or blank.

    Everything but digits is ignored and the first four digits count: ``5`` is 00:05,
    ``6:10`` is 06:10, ``12345`` is 12:34, text without digits is midnight.
    """
    digits = F.left(F.regexp_replace(hhmm, "[^0-9]", ""), F.lit(4))
    return F.when(F.trim(hhmm) != "", F.coalesce(digits.try_cast("int"), F.lit(0)))


def clock_time(day: Column, number: Column) -> Column:
    """The wall-clock time HHMM on ``day``; hours over 23 and minutes over 59 give NULL.

    ``number`` is used several times: pass a column, not a long expression.
    """
    hour, minute = (number / 100).cast("int"), number % 100
    return F.when(
        (number < 2400) & (minute < 60),
        F.try_make_timestamp(
            F.year(day), F.month(day), F.dayofmonth(day), hour, minute, F.lit(0).cast("decimal(16,6)")
        ),
    )


def not_before(moment: Column, start: Column) -> Column:
    """``moment``, moved to the next day when it lies before ``start``."""
    return F.when(moment < start, moment + F.expr("INTERVAL 1 DAY")).otherwise(moment)


def departure_after_delay(actual: Column, scheduled: Column, delay_minutes: Column) -> Column:
    """Opt-in reading of a departure after midnight: a late departure that appears to
    lie before its schedule belongs to the next day."""
    return F.when(
        (delay_minutes > 0) & (actual < scheduled), actual + F.expr("INTERVAL 1 DAY")
    ).otherwise(actual)
