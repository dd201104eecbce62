"""Calendar features of a date or hour."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The holidays (month, day) and the bounds of the buckets.
HOLIDAYS = (
    (1, 1), (1, 15), (2, 19), (5, 27), (7, 4),
    (9, 2), (11, 11), (11, 28), (12, 25), (12, 26),
)
HOUR_BUCKETS = (("red_eye", 0, 4), ("morning", 5, 11), ("afternoon", 12, 17))
LAST_HOUR_BUCKET = "evening"
SEASONS = (("winter", (12, 1, 2)), ("spring", (3, 4, 5)), ("summer", (6, 7, 8)))
LAST_SEASON = "autumn"
SATURDAY, SUNDAY = 7, 1  # dayofweek() counts from Sunday


def first_match(cases: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first condition that holds, else ``default``."""
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default)) if chain is not F else F.lit(default)


def hour_bucket(hour: Column) -> Column:
    return first_match(
        ((hour.between(low, high), name) for name, low, high in HOUR_BUCKETS), LAST_HOUR_BUCKET
    )


def season(month: Column) -> Column:
    return first_match(((month.isin(*months), name) for name, months in SEASONS), LAST_SEASON)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(SATURDAY, SUNDAY)


def is_holiday(day: Column, holidays: Iterable[tuple[int, int]] = HOLIDAYS) -> Column:
    """Whether month and day of ``day`` are in the list (one integer lookup per row)."""
    return (F.month(day) * 100 + F.dayofmonth(day)).isin([m * 100 + d for m, d in holidays])


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
