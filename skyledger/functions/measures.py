"""Mergeable measures of scheduled operations.

Every measure is an integer per flight and is merged with SUM or MAX, so the same
definitions serve flights, daily roll-ups of flights and roll-ups of roll-ups. Integer
sums do not depend on order, so a mean taken from a merged sum and count equals the
mean over the flights themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A report calls a flight late above, the label at or above this many minutes.
LATE_MINUTES = 15

CAUSES = ("weather", "carrier", "nas", "security", "late_aircraft")

# What the measures are taken from.
INPUTS = (
    "departure_delay_minutes", "arrival_delay_minutes", "cancelled_flag", "diverted_flag",
    "is_on_time_departure_flag", "is_on_time_arrival_flag",
    *[f"{cause}_delay_minutes" for cause in CAUSES],
)


def _one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _or_zero(minutes: Column) -> Column:
    return F.coalesce(minutes, F.lit(0))


def _per_flight() -> dict[str, tuple[Column, str]]:
    dep, arr = F.col("departure_delay_minutes"), F.col("arrival_delay_minutes")
    cancelled = F.col("cancelled_flag")
    measures = {
        "total_flights": (F.lit(1), "sum"),
        "completed_flights": (_one_if(~cancelled), "sum"),
        "cancelled_flights": (_one_if(cancelled), "sum"),
        "diverted_flights": (_one_if(F.col("diverted_flag")), "sum"),
        "delayed_departure_flights": (_one_if(dep > LATE_MINUTES), "sum"),
        "delayed_arrival_flights": (_one_if(arr > LATE_MINUTES), "sum"),
        "labelled_delayed_flights": (_one_if(arr >= LATE_MINUTES), "sum"),
        "on_time_departure_flights": (_one_if(F.col("is_on_time_departure_flag")), "sum"),
        "on_time_arrival_flights": (_one_if(F.col("is_on_time_arrival_flag")), "sum"),
        "departure_delay_sum": (_or_zero(dep), "sum"),
        "departure_delay_known": (_one_if(dep.isNotNull()), "sum"),
        "departure_delay_peak": (_or_zero(dep), "max"),
        "arrival_delay_sum": (_or_zero(arr), "sum"),
        "arrival_delay_known": (_one_if(arr.isNotNull()), "sum"),
        "arrival_delay_peak": (_or_zero(arr), "max"),
        "max_arrival_delay_minutes": (arr, "max"),
    }
    for cause in CAUSES:
        measures[f"total_{cause}_delay_minutes"] = (
            _or_zero(F.col(f"{cause}_delay_minutes")), "sum",
        )
    return measures


def as_measures(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Flights as one-row roll-ups; a frame that is a roll-up already is only projected."""
    measures = _per_flight()
    if "total_flights" in df.columns:
        return df.select(*keys, *measures)
    return df.select(*keys, *[col.alias(name) for name, (col, _) in measures.items()])


def merge_measures(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Roll measures up to ``keys``. Partial aggregation happens before the shuffle, so
    a key with a third of all rows sends one row per map task."""
    merged = []
    for name, (_, how) in _per_flight().items():
        merged.append((F.sum(name) if how == "sum" else F.max(name)).alias(name))
    return df.groupBy(*keys).agg(*merged)


def roll_up(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Flights, or a finer roll-up, at the grain of ``keys``."""
    return merge_measures(as_measures(df, keys), keys)


def mean(total: str, n: str) -> Column:
    """total / n, NULL when n is 0."""
    return F.try_divide(F.col(total), F.col(n))


def percentage(part: str, whole: str) -> Column:
    """100 * part / whole, 0.0 when the whole is 0."""
    return F.when(F.col(whole) > 0, F.col(part) * 100.0 / F.col(whole)).otherwise(0.0)
