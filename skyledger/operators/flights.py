"""Flight operations: normalise, keep the latest version, derive, judge, split."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.calendar import first_match, month_label
from skyledger.functions.casting import is_blank, kept_whole, whole_minutes
from skyledger.functions.clock import clock_number, clock_time, departure_after_delay, not_before
from skyledger.functions.measures import CAUSES, LATE_MINUTES
from skyledger.operators.dedup import latest_per_key, split_repeated

FLIGHT_KEY = ("flight_date", "reporting_airline", "flight_number", "origin_airport", "dest_airport")

# An outlier rule: derived column -> (lowest, highest) accepted value, either may be None.
Bounds = Mapping[str, tuple[float | None, float | None]]

_MINUTES = {
    "departure_delay_minutes": "dep_delay_minutes",
    "arrival_delay_minutes": "arr_delay_minutes",
    "taxi_out_minutes": "taxi_out",
    "taxi_in_minutes": "taxi_in",
    **{f"{cause}_delay_minutes": f"{cause}_delay" for cause in CAUSES},
}


_CLOCKS = ("crs_dep_time", "dep_time", "crs_arr_time", "arr_time")


def normalise_flights(raw: DataFrame) -> DataFrame:
    """Trimmed, upper-cased key columns."""
    def code(name: str) -> Column:
        return F.upper(F.trim(name))

    return raw.withColumns({
        "flight_date": F.col("flight_date").try_cast("date"),
        "flight_number": F.trim("flight_number"),
        "origin_airport": code("origin_airport"),
        "dest_airport": code("dest_airport"),
    })


def derive_flight_columns(flights: DataFrame, *, roll_late_departures: bool = False) -> DataFrame:
    """Schedule and actual times, flags and whole minutes.

    Built in steps: a column that later steps use more than once is computed in its own
    projection, so no clock string is parsed twice.
    """
    day = F.col("flight_date")
    operated = ~F.coalesce("cancelled_flag", F.lit(False))  # an unknown flag keeps the actual times

    def at(name: str) -> Column:
        return clock_time(day, F.col(f"_{name}"))

    parsed = flights.withColumns({
        **{f"_{name}": clock_number(F.col(name)) for name in _CLOCKS},
        **{new: whole_minutes(F.col(old)) for new, old in _MINUTES.items()},
        "cancelled_flag": F.col("cancelled").try_cast("int") == 1,
        "diverted_flag": F.col("diverted").try_cast("int") == 1,
        "route_code": F.concat_ws("-", "origin_airport", "dest_airport"),
        "year_month": month_label(day),
    })
    timed = parsed.withColumns({
        "scheduled_departure_ts": at("crs_dep_time"),
        "scheduled_arrival_ts": at("crs_arr_time"),
        "actual_departure_ts": F.when(operated, at("dep_time")),
        "actual_arrival_ts": F.when(operated, at("arr_time")),
    })
    if roll_late_departures:
        timed = timed.withColumn("actual_departure_ts", departure_after_delay(
            F.col("actual_departure_ts"), F.col("scheduled_departure_ts"),
            F.col("departure_delay_minutes"),
        ))
    return timed.withColumns({
        "scheduled_arrival_ts": not_before(
            F.col("scheduled_arrival_ts"), F.col("scheduled_departure_ts")
        ),
        "actual_arrival_ts": not_before(F.col("actual_arrival_ts"), F.col("actual_departure_ts")),
    }).drop(*[f"_{name}" for name in _CLOCKS])


def quality_issue(bounds: Bounds | None = None) -> Column:
    """The first rule a flight breaks, NULL for a sound flight."""
    origin, dest = F.col("origin_airport"), F.col("dest_airport")
    operated = ~F.col("cancelled_flag")
    # The reasons and their order.
    rules = [
        (is_blank(F.col("flight_number")), "MISSING_FLIGHT_NUMBER"),
        (is_blank(origin) | is_blank(dest), "MISSING_AIRPORT_CODE"),
        (origin == dest, "INVALID_ROUTE"),
        (F.col("scheduled_departure_ts").isNull(), "INVALID_SCHEDULED_DEPARTURE"),
        (F.col("scheduled_arrival_ts").isNull(), "INVALID_SCHEDULED_ARRIVAL"),
        (operated & F.col("actual_departure_ts").isNull(), "MISSING_ACTUAL_DEPARTURE"),
        (operated & F.col("actual_arrival_ts").isNull(), "MISSING_ACTUAL_ARRIVAL"),
    ]
    for name, (low, high) in (bounds or {}).items():
        if low is not None:
            rules.append((F.col(name) < low, "OUTLIER"))
        if high is not None:
            rules.append((F.col(name) > high, "OUTLIER"))
    return first_match(rules).cast("string")


def classify_flights(
    raw: DataFrame, *, bounds: Bounds | None = None, roll_late_departures: bool = False
) -> DataFrame:
    """Raw flights -> the newest version of each flight, judged.

    Rows are judged before the shuffle of the deduplication: a later filter on the
    verdict then reads a plain column instead of repeating the rules, and the shuffled
    row carries four timestamps in place of the clock strings. Of a large table only flights with
    several versions are shuffled.
    """
    def judged(flights: DataFrame) -> DataFrame:
        derived = derive_flight_columns(flights, roll_late_departures=roll_late_departures)
        return derived.withColumn("quality_issue_reason", quality_issue(bounds))

    once, others = split_repeated(normalise_flights(raw), FLIGHT_KEY)
    newest = latest_per_key(judged(others), FLIGHT_KEY)
    if once is None:
        return newest
    return judged(once).withColumn("quality_issue_reason", kept_whole(F.col("quality_issue_reason"))).unionByName(newest)


def add_punctuality(classified: DataFrame) -> DataFrame:
    """The punctuality flags and the status of a sound flight."""
    operated = ~F.col("cancelled_flag")
    arrival = F.coalesce("arrival_delay_minutes", F.lit(0))
    departure = F.coalesce("departure_delay_minutes", F.lit(0))
    return classified.withColumns({
        "is_delayed_flag": arrival > LATE_MINUTES,
        "is_on_time_arrival_flag": operated & (arrival <= LATE_MINUTES),
        "is_on_time_departure_flag": operated & (departure <= LATE_MINUTES),
        "processing_status": F.lit("VALID"),
    })


def valid_flights(classified: DataFrame) -> DataFrame:
    """The sound flights, with their punctuality flags."""
    return add_punctuality(classified.filter(F.col("quality_issue_reason").isNull()))


def quarantined_flights(classified: DataFrame) -> DataFrame:
    """The flights that break a rule; the date is kept as text."""
    return classified.filter(F.col("quality_issue_reason").isNotNull()).withColumn(
        "raw_flight_date", F.col("flight_date").cast("string")
    )
