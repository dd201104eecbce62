"""Features of scheduled flights, known strictly before the day of the flight."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import calendar
from skyledger.functions.measures import LATE_MINUTES, roll_up
from skyledger.functions.severity import category_severity, composite_severity
from skyledger.operators.dedup import latest_per_key
from skyledger.session import broadcast_if_modest, stage_table

# Trailing windows in days, and the tail-number suffix.
ROUTE_WINDOW_DAYS = 90
CARRIER_WINDOW_DAYS = 30
TAIL_SUFFIX = "([A-Z0-9]{2,4})$"

_WEATHER_COLUMNS = {
    "origin_temp_c": "temp_c",
    "origin_wind_speed_kt": "wind_speed_kt",
    "origin_wind_gust_kt": "wind_gust_kt",
    "origin_visibility_mi": "visibility_statute_mi",
    "origin_precip_in": "precip_in",
    "origin_flight_category": "flight_category",
}


def add_temporal(
    flights: DataFrame, holidays: Iterable[tuple[int, int]] = calendar.HOLIDAYS
) -> DataFrame:
    day, hour = F.col("flight_date"), F.hour("scheduled_departure_ts")
    return flights.withColumns({
        "dep_hour": hour,
        "dep_hour_bucket": calendar.hour_bucket(hour),
        "day_of_week": F.dayofweek(day),
        "month": F.month(day),
        "is_weekend": calendar.is_weekend(day),
        "is_holiday": calendar.is_holiday(day, holidays),
        "season": calendar.season(F.month(day)),
    })


def _trailing(keys: Iterable[str], days: int):
    """The ``days`` calendar days before a row's own day."""
    window = Window.partitionBy(*keys).orderBy(F.unix_date("flight_date")).rangeBetween(-days, -1)

    def rate(total: str, n: str) -> Column:
        return F.try_divide(F.sum(total).over(window), F.sum(n).over(window))

    return rate


def route_trailing(df: DataFrame, days: int = ROUTE_WINDOW_DAYS) -> DataFrame:
    """Mean arrival delay and share of late flights of each route before each of its days.

    The frame depends on the date alone, so the window runs over one row per route and
    day. A partition holds at most one row per calendar day, however hot the route is.
    """
    rate = _trailing(("route_code",), days)
    return roll_up(df, ("route_code", "flight_date")).select(
        "route_code",
        "flight_date",
        rate("arrival_delay_sum", "arrival_delay_known").alias("route_avg_arr_delay_90d"),
        rate("labelled_delayed_flights", "total_flights").alias("route_delay_rate_90d"),
    )


def carrier_trailing(df: DataFrame, days: int = CARRIER_WINDOW_DAYS) -> DataFrame:
    """On-time rate and mean departure delay of each carrier before each of its days."""
    rate = _trailing(("reporting_airline",), days)
    return roll_up(df, ("reporting_airline", "flight_date")).select(
        "reporting_airline",
        "flight_date",
        rate("on_time_arrival_flights", "total_flights").alias("carrier_on_time_rate_30d"),
        rate("departure_delay_sum", "departure_delay_known").alias("carrier_avg_dep_delay_30d"),
    )


def add_trailing(flights: DataFrame, route: DataFrame, carrier: DataFrame) -> DataFrame:
    """Attach both trailing feature pairs to the flights of their days."""
    return (
        flights
        .join(broadcast_if_modest(route), ["route_code", "flight_date"], "left")
        .join(broadcast_if_modest(carrier), ["reporting_airline", "flight_date"], "left")
    )


def add_aircraft_code(flights: DataFrame) -> DataFrame:
    """The last two to four characters of the tail number, '' when there are none."""
    return flights.withColumn(
        "aircraft_code", F.upper(F.regexp_extract("tail_number", TAIL_SUFFIX, 1))
    )


def _by_hour(weather: DataFrame) -> DataFrame:
    return weather.withColumns({
        "_station": F.col("station_id"),
        "_day": F.col("observation_date"),
        "_hour": F.hour("observation_time"),
    })


def _join_departure_hour(flights: DataFrame, hours: DataFrame) -> DataFrame:
    at_departure = (
        (F.col("origin_airport") == F.col("_station"))
        & (F.col("flight_date") == F.col("_day"))
        & (F.hour("scheduled_departure_ts") == F.col("_hour"))
    )
    return flights.join(hours, at_departure, "left").drop("_station", "_day", "_hour")


def departure_weather(weather: DataFrame) -> DataFrame:
    """The last report of every station and hour, named as flight features."""
    last_report = latest_per_key(
        _by_hour(weather), ("_station", "_day", "_hour"), ("observation_time",)
    )
    named = [F.col(old).alias(new) for new, old in _WEATHER_COLUMNS.items()]
    return last_report.select("_station", "_day", "_hour", *named)


def add_weather(flights: DataFrame, hours: DataFrame) -> DataFrame:
    """Weather at the origin in the scheduled hour of departure, and its severity.

    ``hours`` has one row per station and hour, so the join never multiplies flights.
    """
    return _join_departure_hour(flights, broadcast_if_modest(hours)).withColumn(
        "origin_weather_severity", category_severity(F.col("origin_flight_category"))
    )


def add_report_count(flights: DataFrame, weather: DataFrame) -> DataFrame:
    """How many reports a plain join on the hour would match with each flight.

    The counts tell how far such a join would repeat flights, without emitting the pairs.
    """
    counts = _by_hour(weather).groupBy("_station", "_day", "_hour").agg(
        F.count("*").alias("reports_in_hour")
    )
    return _join_departure_hour(flights, counts).withColumn(
        "reports_in_hour", F.coalesce("reports_in_hour", F.lit(0))
    )


def daily_weather(weather: DataFrame) -> DataFrame:
    """Per station and day: the extremes of its reports and the worst composite score."""
    score = composite_severity(
        F.col("wind_speed_kt"), F.col("visibility_statute_mi"), F.col("precip_in")
    )
    return weather.groupBy("station_id", "observation_date").agg(
        F.count("*").alias("reports"),
        F.max("wind_speed_kt").alias("max_wind_speed_kt"),
        F.min("visibility_statute_mi").alias("min_visibility_mi"),
        F.max("precip_in").alias("max_precip_in"),
        F.max(score).alias("worst_severity"),
    )


def add_daily_weather(flights: DataFrame, weather: DataFrame) -> DataFrame:
    """The coarse variant: weather of the whole day at the origin."""
    days = daily_weather(weather).withColumnsRenamed(
        {"station_id": "origin_airport", "observation_date": "flight_date"}
    )
    return flights.join(days, ["origin_airport", "flight_date"], "left")


def map_stations(weather: DataFrame, airports: DataFrame) -> DataFrame:
    """Rename ICAO stations to the IATA code of their airport; others keep their name."""
    codes = (
        airports.filter("airport_iata_code IS NOT NULL AND airport_icao_code IS NOT NULL")
        .groupBy(F.col("airport_icao_code").alias("station_id"))
        .agg(F.min("airport_iata_code").alias("_iata"))
    )
    return weather.join(codes, "station_id", "left").withColumn(
        "station_id", F.coalesce("_iata", "station_id")
    ).drop("_iata")


def delay_label(minutes: Column, threshold: int = LATE_MINUTES) -> Column:
    """The training label; an unknown delay counts as none."""
    return F.coalesce(minutes, F.lit(0)) >= threshold


class Lookups(NamedTuple):
    """What is joined to the flights, each with one row per join key.

    A stage writes them before the join (``staged``): Spark then knows their real sizes,
    broadcasts those below its threshold without shuffling a flight, and sorts and merges
    the others, splitting hot keys at run time.
    """

    route: DataFrame
    carrier: DataFrame
    hours: DataFrame

    def staged(self, stage: Callable[[DataFrame, str], DataFrame] = stage_table) -> Lookups:
        return Lookups(*[stage(df, name) for name, df in self._asdict().items()])


def feature_lookups(
    daily: DataFrame,
    weather: DataFrame,
    *,
    route_days: int = ROUTE_WINDOW_DAYS,
    carrier_days: int = CARRIER_WINDOW_DAYS,
) -> Lookups:
    """Lookups from flights or their ``route_carrier_day`` roll-up, and clean weather."""
    return Lookups(
        route_trailing(daily, route_days),
        carrier_trailing(daily, carrier_days),
        departure_weather(weather),
    )


def build_features(
    flights: DataFrame,
    lookups: Lookups,
    holidays: Iterable[tuple[int, int]] = calendar.HOLIDAYS,
) -> DataFrame:
    """One row per clean flight with every feature and the label."""
    return (
        flights
        .transform(add_temporal, holidays)
        .transform(add_trailing, lookups.route, lookups.carrier)
        .transform(add_aircraft_code)
        .transform(add_weather, lookups.hours)
        .withColumn("is_delayed", delay_label(F.col("arrival_delay_minutes")))
    )
