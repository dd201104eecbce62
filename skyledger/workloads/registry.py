"""The registered queries: operators applied to whole tables derived from the test data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.contracts import contract
from skyledger.functions.measures import INPUTS
from skyledger.functions.severity import category_severity, composite_severity
from skyledger.operators import dimensions, features, flights, summaries
from skyledger.operators.dedup import latest_per_key
from skyledger.session import fit_shuffles, prepare, scratch, stage_table
from skyledger.workloads import adapters

Query = Callable[[SparkSession, str], DataFrame]
Stage = Callable[[DataFrame, str], DataFrame]
QUERIES: dict[str, Query] = {}

_FLIGHT_ID = flights.FLIGHT_KEY
_TEMPORAL = ("dep_hour", "dep_hour_bucket", "day_of_week", "month", "is_weekend", "is_holiday", "season")
_WEATHER = ("origin_temp_c", "origin_wind_speed_kt", "origin_wind_gust_kt", "origin_visibility_mi",
            "origin_precip_in", "origin_flight_category", "origin_weather_severity")


def query(fn: Query) -> Query:
    """Register a query; it runs with the settings of the jobs and shuffles that fit."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fit_shuffles(adapters.load(prepare(spark), sf_dir, "lineitem"))
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def wall_clock(df: DataFrame) -> DataFrame:
    """Zoned timestamps as plain wall-clock times."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def columns_of(table: str) -> list[str]:
    """A table's columns without its surrogate key."""
    target = contract(table)
    return [name for name in target.schema.names if name != target.surrogate]


def classified(spark: SparkSession, sf_dir: str, stage: Stage = stage_table) -> DataFrame:
    return flights.classify_flights(adapters.ops(spark, sf_dir, stage))


def valid(spark: SparkSession, sf_dir: str, stage: Stage = stage_table) -> DataFrame:
    """Sound flights; ``stage`` writes the operations of large tables."""
    return flights.valid_flights(classified(spark, sf_dir, stage))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.clean_weather(adapters.wx(spark, sf_dir))


@query
def on_time_daily(spark, sf_dir):
    return summaries.on_time_performance_daily(valid(spark, sf_dir))


@query
def route_delay(spark, sf_dir):
    return summaries.route_delay_summary(valid(spark, sf_dir))


@query
def airport_delay(spark, sf_dir):
    return summaries.airport_delay_summary(valid(spark, sf_dir))


@query
def cancellations(spark, sf_dir):
    return summaries.cancellation_summary(valid(spark, sf_dir))


@query
def flight_valid(spark, sf_dir):
    return wall_clock(
        valid(spark, sf_dir).select(*columns_of("silver.flight_operations_clean"))
    )


@query
def flight_quarantine(spark, sf_dir):
    rows = flights.quarantined_flights(classified(spark, sf_dir))
    return wall_clock(rows.select(*columns_of("silver.flight_operations_quarantine")))


@query
def quarantine_by_reason(spark, sf_dir):
    rows = flights.quarantined_flights(classified(spark, sf_dir))
    return rows.groupBy("quality_issue_reason").agg(
        F.count("*").alias("flights"),
        F.min("flight_date").alias("first_date"),
        F.max("flight_date").alias("last_date"),
    )


@query
def outlier_quarantine(spark, sf_dir):
    bounds = {"arrival_delay_minutes": (None, 25), "taxi_out_minutes": (10, None)}
    judged = flights.classify_flights(adapters.ops(spark, sf_dir), bounds=bounds)
    return flights.quarantined_flights(judged).groupBy("quality_issue_reason").agg(
        F.count("*").alias("flights")
    )


@query
def latest_by_key(spark, sf_dir):
    lines = adapters.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_shipdate",
    )
    newest = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    return latest_per_key(lines, ("l_orderkey", "l_linenumber"), newest)


@query
def route_reference(spark, sf_dir):
    return wall_clock(dimensions.route_reference(valid(spark, sf_dir)))


@query
def airports_clean(spark, sf_dir):
    rows = dimensions.clean_airports(adapters.airports(spark, sf_dir))
    return wall_clock(rows.select(*columns_of("silver.airports_clean")))


@query
def aircraft_clean(spark, sf_dir):
    rows = dimensions.clean_aircraft(adapters.aircraft(spark, sf_dir))
    return wall_clock(rows.select(*columns_of("silver.aircraft_reference_clean")))


@query
def weather_clean(spark, sf_dir):
    rows = weather(spark, sf_dir)
    return wall_clock(rows.select(*columns_of("silver.weather_observations_clean")))


@query
def temporal_features(spark, sf_dir):
    return features.add_temporal(valid(spark, sf_dir)).select(*_FLIGHT_ID, *_TEMPORAL)


@query
def route_trailing_90d(spark, sf_dir):
    return features.route_trailing(valid(spark, sf_dir))


@query
def carrier_trailing_30d(spark, sf_dir):
    return features.carrier_trailing(valid(spark, sf_dir))


@query
def aircraft_code(spark, sf_dir):
    coded = features.add_aircraft_code(valid(spark, sf_dir))
    return coded.groupBy("aircraft_code").agg(F.count("*").alias("flights"))


@query
def weather_join(spark, sf_dir):
    hours = features.departure_weather(weather(spark, sf_dir))
    joined = features.add_weather(valid(spark, sf_dir), hours)
    return joined.select(*_FLIGHT_ID, *_WEATHER)


@query
def weather_join_fanout(spark, sf_dir):
    counted = features.add_report_count(valid(spark, sf_dir), weather(spark, sf_dir))
    return counted.groupBy("reports_in_hour").agg(
        F.count("*").alias("flights"),
        F.sum(F.greatest("reports_in_hour", F.lit(1))).alias("joined_rows"),
    )


@query
def weather_daily_join(spark, sf_dir):
    joined = features.add_daily_weather(valid(spark, sf_dir), weather(spark, sf_dir))
    return joined.select(
        *_FLIGHT_ID, "reports", "max_wind_speed_kt", "min_visibility_mi", "max_precip_in",
        "worst_severity",
    )


def _by_severity(reports: DataFrame, score) -> DataFrame:
    return reports.groupBy("station_id", score.alias("severity")).agg(F.count("*").alias("reports"))


@query
def weather_severity(spark, sf_dir):
    return _by_severity(weather(spark, sf_dir), category_severity(F.col("flight_category")))


@query
def weather_severity_composite(spark, sf_dir):
    score = composite_severity(
        F.col("wind_speed_kt"), F.col("visibility_statute_mi"), F.col("precip_in")
    )
    return _by_severity(weather(spark, sf_dir), score)


@query
def station_mapping(spark, sf_dir):
    stations = adapters.airports(spark, sf_dir).select(
        F.upper("iata_code").alias("airport_iata_code"),
        F.concat(F.lit("N"), F.lpad(F.substr("icao_code", F.lit(3)), 2, "0")).alias("airport_icao_code"),
    )
    mapped = features.map_stations(weather(spark, sf_dir), stations)
    return mapped.groupBy("station_id", "observation_date").agg(F.count("*").alias("reports"))


_FEATURE_INPUT = (
    *_FLIGHT_ID, "route_code", "tail_number", "scheduled_departure_ts", "distance_miles",
    "ingestion_timestamp", "batch_id", "year_month", *INPUTS,
)


def feature_rows(spark: SparkSession, sf_dir: str, stage: Stage = stage_table) -> DataFrame:
    """The feature table, from clean flights and lookups that ``stage`` writes once. What these are made
    from is removed as soon as they are there."""
    with scratch(spark) as brief:
        clean = stage(valid(spark, sf_dir, brief).select(*_FEATURE_INPUT), "clean_flights")
    with scratch(spark) as brief:
        daily = brief(summaries.route_carrier_day(clean), "daily")
        lookups = features.feature_lookups(daily, weather(spark, sf_dir)).staged(stage)
    return features.build_features(clean, lookups).select(*columns_of("gold.ml_features"))


@query
def ml_features(spark, sf_dir):
    return wall_clock(feature_rows(spark, sf_dir))
