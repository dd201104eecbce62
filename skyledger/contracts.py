"""The tables: their columns, business keys and file layout."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

# Table and column names, types and column order.

FLIGHT_OPERATIONS_RAW = """
    flight_date DATE, reporting_airline STRING, reporting_airline_name STRING,
    tail_number STRING, flight_number STRING,
    origin_airport STRING, origin_airport_seq_id STRING, origin_city_name STRING,
    origin_state_abbr STRING,
    dest_airport STRING, dest_airport_seq_id STRING, dest_city_name STRING,
    dest_state_abbr STRING,
    crs_dep_time STRING, dep_time STRING, dep_delay_minutes DOUBLE, taxi_out DOUBLE,
    wheels_off STRING, wheels_on STRING, taxi_in DOUBLE, crs_arr_time STRING,
    arr_time STRING, arr_delay_minutes DOUBLE,
    cancelled INT, cancellation_code STRING, diverted INT, distance_miles DOUBLE,
    carrier_delay DOUBLE, weather_delay DOUBLE, nas_delay DOUBLE, security_delay DOUBLE,
    late_aircraft_delay DOUBLE,
    raw_record STRING, source_file_name STRING, source_system STRING,
    ingestion_timestamp TIMESTAMP, batch_id STRING, record_hash STRING, year_month STRING
"""
AIRPORTS_RAW = """
    airport_id STRING, ident STRING, type STRING, name STRING, latitude_deg DOUBLE,
    longitude_deg DOUBLE, elevation_ft DOUBLE, continent STRING, iso_country STRING,
    iso_region STRING, municipality STRING, scheduled_service STRING, gps_code STRING,
    icao_code STRING, iata_code STRING, local_code STRING, home_link STRING,
    wikipedia_link STRING, keywords STRING,
    raw_record STRING, source_file_name STRING, source_system STRING,
    ingestion_timestamp TIMESTAMP, batch_id STRING, record_hash STRING
"""
AIRCRAFT_REFERENCE_RAW = """
    aircraft_code STRING, aircraft_name STRING, iata_code STRING, icao_code STRING,
    raw_record STRING, source_file_name STRING, source_system STRING,
    ingestion_timestamp TIMESTAMP, batch_id STRING, record_hash STRING
"""
WEATHER_METAR_RAW = """
    station_id STRING, observation_time TIMESTAMP, raw_text STRING, temp_c DOUBLE,
    dewpoint_c DOUBLE, wind_dir_degrees INT, wind_speed_kt DOUBLE, wind_gust_kt DOUBLE,
    visibility_statute_mi DOUBLE, altim_in_hg DOUBLE, flight_category STRING,
    precip_in DOUBLE, sky_cover STRING,
    raw_record STRING, source_file_name STRING, source_system STRING,
    ingestion_timestamp TIMESTAMP, batch_id STRING, record_hash STRING,
    observation_date DATE
"""
REJECTED = """
    source_table STRING, source_system STRING, source_file_name STRING,
    rescued_data STRING, raw_payload STRING, batch_id STRING,
    rejection_timestamp TIMESTAMP
"""
AIRPORTS_CLEAN = """
    airport_key BIGINT, airport_iata_code STRING, airport_icao_code STRING,
    airport_ident STRING, airport_name STRING, airport_type STRING, municipality STRING,
    iso_country STRING, iso_region STRING, continent STRING, latitude_deg DOUBLE,
    longitude_deg DOUBLE, elevation_ft DOUBLE, scheduled_service_flag BOOLEAN,
    ingestion_timestamp TIMESTAMP, batch_id STRING
"""
AIRCRAFT_REFERENCE_CLEAN = """
    aircraft_key BIGINT, aircraft_code STRING, aircraft_name STRING, iata_code STRING,
    icao_code STRING, ingestion_timestamp TIMESTAMP, batch_id STRING
"""
WEATHER_OBSERVATIONS_CLEAN = """
    weather_key BIGINT, station_id STRING, observation_time TIMESTAMP,
    observation_date DATE, temp_c DOUBLE, dewpoint_c DOUBLE, wind_dir_degrees INT,
    wind_speed_kt DOUBLE, wind_gust_kt DOUBLE, visibility_statute_mi DOUBLE,
    altim_in_hg DOUBLE, flight_category STRING, precip_in DOUBLE, sky_cover STRING,
    ingestion_timestamp TIMESTAMP, batch_id STRING
"""
FLIGHT_OPERATIONS_CLEAN = """
    flight_operation_key BIGINT, flight_date DATE, reporting_airline STRING,
    reporting_airline_name STRING, tail_number STRING, flight_number STRING,
    origin_airport STRING, dest_airport STRING, route_code STRING,
    origin_city_name STRING, origin_state_abbr STRING, dest_city_name STRING,
    dest_state_abbr STRING,
    scheduled_departure_ts TIMESTAMP, actual_departure_ts TIMESTAMP,
    scheduled_arrival_ts TIMESTAMP, actual_arrival_ts TIMESTAMP,
    departure_delay_minutes INT, arrival_delay_minutes INT, taxi_out_minutes INT,
    taxi_in_minutes INT, cancelled_flag BOOLEAN, cancellation_code STRING,
    diverted_flag BOOLEAN, distance_miles DOUBLE,
    carrier_delay_minutes INT, weather_delay_minutes INT, nas_delay_minutes INT,
    security_delay_minutes INT, late_aircraft_delay_minutes INT,
    is_delayed_flag BOOLEAN, is_on_time_arrival_flag BOOLEAN,
    is_on_time_departure_flag BOOLEAN, processing_status STRING,
    quality_issue_reason STRING, ingestion_timestamp TIMESTAMP, batch_id STRING,
    source_file_name STRING, record_hash STRING, year_month STRING
"""
FLIGHT_OPERATIONS_QUARANTINE = """
    quarantine_key BIGINT, raw_flight_date STRING, reporting_airline STRING,
    flight_number STRING, origin_airport STRING, dest_airport STRING,
    quality_issue_reason STRING, raw_record STRING, source_file_name STRING,
    ingestion_timestamp TIMESTAMP, batch_id STRING, record_hash STRING
"""
ROUTE_REFERENCE = """
    route_key BIGINT, origin_airport STRING, dest_airport STRING, route_code STRING,
    route_group STRING, first_seen_flight_date DATE, last_seen_flight_date DATE,
    total_record_count BIGINT, ingestion_timestamp TIMESTAMP, batch_id STRING
"""
ON_TIME_PERFORMANCE_DAILY = """
    flight_date DATE, reporting_airline STRING, total_flights BIGINT,
    completed_flights BIGINT, cancelled_flights BIGINT, diverted_flights BIGINT,
    delayed_departure_flights BIGINT, delayed_arrival_flights BIGINT,
    on_time_departure_flights BIGINT, on_time_arrival_flights BIGINT,
    on_time_arrival_percentage DECIMAL(9,2), avg_departure_delay_minutes DECIMAL(9,2),
    avg_arrival_delay_minutes DECIMAL(9,2), total_weather_delay_minutes BIGINT,
    total_carrier_delay_minutes BIGINT, total_nas_delay_minutes BIGINT,
    total_security_delay_minutes BIGINT, total_late_aircraft_delay_minutes BIGINT,
    load_timestamp TIMESTAMP
"""
ROUTE_DELAY_SUMMARY = """
    flight_date DATE, route_code STRING, origin_airport STRING, dest_airport STRING,
    reporting_airline STRING, total_flights BIGINT, completed_flights BIGINT,
    cancelled_flights BIGINT, delayed_arrival_flights BIGINT,
    avg_departure_delay_minutes DECIMAL(9,2), avg_arrival_delay_minutes DECIMAL(9,2),
    max_arrival_delay_minutes INT, total_weather_delay_minutes BIGINT,
    total_carrier_delay_minutes BIGINT, total_late_aircraft_delay_minutes BIGINT,
    load_timestamp TIMESTAMP
"""
AIRPORT_DELAY_SUMMARY = """
    flight_date DATE, airport_code STRING, airport_role STRING, reporting_airline STRING,
    total_flights BIGINT, completed_flights BIGINT, cancelled_flights BIGINT,
    delayed_flights BIGINT, on_time_flights BIGINT, avg_delay_minutes DECIMAL(9,2),
    max_delay_minutes INT, total_weather_delay_minutes BIGINT,
    total_carrier_delay_minutes BIGINT, total_late_aircraft_delay_minutes BIGINT,
    load_timestamp TIMESTAMP
"""
CANCELLATION_SUMMARY = """
    flight_date DATE, reporting_airline STRING, origin_airport STRING,
    dest_airport STRING, cancellation_code STRING, cancellation_reason STRING,
    cancellation_count BIGINT, load_timestamp TIMESTAMP
"""
ML_FEATURES = """
    flight_date DATE, reporting_airline STRING, flight_number STRING,
    origin_airport STRING, dest_airport STRING, route_code STRING, tail_number STRING,
    dep_hour INT, dep_hour_bucket STRING, day_of_week INT, month INT,
    is_weekend BOOLEAN, is_holiday BOOLEAN, season STRING,
    route_avg_arr_delay_90d DOUBLE, route_delay_rate_90d DOUBLE,
    carrier_on_time_rate_30d DOUBLE, carrier_avg_dep_delay_30d DOUBLE,
    distance_miles DOUBLE, aircraft_code STRING,
    origin_temp_c DOUBLE, origin_wind_speed_kt DOUBLE, origin_wind_gust_kt DOUBLE,
    origin_visibility_mi DOUBLE, origin_precip_in DOUBLE, origin_flight_category STRING,
    origin_weather_severity INT, is_delayed BOOLEAN,
    ingestion_timestamp TIMESTAMP, batch_id STRING, year_month STRING
"""
ML_PREDICTIONS = """
    flight_date DATE, reporting_airline STRING, flight_number STRING,
    origin_airport STRING, dest_airport STRING, route_code STRING,
    delay_probability DOUBLE, predicted_delayed BOOLEAN, model_version STRING,
    prediction_timestamp TIMESTAMP, batch_id STRING, year_month STRING
"""
PIPELINE_RUN_LOG = """
    event_timestamp TIMESTAMP, pipeline_name STRING, stage_name STRING,
    target_table STRING, run_id STRING, batch_id STRING, status STRING,
    rows_written BIGINT, rows_removed BIGINT, rows_rescued BIGINT,
    restored_version BIGINT, error_message STRING, details STRING
"""

# Tables of our own: what a training run used and reached, and the models it left.
MODEL_RUNS = """
    run_id STRING, model_name STRING, model_version STRING, trained_at TIMESTAMP,
    params STRING, metrics STRING, importances STRING, confusion STRING, tags STRING
"""
MODEL_REGISTRY = """
    model_name STRING, model_version STRING, path STRING, run_id STRING,
    registered_at TIMESTAMP
"""

_FLIGHT_KEY = ("flight_date", "reporting_airline", "flight_number", "origin_airport", "dest_airport")
_FLIGHT_MONTH = "date_format(flight_date, 'yyyy-MM')"


@dataclass(frozen=True)
class Contract:
    """A table: columns, business key, and the slices its files are grouped by.

    ``slice_by`` is a SQL expression over the columns. Every distinct value is one
    directory of files, the unit that reruns replace and reads can skip.
    ``slice_follows_key`` says that rows of one key can only be in one slice.
    ``surrogate`` names the column that holds the hash of the business key.
    Rows are only added to a ``log``: it has no versions.
    """

    name: str
    ddl: str
    key: tuple[str, ...] = ()
    surrogate: str | None = None
    slice_by: str = "'all'"
    slice_follows_key: bool = True
    log: bool = False

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(" ".join(self.ddl.split()))


def rejected_name(raw_name: str) -> str:
    """``x_raw`` -> ``x_rejected``."""
    return raw_name.removesuffix("_raw") + "_rejected"


_RAW = [
    Contract(name, ddl, slice_by="batch_id", slice_follows_key=False)
    for name, ddl in (
        ("bronze.flight_operations_raw", FLIGHT_OPERATIONS_RAW),
        ("bronze.airports_raw", AIRPORTS_RAW),
        ("bronze.aircraft_reference_raw", AIRCRAFT_REFERENCE_RAW),
        ("bronze.weather_metar_raw", WEATHER_METAR_RAW),
    )
]
_CONTRACTS = [
    *_RAW,
    *[Contract(rejected_name(raw.name), REJECTED, slice_by="batch_id", slice_follows_key=False)
      for raw in _RAW],
    Contract("silver.airports_clean", AIRPORTS_CLEAN,
             ("airport_iata_code", "airport_icao_code", "airport_ident"), "airport_key"),
    Contract("silver.aircraft_reference_clean", AIRCRAFT_REFERENCE_CLEAN,
             ("aircraft_code",), "aircraft_key"),
    Contract("silver.weather_observations_clean", WEATHER_OBSERVATIONS_CLEAN,
             ("station_id", "observation_time"), "weather_key",
             "date_format(observation_date, 'yyyy-MM')"),
    Contract("silver.flight_operations_clean", FLIGHT_OPERATIONS_CLEAN, _FLIGHT_KEY,
             "flight_operation_key", "year_month"),
    Contract("silver.flight_operations_quarantine", FLIGHT_OPERATIONS_QUARANTINE,
             ("raw_flight_date", *_FLIGHT_KEY[1:]), "quarantine_key",
             "substr(raw_flight_date, 1, 7)"),
    Contract("silver.route_reference", ROUTE_REFERENCE,
             ("origin_airport", "dest_airport", "route_code"), "route_key"),
    Contract("gold.on_time_performance_daily", ON_TIME_PERFORMANCE_DAILY,
             ("flight_date", "reporting_airline"), slice_by=_FLIGHT_MONTH),
    Contract("gold.route_delay_summary", ROUTE_DELAY_SUMMARY,
             ("flight_date", "route_code", "reporting_airline"), slice_by=_FLIGHT_MONTH),
    Contract("gold.airport_delay_summary", AIRPORT_DELAY_SUMMARY,
             ("flight_date", "airport_code", "airport_role", "reporting_airline"),
             slice_by=_FLIGHT_MONTH),
    Contract("gold.cancellation_summary", CANCELLATION_SUMMARY,
             (*_FLIGHT_KEY[:2], *_FLIGHT_KEY[3:], "cancellation_code"), slice_by=_FLIGHT_MONTH),
    Contract("gold.ml_features", ML_FEATURES, _FLIGHT_KEY, slice_by="year_month"),
    Contract("gold.ml_predictions", ML_PREDICTIONS, (*_FLIGHT_KEY, "model_version"),
             slice_by="year_month"),
    Contract("gold.model_runs", MODEL_RUNS, ("run_id",)),
    Contract("gold.model_registry", MODEL_REGISTRY, ("model_name", "model_version")),
    Contract("audit.pipeline_run_log", PIPELINE_RUN_LOG, log=True),
]
CONTRACTS = {contract.name: contract for contract in _CONTRACTS}


def contract(name: str) -> Contract:
    try:
        return CONTRACTS[name]
    except KeyError:
        raise LookupError(f"no contract for table '{name}'") from None
