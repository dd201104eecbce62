"""Reference tables: airports, aircraft, weather reports, routes.

Codes are normalised before deduplication, so spellings of one code in different case
are one key; the latest ingested row survives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.dedup import latest_per_key


def _upper_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.upper(name) for name in names})


def clean_airports(raw: DataFrame) -> DataFrame:
    known = raw.filter("iata_code IS NOT NULL OR icao_code IS NOT NULL").withColumnsRenamed({
        "iata_code": "airport_iata_code",
        "icao_code": "airport_icao_code",
        "ident": "airport_ident",
        "name": "airport_name",
        "type": "airport_type",
    })
    key = ("airport_iata_code", "airport_icao_code", "airport_ident")
    coded = _upper_all(known, (*key, "iso_country", "iso_region", "continent"))
    served = F.coalesce(F.lower("scheduled_service"), F.lit("no")) == "yes"
    return latest_per_key(coded, key).withColumn("scheduled_service_flag", served)


def clean_aircraft(raw: DataFrame) -> DataFrame:
    known = raw.filter("aircraft_code IS NOT NULL")
    return latest_per_key(_upper_all(known, ("aircraft_code", "iata_code", "icao_code")), ("aircraft_code",))


def clean_weather(raw: DataFrame) -> DataFrame:
    known = raw.filter("station_id IS NOT NULL")
    coded = _upper_all(known, ("station_id", "flight_category", "sky_cover"))
    return latest_per_key(coded, ("station_id", "observation_time"))


def route_reference(valid: DataFrame) -> DataFrame:
    """One row per route: first and last day, flights, latest lineage.

    Counted per route and batch first, where every aggregate has a fixed width and Spark
    aggregates by hashing; the maximum of the batch names, a text, then only sees those
    few rows instead of forcing a sort of all flights.
    """
    route = ("origin_airport", "dest_airport", "route_code")
    per_batch = valid.groupBy(*route, "batch_id").agg(
        F.min("flight_date").alias("first_day"),
        F.max("flight_date").alias("last_day"),
        F.count("*").alias("flights"),
        F.max("ingestion_timestamp").alias("loaded"),
    )
    return per_batch.groupBy(*route).agg(
        F.min("first_day").alias("first_seen_flight_date"),
        F.max("last_day").alias("last_seen_flight_date"),
        F.sum("flights").alias("total_record_count"),
        F.max("loaded").alias("ingestion_timestamp"),
        F.max("batch_id").alias("batch_id"),
    ).withColumn("route_group", F.concat_ws("_", "origin_airport", "dest_airport"))
