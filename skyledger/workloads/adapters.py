"""Operations, weather and reference rows derived from the star-schema test tables.

``OPS_SQL`` and the other texts state the same rows for the SQL side of the checks.
The rows are dirty on purpose: every quality rule, clock format and NULL case occurs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import LARGE_BYTES, scanned_bytes, stage_table

WEATHER_SHIFT_DAYS = 9496  # moves the events into the range of the shipping dates


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Column name -> expression, valid in both dialects.
_OPS = {
    "reporting_airline": "concat('C', lpad(cast(l_suppkey % 12 as string), 2, '0'))",
    "reporting_airline_name": "concat('Carrier ', cast(l_suppkey % 12 as string))",
    "tail_number": "concat('N', cast(l_partkey as string), 'B7')",
    "flight_number": (
        "case when l_partkey % 101 = 7 then null when l_partkey % 103 = 5 then '  '"
        " when l_linenumber = 4 then concat(' ', cast(l_orderkey as string), ' ')"
        " else cast(l_orderkey as string) end"
    ),
    "origin_airport": (
        "case when l_partkey % 107 = 3 then null"
        " when l_linenumber = 5 then concat(' n', lpad(cast(s_nationkey as string), 2, '0'), ' ')"
        " else concat('N', lpad(cast(s_nationkey as string), 2, '0')) end"
    ),
    "origin_airport_seq_id": "cast(10000 + s_nationkey as string)",
    "origin_city_name": "concat('City ', cast(s_nationkey as string))",
    "origin_state_abbr": "concat('S', cast(s_nationkey % 10 as string))",
    "dest_airport": (
        "case when l_partkey % 109 = 2 then ''"
        " else concat('N', lpad(cast(c_nationkey as string), 2, '0')) end"
    ),
    "dest_airport_seq_id": "cast(10000 + c_nationkey as string)",
    "dest_city_name": "concat('City ', cast(c_nationkey as string))",
    "dest_state_abbr": "concat('S', cast(c_nationkey % 10 as string))",
    "crs_dep_time": (
        "case when l_linenumber = 2 then concat(cast(l_partkey % 25 as string), ':',"
        " lpad(cast((l_linenumber * 7) % 60 as string), 2, '0'))"
        " when l_partkey % 139 = 9 then 'abc' when l_partkey % 149 = 9 then '12345'"
        " else lpad(cast((l_partkey % 25) * 100 + (l_linenumber * 7) % 60 as string), 4, '0') end"
    ),
    "dep_time": (
        "case when l_returnflag = 'R' or l_partkey % 113 = 1 then null"
        " else cast((l_partkey % 24) * 100 + (l_linenumber * 7 + 12) % 60 as string) end"
    ),
    "dep_delay_minutes": (
        "case when l_returnflag = 'R' then null"
        " else cast(cast(round(l_discount * 100) as int) * 5 - 10 as double) end"
    ),
    "taxi_out": "cast(l_linenumber + 8 as double) + 0.5",
    "wheels_off": "cast(null as string)",
    "wheels_on": "cast(null as string)",
    "taxi_in": "cast(l_linenumber + 3 as double)",
    "crs_arr_time": (
        "case when l_partkey % 127 = 4 then '  ' else"
        " cast(((l_partkey * 5 + l_linenumber) % 24) * 100 + l_partkey % 60 as string) end"
    ),
    "arr_time": (
        "case when l_returnflag = 'R' or l_partkey % 131 = 6 then null else"
        " cast(((l_partkey * 5 + l_linenumber + 1) % 24) * 100 + (l_partkey + 11) % 60 as string) end"
    ),
    # Later hours and carriers of higher number are late more often: a model can learn it.
    "arr_delay_minutes": (
        "case when l_returnflag = 'R' then null"
        " else l_quantity + (l_partkey % 25) * 2 + (l_suppkey % 12) * 3 - 70 end"
    ),
    "cancelled": (
        "case when l_partkey % 137 = 8 then null when l_returnflag = 'R' then 1 else 0 end"
    ),
    "cancellation_code": (
        "case when l_returnflag <> 'R' then null when l_linenumber % 6 = 1 then 'A'"
        " when l_linenumber % 6 = 2 then 'B' when l_linenumber % 6 = 3 then 'C'"
        " when l_linenumber % 6 = 4 then 'D' when l_linenumber % 6 = 5 then 'E' end"
    ),
    "diverted": "case when l_linestatus = 'O' and l_quantity = 50 then 1 else 0 end",
    "distance_miles": "cast(l_partkey % 2500 + 100 as double)",
    "carrier_delay": "case when l_linenumber = 1 then null else cast(l_partkey % 30 as double) end",
    "weather_delay": "cast(l_suppkey % 20 as double)",
    "nas_delay": "cast((l_partkey + l_suppkey) % 15 as double)",
    "security_delay": "cast(l_partkey % 3 as double)",
    "late_aircraft_delay": "case when l_linenumber = 2 then null else cast(l_orderkey % 40 as double) end",
    "raw_record": (
        "concat_ws('|', cast(l_orderkey as string), cast(l_linenumber as string),"
        " cast(l_partkey as string), cast(l_suppkey as string), cast(cast(l_quantity as int) as string),"
        " cast(cast(round(l_discount * 100) as int) as string), l_returnflag, l_linestatus)"
    ),
    "source_system": "'ops'",
}
# Column name -> (Spark, SQL) where the dialects differ.
_OPS_SPLIT = {
    "flight_date": ("cast(l_shipdate as date)", "cast(l_shipdate as date)"),
    "source_file_name": (
        "concat('ops_', date_format(l_shipdate, 'yyyyMM'), '.csv')",
        "concat('ops_', strftime(l_shipdate, '%Y%m'), '.csv')",
    ),
    "ingestion_timestamp": (
        "cast(l_shipdate + make_dt_interval(0, cast(l_suppkey % 100 as int), 0, 0) as timestamp)",
        "l_shipdate + to_hours(cast(l_suppkey % 100 as integer))",
    ),
    "batch_id": (
        "concat('batch_', date_format(l_shipdate, 'yyyyMM'))",
        "concat('batch_', strftime(l_shipdate, '%Y%m'))",
    ),
    "year_month": ("date_format(l_shipdate, 'yyyy-MM')", "strftime(l_shipdate, '%Y-%m')"),
}
# What the expressions above read of a line item.
_LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
_HASH = ("md5(concat_ws('#', raw_record, cast(c_nationkey as string),"
         " cast(cast(round(l_extendedprice * 100) as bigint) as string)))")


def ops(
    spark: SparkSession, sf_dir: str, stage: Callable[[DataFrame, str], DataFrame] = stage_table
) -> DataFrame:
    """Raw flight operations: one per line item, from its supplier's to its customer's nation.

    Large tables are joined once and written: orders meet their customers before line items are shuffled, and
    what reads the operations again shuffles none.
    """
    lines, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    of_order, of_customer = F.col("l_orderkey") == F.col("o_orderkey"), F.col("o_custkey") == F.col("c_custkey")
    of_supplier = F.col("l_suppkey") == F.col("s_suppkey")
    if scanned_bytes(lines) < LARGE_BYTES:
        joined = lines.join(orders, of_order).join(customers, of_customer).join(suppliers, of_supplier)
    else:
        places = orders.join(customers, of_customer).select("o_orderkey", "c_nationkey")
        met = lines.join(places, of_order).join(suppliers, of_supplier)
        joined = stage(met.select(*_LINE_COLUMNS, "c_nationkey", "s_nationkey"), "operations")
    spark_only = {name: texts[0] for name, texts in _OPS_SPLIT.items()}
    columns = {**spark_only, **_OPS}
    return joined.selectExpr(
        *[f"{text} AS {name}" for name, text in columns.items()],
        f"{_HASH.replace('raw_record', _OPS['raw_record'])} AS record_hash",
    )


def _sql_columns(shared: dict[str, str], split: dict[str, tuple[str, str]]) -> str:
    columns = {**{name: texts[1] for name, texts in split.items()}, **shared}
    return ",\n  ".join(f"{text} AS {name}" for name, text in columns.items())


OPS_SQL = f"""SELECT {_sql_columns(_OPS, _OPS_SPLIT)},
  {_HASH.replace('raw_record', _OPS['raw_record'])} AS record_hash
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey"""


_WX = {
    "station_id": "case when event_id % 211 = 5 then null when event_id % 2 = 0"
                  " then concat('n', lpad(cast(user_id % 25 as string), 2, '0'))"
                  " else concat('N', lpad(cast(user_id % 25 as string), 2, '0')) end",
    "temp_c": "cast(event_id % 40 as double) - 5",
    "dewpoint_c": "cast(event_id % 20 as double) - 8",
    "wind_dir_degrees": "cast(event_id % 360 as int)",
    "wind_speed_kt": "value",
    "wind_gust_kt": "value + 5",
    "visibility_statute_mi": "cast(event_id % 11 as double)",
    "altim_in_hg": "29 + cast(event_id % 100 as double) / 100",
    "flight_category": "case event_type when 'view' then 'vfr' when 'click' then 'MVFR'"
                       " when 'signup' then 'ifr' when 'error' then 'LIFR' end",
    "precip_in": "cast(event_id % 4 as double) / 10",
    "sky_cover": "case when event_id % 3 = 0 then 'ovc' else 'Clr' end",
    "batch_id": "concat('wx_', cast(event_id % 3 as string))",
    "record_hash": "md5(cast(event_id as string))",
}
_WX_SPLIT = {
    "observation_time": (
        f"cast(date_trunc('minute', ts) - make_dt_interval({WEATHER_SHIFT_DAYS}) as timestamp)",
        f"date_trunc('minute', ts) - to_days({WEATHER_SHIFT_DAYS})",
    ),
    "observation_date": (
        f"date_sub(cast(ts as date), {WEATHER_SHIFT_DAYS})",
        f"cast(ts as date) - {WEATHER_SHIFT_DAYS}",
    ),
    "ingestion_timestamp": (
        "cast(date_trunc('hour', ts) as timestamp)", "date_trunc('hour', ts)",
    ),
}


def wx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather reports, one per event; reports of one minute are versions of each other."""
    columns = {**{name: texts[0] for name, texts in _WX_SPLIT.items()}, **_WX}
    return load(spark, sf_dir, "events").selectExpr(
        *[f"{text} AS {name}" for name, text in columns.items()]
    )


WX_SQL = f"SELECT {_sql_columns(_WX, _WX_SPLIT)} FROM events"


_AIRPORTS = {
    "iata_code": "case when s_suppkey % 13 = 4 then null"
                 " when s_suppkey % 2 = 0 then concat('a', cast(s_suppkey % 50 as string))"
                 " else concat('A', cast((s_suppkey + 1) % 50 as string)) end",
    "icao_code": "case when s_suppkey % 11 in (2, 4) then null"
                 " else concat('K', cast(s_suppkey % 2 as string), cast(s_nationkey as string)) end",
    "ident": "concat('i', cast(s_suppkey % 5 as string))",
    "name": "s_name",
    "type": "case when s_acctbal > 5000 then 'large_airport' else 'small_airport' end",
    "municipality": "n_name",
    "iso_country": "lower(substr(n_name, 1, 2))",
    "iso_region": "concat('us-', cast(s_nationkey as string))",
    "continent": "case when n_regionkey = 1 then 'na' else 'EU' end",
    "latitude_deg": "cast(s_suppkey % 90 as double)",
    "longitude_deg": "cast(s_nationkey * 3 as double)",
    "elevation_ft": "s_acctbal",
    "scheduled_service": "case s_suppkey % 4 when 0 then 'YES' when 1 then 'yes' when 2 then 'no' end",
    "batch_id": "concat('dim_', cast(s_suppkey % 2 as string))",
    "record_hash": "md5(s_name)",
}
_AIRPORTS_SPLIT = {
    "ingestion_timestamp": (
        "cast(timestamp_ntz'2024-01-01 00:00:00'"
        " + make_dt_interval(0, cast(s_suppkey % 7 as int), 0, 0) as timestamp)",
        "timestamp '2024-01-01 00:00:00' + to_hours(cast(s_suppkey % 7 as integer))",
    ),
}


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw airports, one per supplier, with clashing and missing codes."""
    columns = {**{name: texts[0] for name, texts in _AIRPORTS_SPLIT.items()}, **_AIRPORTS}
    nations = load(spark, sf_dir, "nation")
    return (
        load(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])
    )


AIRPORTS_SQL = f"""SELECT {_sql_columns(_AIRPORTS, _AIRPORTS_SPLIT)}
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


_AIRCRAFT = {
    "aircraft_code": "case when p_partkey % 17 = 3 then null when p_partkey % 2 = 0"
                     " then concat('t', cast(p_size as string), substr(p_type, 1, 1))"
                     " else concat('T', cast(p_size as string), lower(substr(p_type, 1, 1))) end",
    "aircraft_name": "p_name",
    "iata_code": "lower(substr(p_brand, 7))",
    "icao_code": "lower(p_type)",
    "batch_id": "concat('dim_', cast(p_partkey % 2 as string))",
    "record_hash": "md5(cast(p_partkey as string))",
}
_AIRCRAFT_SPLIT = {
    "ingestion_timestamp": (
        "cast(timestamp_ntz'2024-01-01 00:00:00'"
        " + make_dt_interval(0, cast(p_partkey % 24 as int), 0, 0) as timestamp)",
        "timestamp '2024-01-01 00:00:00' + to_hours(cast(p_partkey % 24 as integer))",
    ),
}


def aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw aircraft types, one per part, many parts to a code."""
    columns = {**{name: texts[0] for name, texts in _AIRCRAFT_SPLIT.items()}, **_AIRCRAFT}
    return load(spark, sf_dir, "part").selectExpr(
        *[f"{text} AS {name}" for name, text in columns.items()]
    )


AIRCRAFT_SQL = f"SELECT {_sql_columns(_AIRCRAFT, _AIRCRAFT_SPLIT)} FROM part"
