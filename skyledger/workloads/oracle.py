"""The same questions as SQL, stated independently of the DataFrame programs."""

from __future__ import annotations

from skyledger.workloads.adapters import AIRCRAFT_SQL, AIRPORTS_SQL, OPS_SQL, WX_SQL


def _clock(column: str) -> str:
    digits = f"lpad(regexp_replace({column}, '[^0-9]', '', 'g'), 4, '0')"
    return (
        f"CASE WHEN trim({column}) <> '' THEN try_strptime("
        f"strftime(flight_date, '%Y-%m-%d') || ' ' || {digits}, '%Y-%m-%d %H%M') END"
    )


def _roll(moment: str, start: str) -> str:
    return f"CASE WHEN {moment} < {start} THEN {moment} + INTERVAL 1 DAY ELSE {moment} END"


_LATEST = "ORDER BY ingestion_timestamp DESC NULLS LAST, record_hash DESC NULLS LAST"

_CLASSIFIED = f"""
ops AS ({OPS_SQL}),
keyed AS (SELECT * REPLACE (trim(flight_number) AS flight_number,
    upper(trim(origin_airport)) AS origin_airport, upper(trim(dest_airport)) AS dest_airport)
  FROM ops),
ranked AS (SELECT *, row_number() OVER (
    PARTITION BY flight_date, reporting_airline, flight_number, origin_airport, dest_airport
    {_LATEST}) AS place FROM keyed),
timed AS (SELECT *, cancelled = 1 AS cancelled_flag, diverted = 1 AS diverted_flag,
    origin_airport || '-' || dest_airport AS route_code,
    {_clock('crs_dep_time')} AS scheduled_departure_ts, {_clock('crs_arr_time')} AS arrives,
    CASE WHEN cancelled = 1 THEN NULL ELSE {_clock('dep_time')} END AS actual_departure_ts,
    CASE WHEN cancelled = 1 THEN NULL ELSE {_clock('arr_time')} END AS arrived,
    CAST(trunc(dep_delay_minutes) AS INTEGER) AS departure_delay_minutes,
    CAST(trunc(arr_delay_minutes) AS INTEGER) AS arrival_delay_minutes,
    CAST(trunc(taxi_out) AS INTEGER) AS taxi_out_minutes,
    CAST(trunc(taxi_in) AS INTEGER) AS taxi_in_minutes,
    CAST(trunc(carrier_delay) AS INTEGER) AS carrier_delay_minutes,
    CAST(trunc(weather_delay) AS INTEGER) AS weather_delay_minutes,
    CAST(trunc(nas_delay) AS INTEGER) AS nas_delay_minutes,
    CAST(trunc(security_delay) AS INTEGER) AS security_delay_minutes,
    CAST(trunc(late_aircraft_delay) AS INTEGER) AS late_aircraft_delay_minutes
  FROM ranked WHERE place = 1),
rolled AS (SELECT *, {_roll('arrives', 'scheduled_departure_ts')} AS scheduled_arrival_ts,
    {_roll('arrived', 'actual_departure_ts')} AS actual_arrival_ts FROM timed),
classified AS (SELECT *, CASE
    WHEN flight_number IS NULL OR trim(flight_number) = '' THEN 'MISSING_FLIGHT_NUMBER'
    WHEN origin_airport IS NULL OR dest_airport IS NULL OR origin_airport = ''
      OR dest_airport = '' THEN 'MISSING_AIRPORT_CODE'
    WHEN origin_airport = dest_airport THEN 'INVALID_ROUTE'
    WHEN scheduled_departure_ts IS NULL THEN 'INVALID_SCHEDULED_DEPARTURE'
    WHEN scheduled_arrival_ts IS NULL THEN 'INVALID_SCHEDULED_ARRIVAL'
    WHEN cancelled = 0 AND actual_departure_ts IS NULL THEN 'MISSING_ACTUAL_DEPARTURE'
    WHEN cancelled = 0 AND actual_arrival_ts IS NULL THEN 'MISSING_ACTUAL_ARRIVAL'
    END AS quality_issue_reason FROM rolled)"""

_VALID = f"""{_CLASSIFIED},
valid AS (SELECT *, coalesce(arrival_delay_minutes, 0) > 15 AS is_delayed_flag,
    cancelled = 0 AND coalesce(arrival_delay_minutes, 0) <= 15 AS is_on_time_arrival_flag,
    cancelled = 0 AND coalesce(departure_delay_minutes, 0) <= 15 AS is_on_time_departure_flag,
    'VALID' AS processing_status
  FROM classified WHERE quality_issue_reason IS NULL)"""

_WEATHER = f"""wx AS ({WX_SQL}),
weather AS (SELECT * FROM (SELECT * REPLACE (upper(station_id) AS station_id,
      upper(flight_category) AS flight_category, upper(sky_cover) AS sky_cover),
      row_number() OVER (PARTITION BY upper(station_id), observation_time {_LATEST}) AS place
    FROM wx WHERE station_id IS NOT NULL) WHERE place = 1)"""

_HOURS = f"""{_WEATHER},
hours AS (SELECT * FROM (SELECT *, hour(observation_time) AS h, row_number() OVER (
      PARTITION BY station_id, observation_date, hour(observation_time)
      ORDER BY observation_time DESC) AS nth FROM weather) WHERE nth = 1)"""

FLIGHT_COLUMNS = """flight_date, reporting_airline, reporting_airline_name, tail_number,
  flight_number, origin_airport, dest_airport, route_code, origin_city_name, origin_state_abbr,
  dest_city_name, dest_state_abbr, scheduled_departure_ts, actual_departure_ts,
  scheduled_arrival_ts, actual_arrival_ts, departure_delay_minutes, arrival_delay_minutes,
  taxi_out_minutes, taxi_in_minutes, cancelled_flag, cancellation_code, diverted_flag,
  distance_miles, carrier_delay_minutes, weather_delay_minutes, nas_delay_minutes,
  security_delay_minutes, late_aircraft_delay_minutes, is_delayed_flag,
  is_on_time_arrival_flag, is_on_time_departure_flag, processing_status,
  quality_issue_reason, ingestion_timestamp, batch_id, source_file_name, record_hash, year_month"""

QUARANTINE_COLUMNS = """CAST(flight_date AS VARCHAR) AS raw_flight_date, reporting_airline,
  flight_number, origin_airport, dest_airport, quality_issue_reason, raw_record,
  source_file_name, ingestion_timestamp, batch_id, record_hash"""

_HOLIDAYS = ("(1, 1), (1, 15), (2, 19), (5, 27), (7, 4), (9, 2), (11, 11), (11, 28), (12, 25), "
             "(12, 26)")

_TEMPORAL = f"""CAST(hour(scheduled_departure_ts) AS INTEGER) AS dep_hour,
  CASE WHEN hour(scheduled_departure_ts) <= 4 THEN 'red_eye'
    WHEN hour(scheduled_departure_ts) <= 11 THEN 'morning'
    WHEN hour(scheduled_departure_ts) <= 17 THEN 'afternoon' ELSE 'evening' END AS dep_hour_bucket,
  CAST(dayofweek(flight_date) + 1 AS INTEGER) AS day_of_week,
  CAST(month(flight_date) AS INTEGER) AS month,
  dayofweek(flight_date) IN (0, 6) AS is_weekend,
  (month(flight_date), day(flight_date)) IN ({_HOLIDAYS}) AS is_holiday,
  CASE WHEN month(flight_date) IN (12, 1, 2) THEN 'winter'
    WHEN month(flight_date) IN (3, 4, 5) THEN 'spring'
    WHEN month(flight_date) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season"""

# The trailing windows straight over the flights, without any roll-up.
_TRAILING = f"""{_VALID},
features AS (SELECT *,
    CAST(sum(arrival_delay_minutes) OVER r AS DOUBLE) / nullif(count(arrival_delay_minutes) OVER r, 0)
      AS route_avg_arr_delay_90d,
    CAST(sum(CASE WHEN coalesce(arrival_delay_minutes, 0) >= 15 THEN 1 ELSE 0 END) OVER r AS DOUBLE)
      / nullif(count(*) OVER r, 0) AS route_delay_rate_90d,
    CAST(sum(CASE WHEN is_on_time_arrival_flag THEN 1 ELSE 0 END) OVER c AS DOUBLE)
      / nullif(count(*) OVER c, 0) AS carrier_on_time_rate_30d,
    CAST(sum(departure_delay_minutes) OVER c AS DOUBLE)
      / nullif(count(departure_delay_minutes) OVER c, 0) AS carrier_avg_dep_delay_30d
  FROM valid
  WINDOW r AS (PARTITION BY route_code ORDER BY flight_date
      RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING),
    c AS (PARTITION BY reporting_airline ORDER BY flight_date
      RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))"""

_AIRCRAFT_CODE = "upper(regexp_extract(tail_number, '([A-Z0-9]{2,4})$', 1)) AS aircraft_code"
_SEVERITY = ("CASE flight_category WHEN 'LIFR' THEN 3 WHEN 'IFR' THEN 2 WHEN 'MVFR' THEN 1"
             " ELSE 0 END")
_AT_DEPARTURE = ("station_id = origin_airport AND observation_date = flight_date"
                 " AND h = hour(scheduled_departure_ts)")
_ORIGIN_WEATHER = f"""temp_c AS origin_temp_c, wind_speed_kt AS origin_wind_speed_kt,
  wind_gust_kt AS origin_wind_gust_kt, visibility_statute_mi AS origin_visibility_mi,
  precip_in AS origin_precip_in, flight_category AS origin_flight_category,
  {_SEVERITY} AS origin_weather_severity"""
_COMPOSITE = """greatest(
    CASE WHEN wind_speed_kt >= 35 THEN 3 WHEN wind_speed_kt >= 25 THEN 2
      WHEN wind_speed_kt >= 15 THEN 1 ELSE 0 END,
    CASE WHEN visibility_statute_mi < 1 THEN 3 WHEN visibility_statute_mi < 3 THEN 2
      WHEN visibility_statute_mi < 5 THEN 1 ELSE 0 END,
    CASE WHEN precip_in >= 0.3 THEN 3 WHEN precip_in >= 0.1 THEN 2
      WHEN precip_in >= 0.01 THEN 1 ELSE 0 END)"""


def _count_if(condition: str, name: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT) AS {name}"


def _total(cause: str) -> str:
    return (f"CAST(sum(coalesce({cause}_delay_minutes, 0)) AS BIGINT)"
            f" AS total_{cause}_delay_minutes")


_COUNTS = f"""count(*) AS total_flights, {_count_if('cancelled = 0', 'completed_flights')},
  {_count_if('cancelled = 1', 'cancelled_flights')}"""

# Dimensions -------------------------------------------------------------------------------

_AIRPORT_KEY = "upper(iata_code), upper(icao_code), upper(ident)"

SQL: dict[str, str] = {}

SQL["on_time_daily"] = f"""WITH {_VALID}
SELECT flight_date, reporting_airline, {_COUNTS},
  {_count_if('diverted_flag', 'diverted_flights')},
  {_count_if('departure_delay_minutes > 15', 'delayed_departure_flights')},
  {_count_if('arrival_delay_minutes > 15', 'delayed_arrival_flights')},
  {_count_if('is_on_time_departure_flag', 'on_time_departure_flights')},
  {_count_if('is_on_time_arrival_flag', 'on_time_arrival_flights')},
  CASE WHEN count(*) FILTER (WHERE cancelled = 0) > 0
    THEN count(*) FILTER (WHERE is_on_time_arrival_flag) * CAST(100.0 AS DOUBLE)
      / count(*) FILTER (WHERE cancelled = 0)
    ELSE CAST(0.0 AS DOUBLE) END AS on_time_arrival_percentage,
  avg(departure_delay_minutes) AS avg_departure_delay_minutes,
  avg(arrival_delay_minutes) AS avg_arrival_delay_minutes,
  {_total('weather')}, {_total('carrier')}, {_total('nas')}, {_total('security')},
  {_total('late_aircraft')}
FROM valid GROUP BY flight_date, reporting_airline"""

SQL["route_delay"] = f"""WITH {_VALID}
SELECT flight_date, route_code, origin_airport, dest_airport, reporting_airline, {_COUNTS},
  {_count_if('arrival_delay_minutes > 15', 'delayed_arrival_flights')},
  avg(departure_delay_minutes) AS avg_departure_delay_minutes,
  avg(arrival_delay_minutes) AS avg_arrival_delay_minutes,
  max(arrival_delay_minutes) AS max_arrival_delay_minutes,
  {_total('weather')}, {_total('carrier')}, {_total('late_aircraft')}
FROM valid GROUP BY flight_date, route_code, origin_airport, dest_airport, reporting_airline"""

SQL["airport_delay"] = f"""WITH {_VALID},
visits AS (
  SELECT *, origin_airport AS airport_code, 'DEPARTURE' AS airport_role,
    is_on_time_departure_flag AS punctual, coalesce(departure_delay_minutes, 0) AS delay FROM valid
  UNION ALL BY NAME
  SELECT *, dest_airport AS airport_code, 'ARRIVAL' AS airport_role,
    is_on_time_arrival_flag AS punctual, coalesce(arrival_delay_minutes, 0) AS delay FROM valid)
SELECT flight_date, airport_code, airport_role, reporting_airline, {_COUNTS},
  {_count_if('delay > 15', 'delayed_flights')}, {_count_if('punctual', 'on_time_flights')},
  avg(delay) AS avg_delay_minutes, max(delay) AS max_delay_minutes,
  {_total('weather')}, {_total('carrier')}, {_total('late_aircraft')}
FROM visits GROUP BY flight_date, airport_code, airport_role, reporting_airline"""

SQL["cancellations"] = f"""WITH {_VALID}
SELECT flight_date, reporting_airline, origin_airport, dest_airport, cancellation_code,
  count(*) AS cancellation_count,
  CASE cancellation_code WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather'
    WHEN 'C' THEN 'National Air System' WHEN 'D' THEN 'Security' ELSE 'Unknown' END
    AS cancellation_reason
FROM valid WHERE cancelled = 1
GROUP BY flight_date, reporting_airline, origin_airport, dest_airport, cancellation_code"""

SQL["flight_valid"] = f"WITH {_VALID} SELECT {FLIGHT_COLUMNS} FROM valid"

SQL["flight_quarantine"] = f"""WITH {_CLASSIFIED}
SELECT {QUARANTINE_COLUMNS} FROM classified WHERE quality_issue_reason IS NOT NULL"""

SQL["quarantine_by_reason"] = f"""WITH {_CLASSIFIED}
SELECT quality_issue_reason, count(*) AS flights, min(flight_date) AS first_date,
  max(flight_date) AS last_date
FROM classified WHERE quality_issue_reason IS NOT NULL GROUP BY quality_issue_reason"""

SQL["outlier_quarantine"] = f"""WITH {_CLASSIFIED}
SELECT coalesce(quality_issue_reason, 'OUTLIER') AS quality_issue_reason, count(*) AS flights
FROM classified WHERE quality_issue_reason IS NOT NULL
  OR arrival_delay_minutes > 25 OR taxi_out_minutes < 10
GROUP BY 1"""

SQL["latest_by_key"] = """SELECT * EXCLUDE (place) FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
        l_extendedprice DESC NULLS LAST) AS place
  FROM lineitem) WHERE place = 1"""

SQL["route_reference"] = f"""WITH {_VALID}
SELECT origin_airport, dest_airport, route_code, origin_airport || '_' || dest_airport AS route_group,
  min(flight_date) AS first_seen_flight_date, max(flight_date) AS last_seen_flight_date,
  count(*) AS total_record_count, max(ingestion_timestamp) AS ingestion_timestamp,
  max(batch_id) AS batch_id
FROM valid GROUP BY origin_airport, dest_airport, route_code"""

SQL["airports_clean"] = f"""WITH airports AS ({AIRPORTS_SQL})
SELECT upper(iata_code) AS airport_iata_code, upper(icao_code) AS airport_icao_code,
  upper(ident) AS airport_ident, name AS airport_name, type AS airport_type, municipality,
  upper(iso_country) AS iso_country, upper(iso_region) AS iso_region,
  upper(continent) AS continent, latitude_deg, longitude_deg, elevation_ft,
  lower(coalesce(scheduled_service, 'no')) = 'yes' AS scheduled_service_flag,
  ingestion_timestamp, batch_id
FROM (SELECT *, row_number() OVER (PARTITION BY {_AIRPORT_KEY} {_LATEST}) AS place
  FROM airports WHERE iata_code IS NOT NULL OR icao_code IS NOT NULL) WHERE place = 1"""

SQL["aircraft_clean"] = f"""WITH aircraft AS ({AIRCRAFT_SQL})
SELECT upper(aircraft_code) AS aircraft_code, aircraft_name, upper(iata_code) AS iata_code,
  upper(icao_code) AS icao_code, ingestion_timestamp, batch_id
FROM (SELECT *, row_number() OVER (PARTITION BY upper(aircraft_code) {_LATEST}) AS place
  FROM aircraft WHERE aircraft_code IS NOT NULL) WHERE place = 1"""

SQL["weather_clean"] = f"""WITH {_WEATHER}
SELECT station_id, observation_time, observation_date, temp_c, dewpoint_c, wind_dir_degrees,
  wind_speed_kt, wind_gust_kt, visibility_statute_mi, altim_in_hg, flight_category, precip_in,
  sky_cover, ingestion_timestamp, batch_id FROM weather"""

_ID = "flight_date, reporting_airline, flight_number, origin_airport, dest_airport"

SQL["temporal_features"] = f"WITH {_VALID} SELECT {_ID}, {_TEMPORAL} FROM valid"

SQL["route_trailing_90d"] = f"""WITH {_TRAILING}
SELECT DISTINCT route_code, flight_date, route_avg_arr_delay_90d, route_delay_rate_90d
FROM features"""

SQL["carrier_trailing_30d"] = f"""WITH {_TRAILING}
SELECT DISTINCT reporting_airline, flight_date, carrier_on_time_rate_30d, carrier_avg_dep_delay_30d
FROM features"""

SQL["aircraft_code"] = f"""WITH {_VALID}
SELECT {_AIRCRAFT_CODE}, count(*) AS flights FROM valid GROUP BY 1"""

SQL["weather_join"] = f"""WITH {_VALID}, {_HOURS}
SELECT {_ID}, {_ORIGIN_WEATHER} FROM valid LEFT JOIN hours ON {_AT_DEPARTURE}"""

SQL["weather_join_fanout"] = f"""WITH {_VALID}, {_WEATHER},
matches AS (SELECT {_ID}, count(station_id) AS reports_in_hour FROM valid LEFT JOIN weather
  ON station_id = origin_airport AND observation_date = flight_date
    AND hour(observation_time) = hour(scheduled_departure_ts) GROUP BY ALL)
SELECT reports_in_hour, count(*) AS flights,
  CAST(sum(greatest(reports_in_hour, 1)) AS BIGINT) AS joined_rows
FROM matches GROUP BY reports_in_hour"""

SQL["weather_daily_join"] = f"""WITH {_VALID}, {_WEATHER},
days AS (SELECT station_id, observation_date, count(*) AS reports,
    max(wind_speed_kt) AS max_wind_speed_kt, min(visibility_statute_mi) AS min_visibility_mi,
    max(precip_in) AS max_precip_in, max({_COMPOSITE}) AS worst_severity
  FROM weather GROUP BY station_id, observation_date)
SELECT {_ID}, reports, max_wind_speed_kt, min_visibility_mi, max_precip_in, worst_severity
FROM valid LEFT JOIN days ON station_id = origin_airport AND observation_date = flight_date"""

SQL["weather_severity"] = f"""WITH {_WEATHER}
SELECT station_id, {_SEVERITY} AS severity, count(*) AS reports FROM weather GROUP BY ALL"""

SQL["weather_severity_composite"] = f"""WITH {_WEATHER}
SELECT station_id, {_COMPOSITE} AS severity, count(*) AS reports FROM weather GROUP BY ALL"""

SQL["station_mapping"] = f"""WITH {_WEATHER}, airports AS ({AIRPORTS_SQL}),
codes AS (SELECT 'N' || lpad(substr(icao_code, 3), 2, '0') AS icao, min(upper(iata_code)) AS iata
  FROM airports WHERE iata_code IS NOT NULL AND icao_code IS NOT NULL GROUP BY 1)
SELECT coalesce(iata, station_id) AS station_id, observation_date, count(*) AS reports
FROM weather LEFT JOIN codes ON icao = station_id GROUP BY 1, 2"""

SQL["ml_features"] = f"""WITH {_TRAILING}, {_HOURS}
SELECT {_ID}, route_code, tail_number, {_TEMPORAL}, route_avg_arr_delay_90d,
  route_delay_rate_90d, carrier_on_time_rate_30d, carrier_avg_dep_delay_30d, distance_miles,
  {_AIRCRAFT_CODE}, {_ORIGIN_WEATHER}, coalesce(arrival_delay_minutes, 0) >= 15 AS is_delayed,
  f.ingestion_timestamp, f.batch_id, year_month
FROM features f LEFT JOIN hours ON {_AT_DEPARTURE}"""

# The gold table has its averages with two decimals, halves rounded away from zero: stated in
# integers, which no sum of doubles can blur.


def _hundredths(total: str, n: str) -> str:
    return f"CAST(sign({total}) * ((200 * abs({total}) + {n}) // (2 * {n})) AS DOUBLE) / 100"


SQL["layers_on_time"] = f"""WITH {_VALID},
d AS (SELECT flight_date, reporting_airline, {_COUNTS},
    {_count_if('diverted_flag', 'diverted_flights')},
    {_count_if('departure_delay_minutes > 15', 'delayed_departure_flights')},
    {_count_if('arrival_delay_minutes > 15', 'delayed_arrival_flights')},
    {_count_if('is_on_time_departure_flag', 'on_time_departure_flights')},
    {_count_if('is_on_time_arrival_flag', 'on_time_arrival_flights')},
    CAST(sum(departure_delay_minutes) AS BIGINT) AS dep, count(departure_delay_minutes) AS deps,
    CAST(sum(arrival_delay_minutes) AS BIGINT) AS arr, count(arrival_delay_minutes) AS arrs,
    {_total('weather')}, {_total('carrier')}, {_total('nas')}, {_total('security')},
    {_total('late_aircraft')}
  FROM valid GROUP BY flight_date, reporting_airline)
SELECT * EXCLUDE (dep, deps, arr, arrs), CASE WHEN completed_flights > 0
    THEN {_hundredths('(100 * on_time_arrival_flights)', 'completed_flights')} ELSE 0 END
    AS on_time_arrival_percentage,
  CASE WHEN deps > 0 THEN {_hundredths('dep', 'deps')} END AS avg_departure_delay_minutes,
  CASE WHEN arrs > 0 THEN {_hundredths('arr', 'arrs')} END AS avg_arrival_delay_minutes
FROM d"""

# Ingestion and versioned tables ---------------------------------------------------------

_DIRTY_EVENTS = """dirty AS (SELECT CAST(event_id AS VARCHAR) AS event_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type,
    CASE WHEN event_id % 23 = 3 THEN 'u' || user_id ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_type = 'error' AND event_id % 17 < 4 THEN 'n/a'
      ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS value
  FROM events),
judged AS (SELECT *, user_id LIKE 'u%' AS odd_user, value = 'n/a' AS odd_value FROM dirty)"""
_TYPED = """CAST(event_id AS BIGINT) AS event_id, CAST(ts AS TIMESTAMP) AS ts,
  TRY_CAST(user_id AS BIGINT) AS user_id, event_type, TRY_CAST(value AS DOUBLE) AS value"""
_RESCUED = """CASE WHEN odd_user AND odd_value THEN '{"user_id":"' || user_id || '","value":"n/a"}'
  WHEN odd_user THEN '{"user_id":"' || user_id || '"}'
  WHEN odd_value THEN '{"value":"n/a"}' END AS rescued_data"""

SQL["rescued_split"] = f"""WITH {_DIRTY_EVENTS}
SELECT {_TYPED}, CASE WHEN odd_user OR odd_value THEN 'rescued' ELSE 'clean' END AS lane, {_RESCUED}
FROM judged"""

SQL["rejected_records"] = f"""WITH {_DIRTY_EVENTS}
SELECT 'bronze.events_raw' AS source_table, 'app' AS source_system,
  'events_' || event_type || '.csv' AS source_file_name, {_RESCUED},
  '{{"event_id":"' || event_id || '","ts":"' || ts || '","user_id":"' || user_id
    || '","event_type":"' || event_type || '","value":"' || value || '"}}' AS raw_payload,
  'b1' AS batch_id
FROM judged WHERE odd_user OR odd_value"""

SQL["align_schema"] = """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,
  CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
  CAST(NULL AS VARCHAR) AS l_note, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem"""

SQL["enrich_metadata"] = """SELECT event_id,
  CASE WHEN event_type = 'view' THEN 'landed.csv' ELSE event_type END AS source_file_name,
  ts AS ingestion_timestamp,
  CASE WHEN event_type = 'click' THEN 'run-1' ELSE 'b_' || event_type END AS batch_id,
  'app' AS source_system FROM events"""

_ORDERS = """batches AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    'b' || CAST(year(o_orderdate) AS VARCHAR) AS batch_id FROM orders)"""

SQL["replace_batch"] = f"""WITH {_ORDERS}
SELECT * REPLACE (CASE WHEN batch_id = 'b1995' THEN CAST(0 AS DOUBLE) ELSE o_totalprice END
  AS o_totalprice) FROM batches"""

SQL["delete_batch"] = f"WITH {_ORDERS} SELECT * FROM batches WHERE batch_id NOT IN ('b1995', 'b1996')"

SQL["append_batches"] = f"WITH {_ORDERS} SELECT * FROM batches"

SQL["append_and_compact"] = f"WITH {_ORDERS} SELECT * FROM batches"

SQL["evolve_schema"] = f"""WITH {_ORDERS}
SELECT *, CASE WHEN batch_id <> 'b1995' THEN upper(o_orderstatus) END AS priority FROM batches"""

SQL["upsert"] = """SELECT c_custkey, c_name, c_acctbal,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'MACHINERY' ELSE c_mktsegment END AS c_mktsegment
FROM customer
UNION ALL SELECT -1 - c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
UNION ALL (SELECT NULL, c_name, c_acctbal, c_mktsegment FROM customer
  ORDER BY c_acctbal DESC, c_name DESC LIMIT 1)"""

SQL["surrogate_keys"] = """SELECT count(*) AS keys, count(*) AS customers,
  CAST(1 AS BIGINT) AS customers_per_key FROM customer"""

SQL["restore_version"] = f"WITH {_ORDERS} SELECT * FROM batches"

SQL["table_history"] = """WITH n AS (SELECT count(*) AS n FROM orders)
SELECT CAST(0 AS BIGINT) AS version, 'create' AS operation, CAST(0 AS BIGINT) AS rows_written,
  CAST(0 AS BIGINT) AS rows_removed
UNION ALL SELECT 1, 'overwrite', n, 0 FROM n
UNION ALL SELECT 2, 'append', n, 0 FROM n
UNION ALL SELECT 3, 'restore 1', 0, n FROM n"""

SQL["stage_rollback_audit"] = """WITH n AS (SELECT count(*) AS n FROM orders),
log AS (
  SELECT 'load' AS stage_name, 'r1' AS run_id, 'STARTED' AS status,
    CAST(NULL AS BIGINT) AS rows_written, CAST(NULL AS BIGINT) AS rows_removed,
    CAST(NULL AS BIGINT) AS restored_version, CAST(NULL AS VARCHAR) AS error_message, n AS rows_kept
  FROM n
  UNION ALL SELECT 'load', 'r1', 'SUCCESS', n, 0, NULL, NULL, n FROM n
  UNION ALL SELECT 'poison', 'r2', 'STARTED', NULL, NULL, NULL, NULL, NULL
  UNION ALL SELECT 'poison', 'r2', 'FAILED', NULL, NULL, 1, 'upstream file is broken', NULL)
SELECT 'orders' AS pipeline_name, 'work.orders' AS target_table, * FROM log"""


def _ingested(kind: str, batch: str) -> str:
    return f"""WITH {_DIRTY_EVENTS}
SELECT {_TYPED}, 'events.{kind}' AS source_file_name, 'app' AS source_system, '{batch}' AS batch_id,
  nullif((SELECT count(*) FROM judged WHERE odd_user OR odd_value), 0) AS rejected
FROM judged WHERE NOT odd_user AND NOT odd_value"""


SQL["csv_ingest"] = _ingested("csv", "b1")
SQL["jsonl_ingest"] = _ingested("jsonl", "b1")
SQL["mixed_ingest"] = _ingested("mixed", "b1")
SQL["stream_ingest"] = _ingested("csv", "events-0")

# Quality, drift and predictions ------------------------------------------------------------

_EXPECTATIONS = {
    "flight_number_present": "trim(flight_number) <> ''",
    "airports_differ": "origin_airport <> dest_airport",
    "arrival_after_departure": "scheduled_arrival_ts >= scheduled_departure_ts",
    "cancelled_known": "cancelled IS NOT NULL",
    "delay_in_range": "arrival_delay_minutes BETWEEN -60 AND 600",
}
SQL["expectations"] = f"WITH {_CLASSIFIED}\n" + "\nUNION ALL ".join(
    f"""SELECT '{name}' AS expectation, count(*) AS checked_rows,
  {_count_if(f'NOT coalesce({text}, false)', 'failed_rows')},
  count(*) FILTER (WHERE NOT coalesce({text}, false)) = 0 AS passed FROM classified"""
    for name, text in _EXPECTATIONS.items()
)

_BASELINE = f"""{_TRAILING},
scored AS (SELECT *, coalesce(route_delay_rate_90d, 0) AS delay_probability,
    coalesce(route_delay_rate_90d, 0) >= 0.4 AS predicted_delayed,
    coalesce(arrival_delay_minutes, 0) >= 15 AS is_delayed FROM features)"""


def _prediction_summary(key: str) -> str:
    return f"""WITH {_BASELINE}
SELECT {key}, count(*) AS flights,
  CAST(sum(CAST(floor(delay_probability * 1e12 + 0.5) AS HUGEINT)) AS DOUBLE)
    / (count(delay_probability) * 1e12) AS avg_delay_probability,
  {_count_if('predicted_delayed', 'predicted_delayed_flights')}
FROM scored GROUP BY {key}"""


SQL["prediction_trend"] = _prediction_summary("flight_date")
SQL["route_probability"] = _prediction_summary("route_code")

_ACCURACY = """CAST(count(*) FILTER (WHERE predicted_delayed = is_delayed) AS DOUBLE)
    / nullif(count(*), 0)"""
SQL["retrain_decision"] = f"""WITH {_BASELINE}
SELECT count(*) AS evaluated, {_count_if('predicted_delayed = is_delayed', 'correct')},
  {_ACCURACY} AS accuracy, CAST(0.75 AS DOUBLE) AS min_accuracy, {_ACCURACY} < 0.75 AS retrain
FROM scored"""

SQL["baseline_metrics"] = f"""WITH {_BASELINE},
c AS (SELECT count(*) AS evaluated, {_count_if('predicted_delayed = is_delayed', 'correct')},
    {_count_if('predicted_delayed AND is_delayed', 'hits')},
    {_count_if('predicted_delayed', 'flagged')}, {_count_if('is_delayed', 'delayed')} FROM scored)
SELECT *, CAST(correct AS DOUBLE) / nullif(evaluated, 0) AS accuracy,
  CAST(hits AS DOUBLE) / nullif(flagged, 0) AS precision,
  CAST(hits AS DOUBLE) / nullif(delayed, 0) AS recall,
  CAST(2 * hits AS DOUBLE) / nullif(flagged + delayed, 0) AS f1 FROM c"""

SQL["training_checks"] = f"""WITH {_VALID},
days AS (SELECT flight_date - DATE '1970-01-01' AS day, coalesce(arrival_delay_minutes, 0) >= 15 AS late
  FROM valid),
newer AS (SELECT late FROM days WHERE day > (SELECT floor(quantile_cont(day, 0.8)) FROM days)),
c AS (SELECT count(*) AS evaluated, {_count_if('late', 'delayed')} FROM newer)
SELECT '1' AS model_version, evaluated, delayed, evaluated AS matrix_flights, delayed AS matrix_delayed,
  CAST(19 AS INTEGER) AS features, true AS importances_sum_to_one, true AS learns FROM c"""

SQL["prediction_checks"] = f"""WITH {_VALID}
SELECT flight_date, '1' AS model_version, count(*) AS flights, count(*) AS probabilities,
  count(*) AS flags_that_follow FROM valid GROUP BY flight_date"""

_DRIFT_NUMBERS = ("departure_delay_minutes", "arrival_delay_minutes", "distance_miles", "dep_hour")
_DRIFT_TEXTS = ("reporting_airline", "season", "dep_hour_bucket")
_BINNED = "\n  UNION ALL ".join(
    [f"""SELECT '{name}' AS feature, current, CASE WHEN {name} IS NULL THEN '-1' ELSE
      CAST(CAST(greatest(0, least(9, floor((CAST({name} AS DOUBLE) - low) / (high - low) * 10)))
        AS INTEGER) AS VARCHAR) END AS bin
    FROM flagged, (SELECT CAST(min({name}) AS DOUBLE) AS low, CAST(max({name}) AS DOUBLE) AS high
      FROM flagged WHERE NOT current)""" for name in _DRIFT_NUMBERS]
    + [f"SELECT '{name}', current, {name} FROM flagged" for name in _DRIFT_TEXTS]
)
SQL["drift_psi"] = f"""WITH {_VALID},
flagged AS (SELECT *, flight_date >= DATE '1999-01-01' AS current
  FROM (SELECT * EXCLUDE (year_month), {_TEMPORAL} FROM valid)),
binned AS ({_BINNED}),
counted AS (SELECT feature, bin, count(*) FILTER (WHERE NOT current) AS before,
    count(*) FILTER (WHERE current) AS now FROM binned GROUP BY feature, bin),
shares AS (SELECT feature, CAST(before AS DOUBLE) / sum(before) OVER f AS p,
    CAST(now AS DOUBLE) / sum(now) OVER f AS q FROM counted WINDOW f AS (PARTITION BY feature)),
measured AS (SELECT feature, CASE WHEN feature IN {_DRIFT_NUMBERS} THEN 'psi' ELSE 'variation' END AS measure,
    CASE WHEN feature IN {_DRIFT_NUMBERS}
      THEN round(sum((greatest(q, 0.0001) - greatest(p, 0.0001))
        * ln(greatest(q, 0.0001) / greatest(p, 0.0001))), 6)
      ELSE round(sum(abs(q - p)) / 2, 6) END AS distance
  FROM shares GROUP BY feature)
SELECT *, distance > 0.2 AS drifted FROM measured"""


SQL["catalog_replace"] = f"""WITH {_ORDERS}
SELECT * REPLACE (CASE WHEN batch_id IN ('b1995', 'b1996') THEN CAST(0 AS DOUBLE) ELSE o_totalprice END
  AS o_totalprice) FROM batches WHERE batch_id <> 'b1997'"""

SQL["catalog_overwrite"] = f"""WITH {_ORDERS}
SELECT batch_id, count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS customers
FROM batches WHERE o_orderstatus <> 'P' GROUP BY batch_id"""

SQL["column_list_insert"] = """SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
  c_mktsegment FROM customer"""

SQL["dense_keys"] = """SELECT c_custkey, c_mktsegment, row_number() OVER (
  ORDER BY c_mktsegment NOT IN ('BUILDING', 'MACHINERY'), c_custkey) AS customer_key FROM customer"""

_ADDENDS = ", ".join(
    f"('0x' || substr(d, {first}, 15))::BIGINT::HUGEINT AS {name}" for name, first in (("a", 1), ("b", 16)))

SQL["dataset_fingerprint"] = f"""WITH {_ORDERS},
hashed AS (SELECT batch_id, {_ADDENDS} FROM (SELECT batch_id, md5(CAST(to_json({{'batch_id': batch_id,
  'o_custkey': o_custkey, 'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus}}) AS VARCHAR)) AS d FROM batches))
SELECT batch_id, count(*) AS rows, CAST(sum(a) % 1152921504606846976 AS BIGINT) AS high,
  CAST(sum(b) % 1152921504606846976 AS BIGINT) AS low FROM hashed GROUP BY GROUPING SETS (batch_id, ())"""

SQL["baseline_area"] = f"""WITH {_BASELINE},
placed AS (SELECT is_delayed, rank() OVER (ORDER BY delay_probability) AS low,
    count(*) OVER (PARTITION BY delay_probability) AS ties FROM scored),
sums AS (SELECT {_count_if('is_delayed', 'positives')}, {_count_if('NOT is_delayed', 'negatives')},
    sum(CASE WHEN is_delayed THEN (2 * low + ties - 1)::HUGEINT END) AS twice FROM placed)
SELECT positives, negatives, CAST(twice - positives::HUGEINT * (positives + 1) AS DOUBLE)
  / nullif(CAST(2 * positives::HUGEINT * negatives AS DOUBLE), 0) AS area FROM sums"""

SQL["drift_ks"] = f"""WITH {_VALID},
flagged AS (SELECT flight_date >= DATE '1999-01-01' AS current, departure_delay_minutes, arrival_delay_minutes,
    distance_miles, dep_hour FROM (SELECT * EXCLUDE (year_month), {_TEMPORAL} FROM valid)),
long AS ({" UNION ALL ".join(f"SELECT '{n}' AS feature, current, CAST({n} AS DOUBLE) AS value FROM flagged" for n in _DRIFT_NUMBERS)}),
shares AS (SELECT feature, value,
    count(*) FILTER (WHERE NOT current) OVER (PARTITION BY feature ORDER BY value)::HUGEINT AS b,
    count(*) FILTER (WHERE current) OVER (PARTITION BY feature ORDER BY value)::HUGEINT AS n,
    count(*) FILTER (WHERE NOT current) OVER (PARTITION BY feature) AS reference_rows,
    count(*) FILTER (WHERE current) OVER (PARTITION BY feature) AS current_rows
  FROM long WHERE value IS NOT NULL)
SELECT feature, reference_rows, current_rows, CAST(max(abs(b * current_rows - n * reference_rows)) AS DOUBLE)
  / nullif(CAST(reference_rows::HUGEINT * current_rows AS DOUBLE), 0) AS distance
FROM shares GROUP BY feature, reference_rows, current_rows"""

SQL["late_label_alarms"] = f"""WITH RECURSIVE {_BASELINE},
daily AS (SELECT CAST(flight_date + CAST(1 + coalesce(ascii(reporting_airline), 0) % 7 AS INTEGER) AS DATE) AS known_on,
    count(*) AS evaluated, {_count_if('predicted_delayed <> is_delayed', 'errors')} FROM scored GROUP BY 1),
days AS (SELECT *, row_number() OVER (ORDER BY known_on) AS i FROM daily),
fold AS (
  SELECT i, known_on, evaluated, errors, greatest(0, errors * 1000 - evaluated * 150)::BIGINT AS statistic,
    CAST(NULL AS DATE) AS alarm_on FROM days WHERE i = 1
  UNION ALL
  SELECT d.i, d.known_on, d.evaluated, d.errors,
    CASE WHEN coalesce(d.known_on - r.on_day <= 30, false) THEN 0
      ELSE greatest(0, CASE WHEN r.statistic > 5000 THEN 0 ELSE r.statistic END + d.errors * 1000 - d.evaluated * 150) END::BIGINT,
    r.on_day
  FROM (SELECT *, CASE WHEN statistic > 5000 THEN known_on ELSE alarm_on END AS on_day FROM fold) r JOIN days d ON d.i = r.i + 1)
SELECT known_on, evaluated, errors, statistic, statistic > 5000 AS retrain FROM fold"""


SQL["stream_rows"] = _ingested("csv", "events-0")

_IMPORTANCE = ("departure_delay_minutes", "dep_hour", "distance_miles", "constant")


def _rule(moved: str) -> str:
    value = {name: f"moved_{name}" if name == moved else name for name in _IMPORTANCE}
    return (f"coalesce({value['departure_delay_minutes']}, 0) + CASE WHEN {value['dep_hour']} >= 17 THEN 10 ELSE 0 END"
            f" + CASE WHEN {value['distance_miles']} > 1000 THEN 5 ELSE 0 END >= 15")


_MOVED = ", ".join(
    f"CASE WHEN lead(1) OVER w_{n} IS NULL THEN first_value({n}) OVER w_{n} ELSE lead({n}) OVER w_{n} END AS moved_{n}"
    for n in _IMPORTANCE)
_ORDERS_OF = ", ".join(f"w_{n} AS (PARTITION BY block ORDER BY md5('7/{n}/' || key))" for n in _IMPORTANCE)

SQL["rule_importance"] = f"""WITH {_VALID},
told AS (SELECT concat_ws('|', CAST(flight_date AS VARCHAR), coalesce(reporting_airline, '?'), coalesce(flight_number, '?'),
    coalesce(origin_airport, '?'), coalesce(dest_airport, '?')) AS key, departure_delay_minutes, dep_hour, distance_miles,
    1 AS constant, arrival_delay_minutes >= 15 AS label
  FROM (SELECT * EXCLUDE (year_month), {_TEMPORAL} FROM valid) WHERE arrival_delay_minutes IS NOT NULL),
blocks AS (SELECT *, substr(md5('7//' || key), 1, 2) AS block FROM told),
moved AS (SELECT *, {_MOVED} FROM blocks WINDOW {_ORDERS_OF}),
long AS ({" UNION ALL ".join(f"SELECT '{n}' AS feature, label, ({_rule('')}) AS plain, ({_rule(n)}) AS permuted FROM moved" for n in _IMPORTANCE)}),
sums AS (SELECT feature, count(*) AS rows, {_count_if('plain = label', 'correct')},
  {_count_if('permuted = label', 'correct_permuted')} FROM long GROUP BY feature)
SELECT *, CAST(correct - correct_permuted AS DOUBLE) / rows AS importance FROM sums"""


_LEAF_FEATURES = (
    ("departure_delay_minutes", (-5, 0, 5, 10, 15, 30, 60)), ("dep_hour", (6, 9, 12, 15, 18, 21)),
    ("distance_miles", (250, 500, 1000, 1500, 2000)), ("season", ("winter", "spring", "summer", "autumn")),
)
_ONE = 1 << 20  # what stands for 1 in scores and gradients


def _bin_of(name: str, cuts: tuple) -> str:
    if isinstance(cuts[0], str):
        return f"CASE {name} " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(cuts, 1)) + " ELSE 0 END"
    return f"CASE WHEN {name} IS NULL THEN 0 ELSE 1 + " + " + ".join(f"CAST({name} >= {c} AS INTEGER)" for c in cuts) + " END"


def _worth(g: str, h: str) -> str:
    return f"CAST({g} AS DOUBLE) * CAST({g} AS DOUBLE) / (CAST({h} AS DOUBLE) + {_ONE}.0)"


def _one_split(before: str, after: str) -> str:
    """The leaf of the table ``before`` with the best split, and the rows with that leaf split."""
    features = range(len(_LEAF_FEATURES))
    cells = " UNION ALL ".join(
        f"SELECT path, {f} AS feature, b{f} AS bin, count(*) AS n, sum(g) AS g, sum(h) AS h FROM {before} GROUP BY path, b{f}"
        for f in features)
    left = " OR ".join(f"(s.feature = {f} AND b{f} {'=' if isinstance(_LEAF_FEATURES[f][1][0], str) else '<='} s.bin)" for f in features)
    texts = ", ".join(str(f) for f in features if isinstance(_LEAF_FEATURES[f][1][0], str))
    return f"""cut_{after} AS (SELECT path, feature, bin, sum(n) OVER o AS n, sum(g) OVER o AS g, sum(h) OVER o AS h,
    CASE WHEN feature IN ({texts}) THEN n ELSE sum(n) OVER b END AS ln, CASE WHEN feature IN ({texts}) THEN g ELSE sum(g) OVER b END AS lg,
    CASE WHEN feature IN ({texts}) THEN h ELSE sum(h) OVER b END AS lh FROM ({cells})
  WINDOW o AS (PARTITION BY path, feature), b AS (PARTITION BY path, feature ORDER BY bin)),
split_{after} AS MATERIALIZED (SELECT * FROM (SELECT path, feature, bin, n, g, h,
    {_worth('lg', 'lh')} + {_worth('(g - lg)', '(h - lh)')} - {_worth('g', 'h')} AS gain
  FROM cut_{after} WHERE least(ln, n - ln) >= 5) WHERE gain > 0.001 * {_ONE}
  ORDER BY gain DESC, path, feature, bin LIMIT 1),
{after} AS MATERIALIZED (SELECT r.* REPLACE (CASE WHEN r.path = s.path
    THEN r.path || CASE WHEN {left} THEN 'L' ELSE 'R' END ELSE r.path END AS path)
  FROM {before} r LEFT JOIN split_{after} s ON true)"""


def _leaf_tree(number: int, before: str, leaves: int) -> tuple[str, str]:
    """The clauses of a tree over rows with scores, and a SELECT of its rows; ``scored_<number>`` has the new scores."""
    rows = [f"t{number}_{i}" for i in range(leaves)]
    chance = f"CAST(floor(1 / (1 + exp(-CAST(score AS DOUBLE) / {_ONE})) * {_ONE} + 0.5) AS BIGINT)"
    clauses = [f"""{rows[0]} AS MATERIALIZED (SELECT * EXCLUDE (p), CASE WHEN late THEN {_ONE} ELSE 0 END - p AS g,
    greatest(p * ({_ONE} - p) // {_ONE}, 1) AS h, '' AS path FROM (SELECT *, {chance} AS p FROM {before}))"""]
    clauses += [_one_split(a, b) for a, b in zip(rows, rows[1:])]
    clauses += [f"""leaves_{number} AS MATERIALIZED (SELECT path, count(*) AS n, sum(g) AS g, sum(h) AS h,
    CAST(floor(0.3 * (CAST(sum(g) AS DOUBLE) / (CAST(sum(h) AS DOUBLE) + {_ONE}.0)) * {_ONE} + 0.5) AS BIGINT) AS value
  FROM {rows[-1]} GROUP BY path)""", f"""scored_{number} AS MATERIALIZED (SELECT r.* EXCLUDE (g, h, path) REPLACE (score + value AS score)
  FROM {rows[-1]} r JOIN leaves_{number} USING (path))"""]
    parts = [f"SELECT {number} AS tree, path, feature, bin, n, g, h, NULL AS value FROM split_{b}" for b in rows[1:]]
    parts.append(f"SELECT {number}, path, NULL, NULL, n, g, h, value FROM leaves_{number}")
    return ",\n".join(clauses), " UNION ALL ".join(parts)


_TREES = [_leaf_tree(1, "scored_0", 5), _leaf_tree(2, "scored_1", 5)]
_LEAF_NAMES = "CASE feature " + " ".join(f"WHEN {i} THEN '{n}'" for i, (n, _) in enumerate(_LEAF_FEATURES)) + " END"
SQL["leaf_splits"] = f"""WITH {_VALID},
binned AS (SELECT coalesce(arrival_delay_minutes, 0) >= 15 AS late,
    {', '.join(f'{_bin_of(n, c)} AS b{i}' for i, (n, c) in enumerate(_LEAF_FEATURES))}
  FROM (SELECT * EXCLUDE (year_month), {_TEMPORAL} FROM valid)),
scored_0 AS MATERIALIZED (SELECT *, (SELECT CAST(floor(ln((count(*) FILTER (WHERE late) + 1) / (count(*) FILTER (WHERE NOT late) + 1))
    * {_ONE} + 0.5) AS BIGINT) FROM binned) AS score FROM binned),
{_TREES[0][0]},
{_TREES[1][0]}
SELECT CAST(tree AS INTEGER) AS tree, path, {_LEAF_NAMES} AS feature, CAST(bin AS INTEGER) AS bin, CAST(n AS BIGINT) AS rows,
  CAST(g AS BIGINT) AS gradient, CAST(h AS BIGINT) AS hessian, CAST(value AS BIGINT) AS value
FROM ({_TREES[0][1]} UNION ALL {_TREES[1][1]})"""

SQL["leaf_run_checks"] = f"""WITH {_VALID},
days AS (SELECT flight_date - DATE '1970-01-01' AS day, coalesce(arrival_delay_minutes, 0) >= 15 AS late FROM valid),
newer AS (SELECT late FROM days WHERE day > (SELECT floor(quantile_cont(day, 0.8)) FROM days)),
c AS (SELECT count(*) AS evaluated, {_count_if('late', 'delayed')} FROM newer)
SELECT '1' AS model_version, CAST(12 AS INTEGER) AS num_leaves, CAST(5 AS INTEGER) AS n_estimators, CAST(0.2 AS DOUBLE) AS learning_rate,
  (SELECT count(*) FROM valid) AS dataset_rows, evaluated, delayed, evaluated AS matrix_flights,
  CAST(19 AS INTEGER) AS features, true AS importances_sum_to_one, true AS leaves_within, true AS learns FROM c"""
