"""DuckDB SQL for every registered query, written independently of the Spark
code: the analogue tables are rebuilt in SQL from the driver's views and the
reference semantics are spelled out literally (e.g. the tier filter is
applied *after* de-duplication here, the Spark side drops the live tier
before it).

Averages and percentages are computed exactly in integer arithmetic and
rounded half-up, because DuckDB's AVG and decimal division return DOUBLE.
"""

from __future__ import annotations

import datetime as dt

from foehn.schema import MEASURES, MEASURE_CODES

AS_OF = dt.date(2024, 1, 30)
AS_OF_TS = "2024-01-30 12:00:00"
TIER_WHERE = {
    "historical": "ts < TIMESTAMP '2024-01-20 00:00:00'",
    "recent": "ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-28 00:00:00'",
    "now": "ts >= TIMESTAMP '2024-01-18 00:00:00'",
}
TIER_SUFFIX = {"historical": "_t_historical_2020-2029.csv", "recent": "_t_recent.csv", "now": "_t_now.csv"}
TIER_LOADED = {
    "historical": "2024-01-20 03:00:00",
    "recent": "2024-01-29 13:00:00",
    "now": "2024-01-30 11:00:00",
}
PRIORITY = {"historical": 1, "recent": 2, "now": 3}


def days_back(n: int) -> str:
    return f"DATE '{(AS_OF - dt.timedelta(days=n)).isoformat()}'"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def avg_sql(x: str, scale: int = 6) -> str:
    """Exact AVG(x) rounded half-up (away from zero) to ``scale`` digits, as DOUBLE."""
    n = f"COUNT({x})"
    big = f"CAST(SUM({x}) * 10000000000 AS HUGEINT)"  # sum at scale 10 as an integer
    den = f"(CAST({n} AS HUGEINT) * {10 ** (10 - scale)})"
    q = f"(sign({big}) * ((abs({big}) * 2 + {den}) // (2 * {den})))"
    return f"CASE WHEN {n} = 0 THEN NULL ELSE CAST({q} AS DOUBLE) / {10 ** scale}.0 END"


def pct_sql(num: str, den: str, scale: int = 2) -> str:
    """ROUND(num * 100 / den, scale) exactly, half-up, as DOUBLE (num, den >= 0)."""
    f = 10 ** scale
    q = f"((CAST({num} AS HUGEINT) * {100 * f} * 2 + CAST({den} AS HUGEINT)) // (2 * CAST({den} AS HUGEINT)))"
    return f"CAST({q} AS DOUBLE) / {f}.0"


def fill_sql(col: str) -> str:
    return pct_sql(f"COUNT({col})", "COUNT(*)")


# --- analogue tables in SQL ------------------------------------------------------

def _m(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(38,10))"


V = "CAST(value AS DECIMAL(38,10))"
MEASURE_SQL = {c: "CAST(NULL AS DECIMAL(38,10))" for c in MEASURE_CODES}
MEASURE_SQL.update(
    {
        "tre200s0": _m(f"CASE WHEN event_type <> 'error' THEN {V} - 10 END"),
        "ure200s0": _m(f"CASE WHEN event_type <> 'error' THEN {V} + 40 END"),
        "tde200s0": _m(f"CASE WHEN event_type <> 'error' THEN {V} - 15 END"),
        "prestas0": _m(f"CASE WHEN event_type <> 'signup' THEN {V} + 900 END"),
        "rre150z0": _m(f"CASE WHEN event_type = 'purchase' THEN {V} WHEN event_type = 'error' THEN NULL ELSE 0 END"),
        "fkl010z1": V,
        "fkl010z0": _m(f"{V} + {V}"),
        "gre000z0": _m(f"CASE WHEN event_type IN ('view', 'click') THEN {V} END"),
        "ods000z0": _m(f"CASE WHEN user_id % 3 = 0 THEN {V} END"),
    }
)
REF_TS = "(date_trunc('hour', ts) + to_minutes(CAST(minute(ts) - minute(ts) % 10 AS BIGINT)))"
MCOLS = ", ".join(MEASURE_CODES)
BRONZE_COLS = f"station_abbr, reference_timestamp, {MCOLS}, file_name, loaded_at"


def tier_cte(tier: str) -> str:
    sel = ",\n  ".join(f"{MEASURE_SQL[c]} AS {c}" for c in MEASURE_CODES)
    return f"""b_{tier} AS (
SELECT CAST(user_id AS VARCHAR) AS station_abbr,
  {REF_TS} AS reference_timestamp,
  {sel},
  CAST(user_id AS VARCHAR) || '/ogd-smn_' || CAST(user_id AS VARCHAR) || '{TIER_SUFFIX[tier]}' AS file_name,
  TIMESTAMP '{TIER_LOADED[tier]}' + to_minutes(CAST(user_id % 60 AS BIGINT)) AS loaded_at
FROM events WHERE {TIER_WHERE[tier]})"""


def union_cte(tiers=("historical", "recent", "now")) -> str:
    parts = [
        f"SELECT {BRONZE_COLS}, '{t}' AS data_tier, {PRIORITY[t]} AS tier_priority FROM b_{t}" for t in tiers
    ]
    return "all_m AS (\n" + "\nUNION ALL\n".join(parts) + ")"


# the row fingerprint: 60 bits of the MD5 of all measures' texts
_TEXTS = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in MEASURE_CODES)
FINGERPRINT_SQL = f"CAST('0x' || substr(md5({_TEXTS}), 1, 15) AS BIGINT)"
DEDUP_ORDER = f"tier_priority ASC, loaded_at DESC NULLS LAST, file_name ASC NULLS LAST, {FINGERPRINT_SQL} ASC"
SILVER_CTE = f"""silver AS (
SELECT {BRONZE_COLS}, data_tier FROM all_m
QUALIFY row_number() OVER (PARTITION BY station_abbr, reference_timestamp ORDER BY {DEDUP_ORDER}) = 1)"""


def fact_cte(name: str, where: str | None) -> str:
    meas = ",\n  ".join(f"{c} AS {g}" for c, g in MEASURES)
    w = f"WHERE {where}" if where else ""
    return f"""{name} AS (
SELECT station_abbr AS station_key, reference_timestamp AS measurement_timestamp,
  CAST(reference_timestamp AS DATE) AS measurement_date,
  CAST(hour(reference_timestamp) AS INTEGER) AS measurement_hour,
  CAST(dayofweek(reference_timestamp) AS INTEGER) AS day_of_week,
  CAST(month(reference_timestamp) AS INTEGER) AS measurement_month,
  CAST(year(reference_timestamp) AS INTEGER) AS measurement_year,
  {meas},
  data_tier AS source_tier, file_name AS source_file, loaded_at AS last_updated
FROM silver {w})"""


STATIONS_CTE = """stations AS (
SELECT CAST(c_custkey AS VARCHAR) AS station_abbr, c_name AS station_name, n_name AS station_canton,
  '0-20000-0-' || CAST(c_custkey AS VARCHAR) AS station_wigos_id,
  c_mktsegment AS station_type_de, c_mktsegment AS station_type_fr, c_mktsegment AS station_type_it,
  c_mktsegment AS station_type_en,
  'owner-' || CAST(n_regionkey AS VARCHAR) AS station_dataowner,
  DATE '1980-01-01' + CAST(c_custkey % 10000 AS INTEGER) AS station_data_since,
  CAST(c_acctbal AS DECIMAL(10,2)) AS station_height_masl,
  CAST(CAST(c_acctbal AS DECIMAL(10,2)) + 2 AS DECIMAL(10,2)) AS station_height_barometer_masl,
  CAST(2600000 + c_custkey AS DECIMAL(12,2)) AS station_coordinates_lv95_east,
  CAST(1200000 + c_nationkey * 1000 AS DECIMAL(12,2)) AS station_coordinates_lv95_north,
  CASE WHEN c_acctbal >= 0 THEN CAST(45 + n_regionkey AS DECIMAL(10,6)) END AS station_coordinates_wgs84_lat,
  CAST(6 + n_regionkey AS DECIMAL(10,6)) AS station_coordinates_wgs84_lon,
  'exposition-' || CAST(n_regionkey AS VARCHAR) AS station_exposition_de,
  'exposition-' || CAST(n_regionkey AS VARCHAR) AS station_exposition_fr,
  'exposition-' || CAST(n_regionkey AS VARCHAR) AS station_exposition_it,
  'exposition-' || CAST(n_regionkey AS VARCHAR) AS station_exposition_en,
  'https://stations.example/' || CAST(c_custkey AS VARCHAR) || '/de' AS station_url_de,
  'https://stations.example/' || CAST(c_custkey AS VARCHAR) || '/fr' AS station_url_fr,
  'https://stations.example/' || CAST(c_custkey AS VARCHAR) || '/it' AS station_url_it,
  'https://stations.example/' || CAST(c_custkey AS VARCHAR) || '/en' AS station_url_en,
  'ogd-smn_meta_stations.csv' AS file_name,
  TIMESTAMP '2024-01-28 02:00:00' + to_minutes(CAST(c_custkey % 1000 AS BIGINT)) AS loaded_at
FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

DIM_CTE = """dim AS (
SELECT station_abbr AS station_key, station_abbr, station_name, station_canton, station_wigos_id,
  station_type_en AS station_type, station_type_de, station_type_fr, station_type_it,
  station_dataowner AS data_owner, station_data_since AS operational_since,
  station_height_masl AS elevation_meters, station_height_barometer_masl AS barometer_elevation_meters,
  station_coordinates_wgs84_lat AS latitude, station_coordinates_wgs84_lon AS longitude,
  station_coordinates_lv95_east AS lv95_east, station_coordinates_lv95_north AS lv95_north,
  station_exposition_en AS terrain_exposition, station_exposition_de AS terrain_exposition_de,
  station_exposition_fr AS terrain_exposition_fr, station_exposition_it AS terrain_exposition_it,
  station_url_en AS info_url, station_url_de AS info_url_de, station_url_fr AS info_url_fr,
  station_url_it AS info_url_it,
  CASE WHEN station_coordinates_wgs84_lat IS NULL OR station_coordinates_wgs84_lon IS NULL
       THEN 'Incomplete' ELSE 'Complete' END AS data_quality_flag,
  file_name AS source_file, loaded_at AS last_updated
FROM stations)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BRONZE = [tier_cte(t) for t in ("historical", "recent", "now")]
SILVER = BRONZE + [union_cte(), SILVER_CTE]
FACT = SILVER + [fact_cte("fact", "data_tier IN ('historical', 'recent')")]
FACT_RT = SILVER + [fact_cte("fact", None)]
DIM = [STATIONS_CTE, DIM_CTE]

DEC_MEASURES = ", ".join(dbl(c) + f" AS {c}" for c in MEASURE_CODES)
DEC_GOLD = ", ".join(dbl(g) + f" AS {g}" for _, g in MEASURES)
FACT_COLS = (
    "station_key, measurement_timestamp, measurement_date, measurement_hour, day_of_week, "
    f"measurement_month, measurement_year, {DEC_GOLD}, source_tier, source_file, last_updated"
)

ORACLE: dict[str, str] = {}

ORACLE["canton_daily"] = with_(*FACT, *DIM) + f"""
SELECT d.station_canton, f.measurement_date,
  COUNT(DISTINCT f.station_key) AS active_stations,
  {avg_sql('f.temperature_2m')} AS avg_temperature,
  {dbl('SUM(f.precipitation_total_mm)')} AS total_precipitation,
  {dbl('MAX(f.wind_gust_peak_ms)')} AS max_wind_gust
FROM fact f JOIN dim d ON f.station_key = d.station_key
WHERE f.measurement_date >= {days_back(30)}
GROUP BY d.station_canton, f.measurement_date"""

ORACLE["canton_daily_realtime"] = with_(*FACT_RT, *DIM) + f"""
SELECT d.station_canton, f.measurement_date,
  COUNT(DISTINCT f.station_key) AS active_stations,
  {avg_sql('f.temperature_2m')} AS avg_temperature,
  {dbl('SUM(f.precipitation_total_mm)')} AS total_precipitation,
  {dbl('MAX(f.wind_gust_peak_ms)')} AS max_wind_gust
FROM fact f JOIN dim d ON f.station_key = d.station_key
WHERE f.measurement_date >= {days_back(7)}
GROUP BY d.station_canton, f.measurement_date"""

ORACLE["tier_union"] = with_(*BRONZE, union_cte()) + f"""
SELECT station_abbr, reference_timestamp, {DEC_MEASURES}, file_name, loaded_at, data_tier, tier_priority
FROM all_m"""

ORACLE["tier_dedup"] = with_(*SILVER) + f"""
SELECT station_abbr, reference_timestamp, {DEC_MEASURES}, file_name, loaded_at, data_tier FROM silver"""

ORACLE["fact_standard"] = with_(*FACT) + f"SELECT {FACT_COLS} FROM fact"
ORACLE["fact_realtime"] = with_(*FACT_RT) + f"SELECT {FACT_COLS} FROM fact"

_DIM_DEC = {"elevation_meters", "barometer_elevation_meters", "latitude", "longitude", "lv95_east", "lv95_north"}
_DIM_COLS = [
    "station_key", "station_abbr", "station_name", "station_canton", "station_wigos_id", "station_type",
    "station_type_de", "station_type_fr", "station_type_it", "data_owner", "operational_since",
    "elevation_meters", "barometer_elevation_meters", "latitude", "longitude", "lv95_east", "lv95_north",
    "terrain_exposition", "terrain_exposition_de", "terrain_exposition_fr", "terrain_exposition_it",
    "info_url", "info_url_de", "info_url_fr", "info_url_it", "data_quality_flag", "source_file", "last_updated",
]
DIM_SELECT = ", ".join(dbl(c) + f" AS {c}" if c in _DIM_DEC else c for c in _DIM_COLS)
ORACLE["dim_station"] = with_(*DIM) + f"SELECT {DIM_SELECT} FROM dim"

ORACLE["station_coverage"] = with_(*BRONZE, union_cte()) + """
SELECT data_tier, station_abbr, COUNT(*) AS record_count, MIN(reference_timestamp) AS earliest_measurement,
  MAX(reference_timestamp) AS latest_measurement,
  CAST(datediff('day', CAST(MIN(reference_timestamp) AS DATE), CAST(MAX(reference_timestamp) AS DATE)) AS INTEGER) AS days_of_data
FROM all_m GROUP BY data_tier, station_abbr"""

_fill = ",\n  ".join(f"COUNT({c}) AS {c}_count, {fill_sql(c)} AS {c}_fill_pct" for c in MEASURE_CODES)
ORACLE["fill_rates"] = with_(*BRONZE, union_cte()) + f"SELECT data_tier, COUNT(*) AS total_rows,\n  {_fill}\nFROM all_m GROUP BY data_tier"

ORACLE["duplicate_keys"] = with_(*BRONZE, union_cte()) + """
SELECT data_tier, station_abbr, reference_timestamp, COUNT(*) AS duplicate_count
FROM all_m GROUP BY data_tier, station_abbr, reference_timestamp HAVING COUNT(*) > 1"""

ORACLE["silver_duplicates"] = with_(*SILVER) + """
SELECT station_abbr, reference_timestamp, COUNT(*) AS duplicate_count
FROM silver GROUP BY station_abbr, reference_timestamp HAVING COUNT(*) > 1"""

ORACLE["tier_overlap"] = with_(*BRONZE, union_cte()) + """
SELECT station_abbr, reference_timestamp, COUNT(DISTINCT data_tier) AS tier_count,
  string_agg(DISTINCT data_tier, ', ' ORDER BY data_tier) AS tiers_present
FROM all_m GROUP BY station_abbr, reference_timestamp HAVING COUNT(DISTINCT data_tier) > 1"""

ORACLE["station_completeness"] = with_(*SILVER) + f"""
SELECT station_abbr, COUNT(*) AS total_records, MIN(reference_timestamp) AS earliest_measurement,
  MAX(reference_timestamp) AS latest_measurement,
  {fill_sql('tre200s0')} AS temp_2m_pct, {fill_sql('gre000z0')} AS solar_rad_pct,
  {fill_sql('rre150z0')} AS precip_pct, {fill_sql('prestas0')} AS pressure_pct,
  MAX(data_tier) AS latest_data_tier, arg_max(data_tier, reference_timestamp) AS tier_of_latest,
  CAST(datediff('day', CAST(MIN(reference_timestamp) AS DATE), CAST(MAX(reference_timestamp) AS DATE)) AS INTEGER) AS days_covered
FROM silver GROUP BY station_abbr"""

ORACLE["tier_counts"] = with_(*SILVER) + """
SELECT data_tier, COUNT(*) AS record_count, MIN(reference_timestamp) AS earliest, MAX(reference_timestamp) AS latest
FROM silver GROUP BY data_tier"""

ORACLE["fact_tier_counts"] = with_(*FACT) + """
SELECT source_tier, COUNT(*) AS record_count, MIN(measurement_timestamp) AS earliest, MAX(measurement_timestamp) AS latest
FROM fact GROUP BY source_tier"""

ORACLE["row_count"] = with_(*SILVER) + "SELECT COUNT(*) AS total_records FROM silver"

ORACLE["stations_per_canton"] = with_(STATIONS_CTE) + """
SELECT station_canton, COUNT(*) AS station_count FROM stations GROUP BY station_canton"""

ORACLE["freshness"] = with_(STATIONS_CTE) + """
SELECT COUNT(*) AS station_count, MAX(loaded_at) AS last_refresh FROM stations"""

ORACLE["station_inventory"] = with_(*DIM) + f"""
SELECT station_canton, COUNT(*) AS station_count,
  {avg_sql('CAST(elevation_meters AS DECIMAL(38,10))')} AS avg_elevation,
  MIN(operational_since) AS oldest_station
FROM dim GROUP BY station_canton"""

ORACLE["quality_flags"] = with_(*DIM) + """
SELECT data_quality_flag, COUNT(*) AS station_count FROM dim GROUP BY data_quality_flag"""

ORACLE["high_elevation"] = with_(*DIM) + f"""
SELECT station_name, station_canton, {dbl('elevation_meters')} AS elevation_meters, terrain_exposition
FROM dim WHERE elevation_meters > 2000"""

ORACLE["missing_coordinates"] = with_(*DIM) + """
SELECT station_key, station_name, data_quality_flag FROM dim WHERE data_quality_flag = 'Incomplete'"""

ORACLE["newest_stations"] = with_(*DIM) + """
SELECT station_key, station_name, station_canton, last_updated FROM dim
ORDER BY last_updated DESC NULLS FIRST, station_key ASC LIMIT 10"""

ORACLE["station_lookup"] = with_(*DIM) + f"SELECT {DIM_SELECT} FROM dim WHERE station_key = '1'"

ORACLE["recent_measurements"] = with_(*FACT) + f"""
SELECT station_key, measurement_timestamp, {dbl('temperature_2m')} AS temperature_2m,
  {dbl('precipitation_total_mm')} AS precipitation_total_mm, {dbl('wind_speed_mean_ms')} AS wind_speed_mean_ms
FROM fact WHERE measurement_date >= {days_back(7)}"""

ORACLE["daily_station"] = with_(*FACT) + f"""
SELECT station_key, measurement_date, {avg_sql('temperature_2m')} AS avg_temperature,
  {dbl('MAX(temperature_2m)')} AS max_temperature, {dbl('MIN(temperature_2m)')} AS min_temperature,
  {dbl('SUM(precipitation_total_mm)')} AS total_precipitation, {avg_sql('wind_speed_mean_ms')} AS avg_wind_speed
FROM fact WHERE measurement_date >= {days_back(30)} GROUP BY station_key, measurement_date"""

_HOURLY = f"""
SELECT d.station_name, d.station_canton, f.measurement_date, f.measurement_hour,
  {avg_sql('f.temperature_2m')} AS avg_temp, {avg_sql('f.relative_humidity_pct')} AS avg_humidity,
  {dbl('SUM(f.precipitation_total_mm)')} AS total_precip
FROM fact f JOIN dim d ON f.station_key = d.station_key
WHERE {{where}}
GROUP BY d.station_name, d.station_canton, f.measurement_date, f.measurement_hour"""
ORACLE["hourly_station"] = with_(*FACT, *DIM) + _HOURLY.format(where=f"f.measurement_date >= {days_back(7)}")
ORACLE["hourly_yesterday"] = with_(*FACT_RT, *DIM) + _HOURLY.format(where=f"f.measurement_date = {days_back(1)}")

ORACLE["monthly_station"] = with_(*FACT, *DIM) + f"""
SELECT d.station_name, d.station_canton, f.measurement_year, f.measurement_month,
  COUNT(*) AS measurement_count, {avg_sql('f.temperature_2m')} AS avg_temperature,
  {dbl('MAX(f.temperature_2m)')} AS max_temperature, {dbl('MIN(f.temperature_2m)')} AS min_temperature,
  {dbl('SUM(f.precipitation_total_mm)')} AS total_precipitation,
  {avg_sql('f.global_radiation_mean_wm2')} AS avg_solar_radiation
FROM fact f JOIN dim d ON f.station_key = d.station_key
WHERE f.measurement_year = {AS_OF.year}
GROUP BY d.station_name, d.station_canton, f.measurement_year, f.measurement_month"""

ORACLE["extremes_30d"] = with_(*FACT, *DIM) + f"""
SELECT d.station_name, d.station_canton,
  {dbl('MAX(f.temperature_2m)')} AS max_temperature, {dbl('MIN(f.temperature_2m)')} AS min_temperature,
  {dbl('MAX(f.wind_gust_peak_ms)')} AS max_wind_gust, {dbl('MAX(f.precipitation_total_mm)')} AS max_10min_precipitation,
  {dbl('MAX(f.snow_depth_cm)')} AS max_snow_depth
FROM fact f JOIN dim d ON f.station_key = d.station_key
WHERE f.measurement_date >= {days_back(30)}
GROUP BY d.station_name, d.station_canton"""

ORACLE["yearly_compare"] = with_(*FACT, *DIM) + f"""
SELECT d.station_name, f.measurement_year, {avg_sql('f.temperature_2m')} AS avg_temperature,
  {dbl('SUM(f.precipitation_total_mm)')} AS total_precipitation,
  {avg_sql('f.global_radiation_mean_wm2')} AS avg_solar_radiation
FROM fact f JOIN dim d ON f.station_key = d.station_key
WHERE f.measurement_year >= {AS_OF.year - 5}
GROUP BY d.station_name, f.measurement_year"""

ORACLE["measurements_per_day"] = with_(*FACT) + f"""
SELECT measurement_date, COUNT(*) AS measurement_count, COUNT(DISTINCT station_key) AS station_count
FROM fact WHERE measurement_date >= {days_back(7)} GROUP BY measurement_date"""

ORACLE["completeness_per_day"] = with_(*FACT) + f"""
SELECT measurement_date, COUNT(*) AS total_measurements, COUNT(temperature_2m) AS temp_measurements,
  COUNT(precipitation_total_mm) AS precip_measurements, COUNT(wind_speed_mean_ms) AS wind_measurements,
  COUNT(global_radiation_mean_wm2) AS solar_measurements, {fill_sql('temperature_2m')} AS temp_completeness_pct
FROM fact WHERE measurement_date >= {days_back(7)} GROUP BY measurement_date"""

ORACLE["series_in_list"] = with_(*FACT, *DIM) + f"""
SELECT d.station_name, f.measurement_timestamp, {dbl('f.temperature_2m')} AS temperature_2m,
  {dbl('f.relative_humidity_pct')} AS relative_humidity_pct,
  {dbl('f.precipitation_total_mm')} AS precipitation_total_mm, {dbl('f.wind_speed_mean_ms')} AS wind_speed_mean_ms
FROM fact f JOIN dim d ON f.station_key = d.station_key
WHERE f.measurement_date >= {days_back(30)} AND f.station_key IN ('1', '2', '3')"""

ORACLE["canton_series"] = with_(*FACT_RT, *DIM) + f"""
SELECT d.station_name, d.station_canton, {dbl('d.elevation_meters')} AS elevation_meters, f.measurement_timestamp,
  {dbl('f.temperature_2m')} AS temperature_2m, {dbl('f.precipitation_total_mm')} AS precipitation_total_mm,
  {dbl('f.wind_speed_mean_ms')} AS wind_speed_mean_ms
FROM fact f JOIN dim d ON f.station_key = d.station_key
WHERE f.measurement_date >= {days_back(7)} AND d.station_canton = 'NATION_3'"""

ORACLE["last_hour"] = with_(*FACT_RT) + f"""
SELECT station_key, measurement_timestamp, {dbl('temperature_2m')} AS temperature_2m,
  {dbl('precipitation_total_mm')} AS precipitation_total_mm, {dbl('wind_speed_mean_ms')} AS wind_speed_mean_ms
FROM fact WHERE measurement_timestamp >= TIMESTAMP '{AS_OF_TS}' - INTERVAL 1 HOUR"""

ORACLE["orphan_measurements"] = with_(*FACT_RT, *DIM) + """
SELECT station_key, measurement_timestamp, source_tier FROM fact f
WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.station_key = f.station_key)"""

# --- CSV parse: expected typed values recomputed from the typed events ----------

_ID = "event_id"
_STATION_OK = f"NOT ({_ID} % 101 = 0)"
_REJECT = f"CASE WHEN {_ID} % 101 = 0 THEN 'station_abbr_too_long' WHEN {_ID} % 89 = 0 THEN 'bad_reference_timestamp' END"
_SHORT = f"{_ID} % 31 = 0"


def _parsed_measure(code: str) -> str:
    base = MEASURE_SQL[code]
    if code == "tre200s0":
        base = f"CASE WHEN {_ID} % 7 = 0 OR {_ID} % 11 = 0 OR {_ID} % 13 = 0 THEN NULL ELSE {base} END"
    if code == "fkl010z1":
        # an appended 11th digit 5 rounds half-up (values here are >= 0)
        base = f"CASE WHEN {_ID} % 19 = 0 THEN {base} + CAST(0.0000000001 AS DECIMAL(38,10)) ELSE {base} END"
    return f"CASE WHEN {_SHORT} THEN NULL ELSE {dbl(base)} END AS {code}"


def _parsed(where: str | None = None) -> str:
    meas = ",\n  ".join(_parsed_measure(c) for c in MEASURE_CODES)
    w = f" AND {where}" if where else ""
    return f"""
SELECT CAST(user_id AS VARCHAR) AS station_abbr,
  CASE WHEN {_ID} % 83 = 0 THEN NULL ELSE {REF_TS} END AS reference_timestamp,
  {meas},
  CAST(user_id AS VARCHAR) || '/ogd-smn_' || CAST(user_id AS VARCHAR) || '_t_now.csv' AS file_name,
  TIMESTAMP '2024-01-30 11:30:00' AS loaded_at
FROM events WHERE {_REJECT} IS NULL{w}"""


ORACLE["csv_typed_parse"] = _parsed()
ORACLE["replace_now"] = _parsed(TIER_WHERE["now"])
ORACLE["csv_rejects"] = f"""
SELECT CAST(user_id AS VARCHAR) || '/ogd-smn_' || CAST(user_id AS VARCHAR) || '_t_now.csv' AS file_name,
  CASE WHEN {_ID} % 101 = 0 THEN 'ABCDEFGHIJK' ELSE CAST(user_id AS VARCHAR) END AS station_abbr,
  {_REJECT} AS reject_reason
FROM events WHERE {_REJECT} IS NOT NULL"""

# --- upsert on lineitem ------------------------------------------------------------

_LI_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_NONKEY = [c for c in _LI_COLS if c not in ("l_orderkey", "l_linenumber")]
_SRC_ORDER = "l_shipdate DESC NULLS LAST, " + ", ".join(f"{c} ASC NULLS LAST" for c in _NONKEY)
_UPSERT_CTES = f"""WITH t AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01 00:00:00'),
s0 AS (SELECT * REPLACE (l_quantity + 1.0 AS l_quantity) FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'
         AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL),
s AS (SELECT * FROM s0 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_SRC_ORDER}) = 1),
tk AS (SELECT DISTINCT l_orderkey, l_linenumber FROM t),
merged AS (
  SELECT {", ".join("s." + c for c in _LI_COLS)}, 'updated' AS act FROM t JOIN s USING (l_orderkey, l_linenumber)
  UNION ALL
  SELECT {", ".join("t." + c for c in _LI_COLS)}, 'unchanged' FROM t
   WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
  UNION ALL
  SELECT {", ".join("s." + c for c in _LI_COLS)}, 'inserted' FROM s
   WHERE NOT EXISTS (SELECT 1 FROM tk WHERE tk.l_orderkey = s.l_orderkey AND tk.l_linenumber = s.l_linenumber))
"""
ORACLE["upsert_recent"] = _UPSERT_CTES + f"SELECT {', '.join(_LI_COLS)} FROM merged"
ORACLE["upsert_stats"] = _UPSERT_CTES + """
SELECT CAST(count_if(act = 'inserted') AS BIGINT) AS rows_inserted, CAST(count_if(act = 'updated') AS BIGINT) AS rows_updated,
  CAST(count_if(act = 'unchanged') AS BIGINT) AS rows_unchanged, COUNT(*) AS rows_total FROM merged"""
ORACLE["source_dedup"] = _UPSERT_CTES + f"SELECT {', '.join(_LI_COLS)} FROM s"

# --- files, ledger, catalogue ------------------------------------------------------

_FILES = with_(*BRONZE) + """, ledger AS (
  SELECT 'historical' AS data_tier, file_name, COUNT(*) AS rows_loaded, MAX(loaded_at) AS loaded_at FROM b_historical GROUP BY file_name
  UNION ALL SELECT 'recent', file_name, COUNT(*), MAX(loaded_at) FROM b_recent GROUP BY file_name
  UNION ALL SELECT 'now', file_name, COUNT(*), MAX(loaded_at) FROM b_now GROUP BY file_name)
"""
ORACLE["new_files"] = _FILES + """
SELECT DISTINCT file_name FROM ledger l
WHERE NOT EXISTS (SELECT 1 FROM ledger h WHERE h.data_tier = 'historical' AND h.file_name = l.file_name)"""
ORACLE["load_history"] = _FILES + f"""
SELECT data_tier, file_name, rows_loaded, loaded_at FROM ledger
WHERE loaded_at >= TIMESTAMP '{AS_OF_TS}' - INTERVAL 1 HOUR"""

_ASSETS = with_(*BRONZE) + """, files AS (
  SELECT DISTINCT station_abbr, file_name FROM (
    SELECT station_abbr, file_name FROM b_historical UNION ALL
    SELECT station_abbr, file_name FROM b_recent UNION ALL
    SELECT station_abbr, file_name FROM b_now)),
assets AS (
  SELECT station_abbr AS station_id, 'Station ' || station_abbr AS title,
    CAST(row_number() OVER (PARTITION BY station_abbr ORDER BY split_part(file_name, '/', -1), file_name) - 1 AS INTEGER) AS asset_pos,
    split_part(file_name, '/', -1) AS asset_name,
    'https://files.example/' || file_name AS href
  FROM files)
"""
ORACLE["asset_manifest"] = _ASSETS + "SELECT station_id, title, asset_pos, asset_name, href FROM assets"
ORACLE["asset_pick"] = _ASSETS + """, tiered AS (
  SELECT *, CASE WHEN asset_name LIKE '%\\_t\\_now.csv' ESCAPE '\\' THEN 'now'
                 WHEN asset_name LIKE '%\\_t\\_recent.csv' ESCAPE '\\' THEN 'recent'
                 WHEN asset_name LIKE '%\\_t\\_historical\\_%' ESCAPE '\\' AND asset_name LIKE '%.csv' THEN 'historical'
            END AS data_tier
  FROM assets WHERE href IS NOT NULL)
SELECT station_id, data_tier, asset_name, href FROM tiered
WHERE data_tier = 'historical'
   OR (data_tier IN ('now', 'recent') AND asset_pos = (
        SELECT MIN(t2.asset_pos) FROM tiered t2 WHERE t2.station_id = tiered.station_id AND t2.data_tier = tiered.data_tier))"""


# --- station CSV parse -------------------------------------------------------------

_SKEY = "c_custkey"
_S_REJECT = (f"CASE WHEN {_SKEY} % 19 = 0 THEN 'station_name_too_long' "
             f"WHEN {_SKEY} % 23 = 0 THEN 'station_canton_too_long' END")
ORACLE["station_csv_parse"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS station_abbr, c_name AS station_name, n_name AS station_canton,
  '0-20000-0-' || CAST(c_custkey AS VARCHAR) AS station_wigos_id,
  c_mktsegment AS station_type_de, c_mktsegment AS station_type_fr, c_mktsegment AS station_type_it,
  c_mktsegment AS station_type_en, 'owner-' || CAST(n_regionkey AS VARCHAR) AS station_dataowner,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE DATE '1980-01-01' + CAST(c_custkey % 10000 AS INTEGER) END AS station_data_since,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE {dbl('CAST(c_acctbal AS DECIMAL(10,2))')} END AS station_height_masl,
  {dbl('CAST(CAST(c_acctbal AS DECIMAL(10,2)) + 2 AS DECIMAL(10,2))')} AS station_height_barometer_masl,
  {dbl('2600000 + c_custkey')} AS station_coordinates_lv95_east,
  {dbl('1200000 + c_nationkey * 1000')} AS station_coordinates_lv95_north,
  CASE WHEN c_custkey % 11 = 0 OR c_acctbal < 0 THEN NULL ELSE {dbl('45 + n_regionkey')} END AS station_coordinates_wgs84_lat,
  {dbl('6 + n_regionkey')} AS station_coordinates_wgs84_lon,
  'exposition-' || CAST(n_regionkey AS VARCHAR) AS station_exposition_de,
  'exposition-' || CAST(n_regionkey AS VARCHAR) AS station_exposition_fr,
  'exposition-' || CAST(n_regionkey AS VARCHAR) AS station_exposition_it,
  'exposition-' || CAST(n_regionkey AS VARCHAR) AS station_exposition_en,
  'https://stations.example/' || CAST(c_custkey AS VARCHAR) || '/de' AS station_url_de,
  'https://stations.example/' || CAST(c_custkey AS VARCHAR) || '/fr' AS station_url_fr,
  'https://stations.example/' || CAST(c_custkey AS VARCHAR) || '/it' AS station_url_it,
  'https://stations.example/' || CAST(c_custkey AS VARCHAR) || '/en' AS station_url_en,
  'ogd-smn_meta_stations.csv' AS file_name, TIMESTAMP '2024-01-28 02:00:00' AS loaded_at
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE {_S_REJECT} IS NULL"""
ORACLE["station_csv_rejects"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS station_abbr, {_S_REJECT} AS reject_reason
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE {_S_REJECT} IS NOT NULL"""

ORACLE["silver_station_series"] = with_(*SILVER, STATIONS_CTE) + f"""
SELECT s.station_name, s.station_canton, {dbl('s.station_height_masl')} AS station_height_masl,
  m.reference_timestamp, {dbl('m.tre200s0')} AS temperature_2m
FROM silver m JOIN stations s ON m.station_abbr = s.station_abbr
WHERE m.reference_timestamp >= {days_back(7)} AND s.station_canton = 'NATION_3'"""

ORACLE["stream_live_keys"] = with_(BRONZE[2]) + "SELECT DISTINCT station_abbr, reference_timestamp FROM b_now"
ORACLE["canton_daily_sql"] = ORACLE["canton_daily"]
ORACLE["canton_daily_materialized"] = ORACLE["canton_daily"]
ORACLE["canton_daily_bucketed"] = ORACLE["canton_daily"]
ORACLE["hourly_station_bucketed"] = ORACLE["hourly_station"]

ORACLE["monthly_station_realtime"] = ORACLE["monthly_station"].replace(with_(*FACT, *DIM), with_(*FACT_RT, *DIM), 1)
ORACLE["extremes_30d_realtime"] = ORACLE["extremes_30d"].replace(with_(*FACT, *DIM), with_(*FACT_RT, *DIM), 1)
ORACLE["series_24h_realtime"] = with_(*FACT_RT, *DIM) + f"""
SELECT d.station_name, f.measurement_timestamp, {dbl('f.temperature_2m')} AS temperature_2m,
  {dbl('f.relative_humidity_pct')} AS relative_humidity_pct,
  {dbl('f.precipitation_total_mm')} AS precipitation_total_mm, {dbl('f.wind_speed_mean_ms')} AS wind_speed_mean_ms
FROM fact f JOIN dim d ON f.station_key = d.station_key
WHERE f.measurement_timestamp >= TIMESTAMP '{AS_OF_TS}' - INTERVAL 24 HOUR AND f.station_key IN ('1', '2', '3')"""

# --- loads of landed files -----------------------------------------------------------

_BATCH_WHERE = [
    "ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-22 00:00:00'",
    "ts >= TIMESTAMP '2024-01-18 00:00:00' AND ts < TIMESTAMP '2024-01-28 00:00:00'",
]
_BATCH_LOADED = ["2024-01-22 13:00:00", "2024-01-29 13:00:00"]
_BATCHES = "WITH b AS (\n" + "\nUNION ALL\n".join(
    f"SELECT * EXCLUDE (file_name) REPLACE (TIMESTAMP '{at}' AS loaded_at), {n} AS batch FROM ({_parsed(w)})"
    for n, (w, at) in enumerate(zip(_BATCH_WHERE, _BATCH_LOADED, strict=True))
) + f"""),
k AS (SELECT *, row_number() OVER (PARTITION BY station_abbr, reference_timestamp, batch
        ORDER BY {", ".join(f"{c} ASC NULLS LAST" for c in MEASURE_CODES)}) AS rn FROM b WHERE reference_timestamp IS NOT NULL)
"""
ORACLE["landing_listing"] = "\nUNION ALL\n".join(
    f"SELECT DISTINCT 'batch-{n}/run=' || CAST(user_id AS VARCHAR) AS folder, TRUE AS has_lines FROM events WHERE {w}" for n, w in enumerate(_BATCH_WHERE)
) + "\nORDER BY folder"
ORACLE["load_recent_files"] = _BATCHES + """
SELECT * EXCLUDE (batch, rn) FROM k WHERE rn = 1
QUALIFY row_number() OVER (PARTITION BY station_abbr, reference_timestamp ORDER BY batch DESC) = 1"""
ORACLE["stream_recent_files"] = ORACLE["load_recent_files"]
ORACLE["load_now_files"] = f"SELECT * EXCLUDE (file_name) FROM ({ORACLE['replace_now']})"
ORACLE["stream_now_files"] = ORACLE["load_now_files"]
ORACLE["load_historical_files"] = f"""
SELECT * EXCLUDE (file_name) REPLACE (TIMESTAMP '2024-01-20 03:00:00' AS loaded_at) FROM ({_parsed(TIER_WHERE['historical'])})"""
ORACLE["load_stations_files"] = f"""
SELECT * EXCLUDE (file_name) REPLACE (replace(station_name, 'Customer', 'Kündin') AS station_name) FROM ({ORACLE['station_csv_parse']})"""

_HISTORICAL_PARTS = ["ts < TIMESTAMP '2024-01-10 00:00:00'", "ts >= TIMESTAMP '2024-01-10 00:00:00'", "FALSE"]
_NO_KEYS = ", ".join(f"CAST(NULL AS BIGINT) AS {c}" for c in ("rows_null_key", "rows_duplicate_key", "rows_inserted", "rows_updated"))
_LEDGER = [
    f"""SELECT 'load_stations' AS procedure, 'stations' AS data_tier, 'SUCCESS' AS status, COUNT(*) AS rows_parsed,
  COUNT({_S_REJECT}) AS rows_rejected, {_NO_KEYS}, COUNT(*) - COUNT({_S_REJECT}) AS rows_loaded
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    f"""SELECT 'load_now', 'now', 'SUCCESS', COUNT(*), COUNT({_REJECT}), {_NO_KEYS}, COUNT(*) - COUNT({_REJECT})
FROM events WHERE {TIER_WHERE['now']}""",
]
_LEDGER += [
    f"""SELECT 'load_historical', 'historical', 'SUCCESS', COUNT(*), 0, {_NO_KEYS}, COUNT(*)
FROM events WHERE {TIER_WHERE['historical']} AND {_REJECT} IS NULL AND {part}"""
    for part in _HISTORICAL_PARTS
]
_KEYS_OF = ["(SELECT DISTINCT station_abbr, reference_timestamp FROM k WHERE batch = 0)", "(SELECT DISTINCT station_abbr, reference_timestamp FROM k WHERE batch = 1)"]
_LEDGER += [
    f"""SELECT 'load_recent', 'recent', 'SUCCESS', (SELECT COUNT(*) FROM events WHERE {w}), (SELECT COUNT({_REJECT}) FROM events WHERE {w}),
  (SELECT COUNT(*) FROM b WHERE batch = {n} AND reference_timestamp IS NULL), (SELECT COUNT(*) FROM k WHERE batch = {n} AND rn > 1),
  (SELECT COUNT(*) FROM {fresh}), (SELECT COUNT(*) FROM {again}), (SELECT COUNT(*) FROM {every})"""
    for n, (w, fresh, again, every) in enumerate(
        [
            (_BATCH_WHERE[0], _KEYS_OF[0], "(SELECT 1 WHERE FALSE)", _KEYS_OF[0]),
            (_BATCH_WHERE[1], f"({_KEYS_OF[1]} EXCEPT {_KEYS_OF[0]})", f"({_KEYS_OF[1]} INTERSECT {_KEYS_OF[0]})", f"({_KEYS_OF[0]} UNION {_KEYS_OF[1]})"),
        ]
    )
]
ORACLE["load_ledger"] = _BATCHES + "\nUNION ALL\n".join(_LEDGER)
ORACLE["load_reject_summary"] = _BATCHES + f""", r AS (
SELECT 'stations' AS data_tier, {_S_REJECT} AS reason, TIMESTAMP '2024-01-28 02:00:00' AS loaded_at FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'now', {_REJECT}, TIMESTAMP '2024-01-30 11:30:00' FROM events WHERE {TIER_WHERE['now']}
UNION ALL SELECT 'recent', {_REJECT}, TIMESTAMP '{_BATCH_LOADED[0]}' FROM events WHERE {_BATCH_WHERE[0]}
UNION ALL SELECT 'recent', {_REJECT}, TIMESTAMP '{_BATCH_LOADED[1]}' FROM events WHERE {_BATCH_WHERE[1]}
UNION ALL SELECT 'recent', 'null_key', loaded_at FROM b WHERE reference_timestamp IS NULL
UNION ALL SELECT 'recent', 'duplicate_key', loaded_at FROM k WHERE rn > 1)
SELECT data_tier, reason, loaded_at, COUNT(*) AS n_rows FROM r WHERE reason IS NOT NULL GROUP BY ALL"""

# a refresh of touched days leaves what a full recompute gives
ORACLE["silver_touched_refresh"] = ORACLE["tier_dedup"]

# partials, streams and bitmaps give what the plain reports give
for _name in ("daily_station", "canton_daily", "monthly_station", "extremes_30d", "yearly_compare"):
    ORACLE[f"rollup_{_name}"] = ORACLE[_name]
ORACLE["stream_tier_dedup"] = ORACLE["tier_dedup"]
ORACLE["active_stations_monthly"] = with_(*FACT, *DIM) + """
SELECT d.station_canton, CAST(date_trunc('month', f.measurement_date) AS DATE) AS month, COUNT(DISTINCT f.station_key) AS active_stations
FROM fact f JOIN dim d ON f.station_key = d.station_key
GROUP BY GROUPING SETS ((1, 2), (2))"""

ORACLE["page_chain"] = """
WITH RECURSIVE numbered AS (
  SELECT c_nationkey AS catalogue, row_number() OVER w - 1 AS k, lead(c_custkey) OVER w IS NOT NULL AS more
  FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_custkey)),
landed AS (
  SELECT catalogue, k, CASE WHEN catalogue % 4 = 2 AND k = 7 THEN 3 WHEN more THEN k + 1 END AS next,
    CASE WHEN catalogue % 4 = 3 AND k = 4 THEN 2 ELSE 1 END AS copies
  FROM numbered WHERE NOT (catalogue % 4 = 1 AND k = 5)),
walk(catalogue, k, position) AS (
  SELECT DISTINCT catalogue, 0, 0 FROM landed
  UNION ALL SELECT w.catalogue, l.next, w.position + 1 FROM walk w JOIN landed l ON l.catalogue = w.catalogue AND l.k = w.k
  WHERE l.next > w.k),
pages AS (SELECT catalogue, k FROM landed UNION SELECT catalogue, next FROM landed WHERE next IS NOT NULL)
SELECT p.catalogue, CASE WHEN p.k > 0 THEN 'c' || CAST(p.k AS VARCHAR) END AS cursor, CAST(w.position AS BIGINT) AS position,
  CASE WHEN l.k IS NULL THEN 'missing' WHEN l.copies > 1 THEN 'repeated' WHEN w.position IS NULL THEN 'unreachable'
       WHEN v.position <= w.position THEN 'cyclic' ELSE 'ok' END AS status
FROM pages p LEFT JOIN landed l ON l.catalogue = p.catalogue AND l.k = p.k
LEFT JOIN walk w ON w.catalogue = p.catalogue AND w.k = p.k LEFT JOIN walk v ON v.catalogue = p.catalogue AND v.k = l.next"""
