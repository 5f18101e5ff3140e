"""Table specifications shared by every layer.

The measurement and station layouts are bound by *position* in the source
CSV files, so the order of the lists below is the contract with the files.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's file layout and gold naming).
# Measurement CSV columns 3..31, in file order, as (raw code, gold name).
# ---------------------------------------------------------------------------
MEASURES: list[tuple[str, str]] = [
    ("tre200s0", "temperature_2m"),
    ("tre005s0", "temperature_5cm"),
    ("tresurs0", "surface_temperature"),
    ("xchills0", "wind_chill_temperature"),
    ("ure200s0", "relative_humidity_pct"),
    ("tde200s0", "dew_point_2m"),
    ("pva200s0", "water_vapor_pressure_hpa"),
    ("prestas0", "pressure_station_level_hpa"),
    ("pp0qnhs0", "pressure_sea_level_qnh_hpa"),
    ("pp0qffs0", "pressure_sea_level_qff_hpa"),
    ("ppz850s0", "geopotential_height_850hpa"),
    ("ppz700s0", "geopotential_height_700hpa"),
    ("fkl010z1", "wind_speed_mean_ms"),
    ("fve010z0", "wind_speed_vector_mean_ms"),
    ("fkl010z0", "wind_gust_peak_ms"),
    ("dkl010z0", "wind_direction_mean_degrees"),
    ("wcc006s0", "cloud_cover"),
    ("fu3010z0", "wind_speed_max_ms"),
    ("fkl010z3", "wind_speed_scalar_max_ms"),
    ("fu3010z1", "wind_gust_1s_ms"),
    ("fu3010z3", "wind_gust_3s_ms"),
    ("rre150z0", "precipitation_total_mm"),
    ("htoauts0", "sunshine_duration_total_min"),
    ("gre000z0", "global_radiation_mean_wm2"),
    ("ods000z0", "snow_depth_cm"),
    ("oli000z0", "lysimeter_infiltration"),
    ("olo000z0", "lysimeter_outflow"),
    ("osr000z0", "lysimeter_storage"),
    ("sre000z0", "reflected_radiation_mean_wm2"),
]

# Station CSV columns 1..24 in file order, with type and the
# maximum text length the target columns accept (None = no limit checked).
STATION_FIELDS: list[tuple[str, str, int | None]] = [
    ("station_abbr", "string", 10),
    ("station_name", "string", 200),
    ("station_canton", "string", 10),
    ("station_wigos_id", "string", 50),
    ("station_type_de", "string", 100),
    ("station_type_fr", "string", 100),
    ("station_type_it", "string", 100),
    ("station_type_en", "string", 100),
    ("station_dataowner", "string", 100),
    ("station_data_since", "date", None),
    ("station_height_masl", "decimal(10,2)", None),
    ("station_height_barometer_masl", "decimal(10,2)", None),
    ("station_coordinates_lv95_east", "decimal(12,2)", None),
    ("station_coordinates_lv95_north", "decimal(12,2)", None),
    ("station_coordinates_wgs84_lat", "decimal(10,6)", None),
    ("station_coordinates_wgs84_lon", "decimal(10,6)", None),
    ("station_exposition_de", "string", 200),
    ("station_exposition_fr", "string", 200),
    ("station_exposition_it", "string", 200),
    ("station_exposition_en", "string", 200),
    ("station_url_de", "string", 500),
    ("station_url_fr", "string", 500),
    ("station_url_it", "string", 500),
    ("station_url_en", "string", 500),
]

# Parse rules of the source files.
NULL_TOKENS = ("", "NULL", "-")
TIMESTAMP_FORMAT = "dd.MM.yyyy HH:mm"
DATE_FORMAT = "dd.MM.yyyy"
STATION_ABBR_MAX_LEN = 10
MEASURE_TYPE = "decimal(38,10)"

# Tier names and their priority (lower wins).
TIER_PRIORITY = {"historical": 1, "recent": 2, "now": 3}
TIERS = list(TIER_PRIORITY)

KEY_COLUMNS = ["station_abbr", "reference_timestamp"]
MEASURE_CODES = [code for code, _ in MEASURES]
GOLD_NAMES = dict(MEASURES)
AUDIT_COLUMNS = ["file_name", "loaded_at"]
BRONZE_COLUMNS = KEY_COLUMNS + MEASURE_CODES + AUDIT_COLUMNS
STATION_COLUMNS = [name for name, _, _ in STATION_FIELDS]

MEASUREMENT_CSV_FIELDS = 2 + len(MEASURES)  # 31
STATION_CSV_FIELDS = len(STATION_FIELDS)  # 24


def raw_schema(n_fields: int, prefix: str = "c") -> T.StructType:
    """All-string positional schema ``c1 .. cN`` used to read CSV by position."""
    return T.StructType(
        [T.StructField(f"{prefix}{i}", T.StringType(), True) for i in range(1, n_fields + 1)]
    )


#: Column of the bronze tables that holds a row's fingerprint (see
#: ``operators.dedup.row_fingerprint``), computed once, at load.
FINGERPRINT = "row_fingerprint"


def bronze_measurement_schema(fingerprint: bool = False) -> T.StructType:
    fields = [
        T.StructField("station_abbr", T.StringType(), True),
        T.StructField("reference_timestamp", T.TimestampNTZType(), True),
    ]
    fields += [T.StructField(c, T.DecimalType(38, 10), True) for c in MEASURE_CODES]
    fields += [
        T.StructField("file_name", T.StringType(), True),
        T.StructField("loaded_at", T.TimestampNTZType(), True),
    ]
    if fingerprint:
        fields.append(T.StructField(FINGERPRINT, T.LongType(), True))
    return T.StructType(fields)


def _spark_type(name: str) -> T.DataType:
    if name == "string":
        return T.StringType()
    if name == "date":
        return T.DateType()
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    raise ValueError(f"unsupported type {name!r}")


def bronze_station_schema() -> T.StructType:
    fields = [T.StructField(n, _spark_type(t), True) for n, t, _ in STATION_FIELDS]
    fields += [
        T.StructField("file_name", T.StringType(), True),
        T.StructField("loaded_at", T.TimestampNTZType(), True),
    ]
    return T.StructType(fields)


@dataclass(frozen=True)
class TierSpec:
    """Where a tier's files land and how they are loaded."""

    name: str
    glob: str
    encoding: str = "UTF-8"
    write_mode: str = "append"  # append | upsert | replace
    strict: bool = False  # all-or-nothing on a bad row
    keys: list[str] = field(default_factory=lambda: list(KEY_COLUMNS))


# File-name patterns and load modes per tier.
TIER_SPECS = {
    "historical": TierSpec("historical", "*t_historical_*.csv", write_mode="append", strict=True),
    "recent": TierSpec("recent", "*_t_recent.csv", write_mode="upsert"),
    "now": TierSpec("now", "*_t_now.csv", write_mode="replace"),
    "stations": TierSpec(
        "stations", "*meta_stations.csv", encoding="ISO-8859-1", write_mode="replace",
        keys=["station_abbr"],
    ),
}
