"""Gold layer: business fact (P1, P2) and station dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import time_parts
from ..schema import MEASURES
from .silver import silver_measurements

STANDARD_TIERS = ("historical", "recent")
ALL_TIERS = ("historical", "recent", "now")


def fact_from_silver(silver: DataFrame) -> DataFrame:
    """39 columns - key, timestamp, 5 time parts, 29 measures, tier,
    2 audit columns.  On materialised silver the stored day partition
    column is used as ``measurement_date`` (same value), so day filters
    prune partitions."""
    ts = F.col("reference_timestamp")
    parts = time_parts(ts)
    if "measurement_date" in silver.columns:
        parts[0] = F.col("measurement_date").alias("measurement_date")
    return silver.select(
        F.col("station_abbr").alias("station_key"),
        ts.alias("measurement_timestamp"),
        *parts,
        *[F.col(code).alias(name) for code, name in MEASURES],
        F.col("data_tier").alias("source_tier"),
        F.col("file_name").alias("source_file"),
        F.col("loaded_at").alias("last_updated"),
    )


def fact_standard(tiers: dict[str, DataFrame]) -> DataFrame:
    """Standard fact: historical + recent tiers only (the live tier is never
    read, see E2)."""
    return fact_from_silver(silver_measurements(tiers, keep=STANDARD_TIERS))


def fact_realtime(tiers: dict[str, DataFrame]) -> DataFrame:
    """Realtime fact: all tiers."""
    return fact_from_silver(silver_measurements(tiers))


def fact_standard_from_silver(silver: DataFrame) -> DataFrame:
    return fact_from_silver(silver.filter(F.col("data_tier").isin(*STANDARD_TIERS)))


def dim_stations(stations: DataFrame) -> DataFrame:
    """28-column station dimension, English as default language."""
    s = F.col
    lat, lon = s("station_coordinates_wgs84_lat"), s("station_coordinates_wgs84_lon")
    return stations.select(
        s("station_abbr").alias("station_key"),
        s("station_abbr"),
        s("station_name"),
        s("station_canton"),
        s("station_wigos_id"),
        s("station_type_en").alias("station_type"),
        s("station_type_de"),
        s("station_type_fr"),
        s("station_type_it"),
        s("station_dataowner").alias("data_owner"),
        s("station_data_since").alias("operational_since"),
        s("station_height_masl").alias("elevation_meters"),
        s("station_height_barometer_masl").alias("barometer_elevation_meters"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        s("station_coordinates_lv95_east").alias("lv95_east"),
        s("station_coordinates_lv95_north").alias("lv95_north"),
        s("station_exposition_en").alias("terrain_exposition"),
        s("station_exposition_de").alias("terrain_exposition_de"),
        s("station_exposition_fr").alias("terrain_exposition_fr"),
        s("station_exposition_it").alias("terrain_exposition_it"),
        s("station_url_en").alias("info_url"),
        s("station_url_de").alias("info_url_de"),
        s("station_url_fr").alias("info_url_fr"),
        s("station_url_it").alias("info_url_it"),
        F.when(lat.isNull() | lon.isNull(), F.lit("Incomplete")).otherwise(F.lit("Complete")).alias(
            "data_quality_flag"
        ),
        s("file_name").alias("source_file"),
        s("loaded_at").alias("last_updated"),
    )
