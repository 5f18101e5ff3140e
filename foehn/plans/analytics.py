"""Gold analytics (A10-A17, A12-A16 with joins, F1-F9 filters, O1-O4 sorts).

Every function takes the fact and/or dimension DataFrames and an explicit
``as_of`` (date) or ``as_of_ts`` (timestamp), so results are replayable.
Filters are written on the fact's time columns before the join, which lets
Catalyst push them through the projection, the de-duplication window and
the union down to the Parquet scans.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import avg_exact
from ..functions.time import from_year, on_day_before, on_or_after_days_back, within_hours, year_range
from ..operators.buckets import SLICE, is_sliced, join_sliced
from ..operators.joins import join_dimension

F_ = F.col


def _recent(fact: DataFrame, as_of: dt.date | None, days: int) -> DataFrame:
    return fact.filter(on_or_after_days_back("measurement_date", as_of, days))


def _join(fact: DataFrame, dim: DataFrame, dim_cols: Sequence[str]) -> DataFrame:
    kept = ["station_key", *[c for c in dim_cols if c != "station_key"]]
    if is_sliced(fact) and is_sliced(dim):
        return join_sliced(fact, dim.select(*kept, SLICE), "station_key")
    return join_dimension(fact, dim.select(*kept), on="station_key")


def recent_measurements(fact: DataFrame, as_of: dt.date | None, days: int = 7) -> DataFrame:
    """basic fact query over the last ``days`` days."""
    return _recent(fact, as_of, days).select(
        "station_key", "measurement_timestamp", "temperature_2m", "precipitation_total_mm", "wind_speed_mean_ms"
    )


def last_hours(fact: DataFrame, as_of_ts: dt.datetime | None, hours: int = 1) -> DataFrame:
    """rows of the last ``hours`` hours (realtime fact)."""
    return fact.filter(within_hours("measurement_timestamp", as_of_ts, hours)).select(
        "station_key", "measurement_timestamp", "temperature_2m", "precipitation_total_mm", "wind_speed_mean_ms"
    )


def station_series_hours(
    fact: DataFrame, dim: DataFrame, as_of_ts: dt.datetime | None, stations: Sequence[str], hours: int = 24
) -> DataFrame:
    """F4 + F2 + J2: the last ``hours`` hours of the listed stations."""
    f = fact.filter(within_hours("measurement_timestamp", as_of_ts, hours)).filter(F_("station_key").isin(*stations))
    j = _join(f, dim, ["station_name"])
    return j.orderBy("station_key", "measurement_timestamp").select(
        "station_name", "measurement_timestamp", "temperature_2m", "relative_humidity_pct",
        "precipitation_total_mm", "wind_speed_mean_ms",
    )


def canton_series(fact: DataFrame, dim: DataFrame, as_of: dt.date | None, canton: str, days: int = 30) -> DataFrame:
    """F1 + J2 + O2: enriched rows of one canton, newest first."""
    d = dim.filter(F_("station_canton") == canton)
    j = _join(_recent(fact, as_of, days), d, ["station_name", "station_canton", "elevation_meters"])
    return j.select(
        "station_name", "station_canton", "elevation_meters", "measurement_timestamp",
        "temperature_2m", "precipitation_total_mm", "wind_speed_mean_ms",
    ).orderBy(F_("measurement_timestamp").desc(), F_("station_name").asc())


def silver_station_series(
    silver_df: DataFrame, stations: DataFrame, as_of: dt.date | None, canton: str, days: int = 7
) -> DataFrame:
    """J1 + F9 + O2: silver measurements joined with the station view for
    one canton over the last ``days`` days, newest first."""
    since = F.date_sub(F.lit(as_of) if as_of is not None else F.current_date(), days)
    m = silver_df.filter(F_("reference_timestamp") >= since.cast("timestamp_ntz"))
    s = stations.filter(F_("station_canton") == canton).select(
        "station_abbr", "station_name", "station_canton", "station_height_masl"
    )
    return (
        join_dimension(m, s, on="station_abbr")
        .select(
            "station_name", "station_canton", "station_height_masl", "reference_timestamp",
            F_("tre200s0").alias("temperature_2m"),
        )
        .orderBy(F_("reference_timestamp").desc(), F_("station_name").asc())
    )


def daily_station(fact: DataFrame, as_of: dt.date | None, days: int = 30) -> DataFrame:
    """A12."""
    t = F_("temperature_2m")
    return (
        _recent(fact, as_of, days)
        .groupBy("station_key", "measurement_date")
        .agg(
            avg_exact(t).alias("avg_temperature"),
            F.max(t).alias("max_temperature"),
            F.min(t).alias("min_temperature"),
            F.sum("precipitation_total_mm").alias("total_precipitation"),
            avg_exact("wind_speed_mean_ms").alias("avg_wind_speed"),
        )
        .orderBy("station_key", "measurement_date")
    )


def hourly_station(fact: DataFrame, dim: DataFrame, as_of: dt.date | None, days: int = 7, exact_day: bool = False) -> DataFrame:
    """A13 (grouping by name, as the reference does).  ``exact_day`` gives
    the realtime variant ``measurement_date = as_of - 1`` (F5)."""
    f = fact.filter(on_day_before("measurement_date", as_of)) if exact_day else _recent(fact, as_of, days)
    j = _join(f, dim, ["station_name", "station_canton"])
    return (
        j.groupBy("station_name", "station_canton", "measurement_date", "measurement_hour")
        .agg(
            avg_exact("temperature_2m").alias("avg_temp"),
            avg_exact("relative_humidity_pct").alias("avg_humidity"),
            F.sum("precipitation_total_mm").alias("total_precip"),
        )
        .orderBy("station_name", "measurement_date", "measurement_hour")
    )


def canton_daily(fact: DataFrame, dim: DataFrame, as_of: dt.date | None, days: int = 30) -> DataFrame:
    """Stations reporting, mean temperature, rain and peak gust per
    canton and day."""
    j = _join(_recent(fact, as_of, days), dim, ["station_canton"])
    return (
        j.groupBy("station_canton", "measurement_date")
        .agg(
            F.countDistinct("station_key").alias("active_stations"),
            avg_exact("temperature_2m").alias("avg_temperature"),
            F.sum("precipitation_total_mm").alias("total_precipitation"),
            F.max("wind_gust_peak_ms").alias("max_wind_gust"),
        )
        .orderBy("station_canton", "measurement_date")
    )


def series_in_list(
    fact: DataFrame, dim: DataFrame, as_of: dt.date | None, stations: Sequence[str], days: int = 30
) -> DataFrame:
    """F2 + J2: time series of the listed stations (IN list pushed to the scan)."""
    f = _recent(fact, as_of, days).filter(F_("station_key").isin(*stations))
    j = _join(f, dim, ["station_name"])
    return j.orderBy("station_key", "measurement_timestamp").select(
        "station_name", "measurement_timestamp", "temperature_2m", "relative_humidity_pct",
        "precipitation_total_mm", "wind_speed_mean_ms",
    )


def monthly_station(fact: DataFrame, dim: DataFrame, year: int) -> DataFrame:
    """A15 for one year; the year test is a half-open timestamp range."""
    f = fact.filter(year_range("measurement_timestamp", year))
    j = _join(f, dim, ["station_name", "station_canton"])
    t = F_("temperature_2m")
    return (
        j.groupBy("station_name", "station_canton", "measurement_year", "measurement_month")
        .agg(
            F.count(F.lit(1)).alias("measurement_count"),
            avg_exact(t).alias("avg_temperature"),
            F.max(t).alias("max_temperature"),
            F.min(t).alias("min_temperature"),
            F.sum("precipitation_total_mm").alias("total_precipitation"),
            avg_exact("global_radiation_mean_wm2").alias("avg_solar_radiation"),
        )
        .orderBy("station_name", "measurement_month")
    )


def extremes(fact: DataFrame, dim: DataFrame, as_of: dt.date | None, days: int = 30) -> DataFrame:
    """Extremes per station over the last ``days`` days."""
    j = _join(_recent(fact, as_of, days), dim, ["station_name", "station_canton"])
    t = F_("temperature_2m")
    return (
        j.groupBy("station_name", "station_canton")
        .agg(
            F.max(t).alias("max_temperature"),
            F.min(t).alias("min_temperature"),
            F.max("wind_gust_peak_ms").alias("max_wind_gust"),
            F.max("precipitation_total_mm").alias("max_10min_precipitation"),
            F.max("snow_depth_cm").alias("max_snow_depth"),
        )
        .orderBy(F_("max_temperature").desc_nulls_first(), F_("station_name").asc())
    )


def yearly_compare(
    fact: DataFrame, dim: DataFrame, as_of: dt.date, years: int = 5, station: str | None = None
) -> DataFrame:
    """Yearly means and totals for the last ``years`` years, optionally
    for one station (F1)."""
    f = fact.filter(from_year("measurement_timestamp", as_of.year - years))
    if station is not None:
        f = f.filter(F_("station_key") == station)
    j = _join(f, dim, ["station_name"])
    return (
        j.groupBy("station_name", "measurement_year")
        .agg(
            avg_exact("temperature_2m").alias("avg_temperature"),
            F.sum("precipitation_total_mm").alias("total_precipitation"),
            avg_exact("global_radiation_mean_wm2").alias("avg_solar_radiation"),
        )
        .orderBy("measurement_year", "station_name")
    )


# --- dimension-only queries -------------------------------------------------

def station_inventory(dim: DataFrame) -> DataFrame:
    """A10."""
    return (
        dim.groupBy("station_canton")
        .agg(
            F.count(F.lit(1)).alias("station_count"),
            avg_exact("elevation_meters").alias("avg_elevation"),
            F.min("operational_since").alias("oldest_station"),
        )
        .orderBy(F_("station_count").desc(), F_("station_canton").asc())
    )


def high_elevation(dim: DataFrame, threshold: float = 2000) -> DataFrame:
    """F7 + O2."""
    return (
        dim.filter(F_("elevation_meters") > F.lit(threshold))
        .select("station_name", "station_canton", "elevation_meters", "terrain_exposition")
        .orderBy(F_("elevation_meters").desc_nulls_first(), F_("station_name").asc())
    )


def quality_flags(dim: DataFrame) -> DataFrame:
    """A11."""
    return dim.groupBy("data_quality_flag").agg(F.count(F.lit(1)).alias("station_count"))


def missing_coordinates(dim: DataFrame) -> DataFrame:
    """stations flagged Incomplete."""
    return dim.filter(F_("data_quality_flag") == "Incomplete").select(
        "station_key", "station_name", "data_quality_flag"
    )


def newest_stations(dim: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most recently updated stations (key breaks ties)."""
    return (
        dim.select("station_key", "station_name", "station_canton", "last_updated")
        .orderBy(F_("last_updated").desc_nulls_first(), F_("station_key").asc())
        .limit(k)
    )


def station_lookup(dim: DataFrame, station: str) -> DataFrame:
    """F1 on the key."""
    return dim.filter(F_("station_key") == station)
