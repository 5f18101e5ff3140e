"""Reports kept up to date (A12, A14-A17): mergeable partials per station and
day, maintained for touched days only.

A partial holds sums, counts, minima and maxima of the measures that the
reports use, so any report over whole days is a merge of partials and reads no
measurement. Partials are stored by month: a touched day rewrites its month's
partials (at most 31 rows a station), recomputing only the touched days, and
all touched months are published at once (``operators.generations``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import on_or_after_days_back
from ..operators import generations, tables
from ..operators.distinct import dense_numbers, distinct_keys, key_bitmaps, merge_bitmaps
from ..operators.joins import join_dimension
from .silver import restrict_to_days

MONTH = "partial_month"

#: Measures with sum and count, with maximum, with minimum.
SUMMED = ["temperature_2m", "precipitation_total_mm", "wind_speed_mean_ms", "global_radiation_mean_wm2"]
LARGEST = ["temperature_2m", "precipitation_total_mm", "wind_gust_peak_ms", "snow_depth_cm"]
LEAST = ["temperature_2m"]


def _month(day: Column | str) -> Column:
    return F.trunc(day, "month").alias(MONTH)


def daily_partials(fact: DataFrame) -> DataFrame:
    """(station_key, measurement_date, n_rows, partials, month) of a fact."""
    return (
        fact.groupBy("station_key", "measurement_date")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.sum(m).alias(f"sum_{m}") for m in SUMMED],
            *[F.count(m).alias(f"n_{m}") for m in SUMMED],
            *[F.max(m).alias(f"max_{m}") for m in LARGEST],
            *[F.min(m).alias(f"min_{m}") for m in LEAST],
        )
        .withColumn(MONTH, _month("measurement_date"))
    )


def _laid_out(partials: DataFrame) -> DataFrame:
    return partials.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "measurement_date", "station_key")


def read_partials(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """Partials as of the newest refresh; ``since`` (a day) prunes months."""
    out = generations.read(spark, path, MONTH)
    return out if since is None else out.filter(F.col(MONTH) >= F.trunc(since, "month"))


def refresh_partials(spark: SparkSession, fact: DataFrame, path: str, touched: DataFrame | None = None) -> None:
    """All partials anew, or those of ``touched`` days (``measurement_date``,
    NULL for rows without a time).  The fact is read for touched days only;
    a touched day without rows loses its partials."""
    if touched is None or not tables.versions(spark, path):
        tables.write_version(_laid_out(daily_partials(fact)), path, [MONTH])
        return
    days = touched.select(F.col("measurement_date").alias("__day")).distinct()
    months = touched.select(_month("measurement_date")).distinct()
    fresh = daily_partials(restrict_to_days({"fact": fact}, touched)["fact"])
    held = read_partials(spark, path)
    # of the touched months the days that stay: partials only, and days by the number in a month
    same_month = held.join(F.broadcast(months.withColumnRenamed(MONTH, "__month")), F.col(MONTH).eqNullSafe(F.col("__month")), "left_semi")
    stay = same_month.join(F.broadcast(days), F.col("measurement_date").eqNullSafe(F.col("__day")), "left_anti")
    generations.replace_partitions(_laid_out(stay.unionByName(fresh)), months, path, MONTH)


def _mean(measure: str, scale: int = 6) -> Column:
    """AVG of a measure from partials, exact, rounded half-up."""
    total = F.sum(f"sum_{measure}").cast("decimal(28,10)")
    n = F.sum(f"n_{measure}").cast("decimal(12,0)")
    return F.round(F.when(n > 0, total / n), scale).cast("double")


def _total(measure: str) -> Column:
    return F.sum(f"sum_{measure}")


def _named(partials: DataFrame, dim: DataFrame, columns: list[str]) -> DataFrame:
    return join_dimension(partials, dim.select("station_key", *columns), on="station_key")


def _recent(partials: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    first = F.lit(as_of - dt.timedelta(days=days))
    return partials.filter(F.col(MONTH) >= F.trunc(first, "month")).filter(on_or_after_days_back("measurement_date", as_of, days))


def daily_station(partials: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """A12."""
    p = _recent(partials, as_of, days)
    return (
        p.groupBy("station_key", "measurement_date")
        .agg(
            _mean("temperature_2m").alias("avg_temperature"),
            F.max("max_temperature_2m").alias("max_temperature"),
            F.min("min_temperature_2m").alias("min_temperature"),
            _total("precipitation_total_mm").alias("total_precipitation"),
            _mean("wind_speed_mean_ms").alias("avg_wind_speed"),
        )
        .orderBy("station_key", "measurement_date")
    )


def canton_daily(partials: DataFrame, dim: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """A partial stands for one station of one day, so counting partials
    counts distinct stations."""
    p = _named(_recent(partials, as_of, days), dim, ["station_canton"])
    return (
        p.groupBy("station_canton", "measurement_date")
        .agg(
            F.count(F.lit(1)).alias("active_stations"),
            _mean("temperature_2m").alias("avg_temperature"),
            _total("precipitation_total_mm").alias("total_precipitation"),
            F.max("max_wind_gust_peak_ms").alias("max_wind_gust"),
        )
        .orderBy("station_canton", "measurement_date")
    )


def monthly_station(partials: DataFrame, dim: DataFrame, year: int) -> DataFrame:
    """A15."""
    p = partials.filter((F.col(MONTH) >= F.lit(dt.date(year, 1, 1))) & (F.col(MONTH) < F.lit(dt.date(year + 1, 1, 1))))
    p = _named(p, dim, ["station_name", "station_canton"])
    day = F.col("measurement_date")
    return (
        p.groupBy("station_name", "station_canton", F.year(day).alias("measurement_year"), F.month(day).alias("measurement_month"))
        .agg(
            F.sum("n_rows").alias("measurement_count"),
            _mean("temperature_2m").alias("avg_temperature"),
            F.max("max_temperature_2m").alias("max_temperature"),
            F.min("min_temperature_2m").alias("min_temperature"),
            _total("precipitation_total_mm").alias("total_precipitation"),
            _mean("global_radiation_mean_wm2").alias("avg_solar_radiation"),
        )
        .orderBy("station_name", "measurement_month")
    )


def extremes(partials: DataFrame, dim: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """A16."""
    p = _named(_recent(partials, as_of, days), dim, ["station_name", "station_canton"])
    return (
        p.groupBy("station_name", "station_canton")
        .agg(
            F.max("max_temperature_2m").alias("max_temperature"),
            F.min("min_temperature_2m").alias("min_temperature"),
            F.max("max_wind_gust_peak_ms").alias("max_wind_gust"),
            F.max("max_precipitation_total_mm").alias("max_10min_precipitation"),
            F.max("max_snow_depth_cm").alias("max_snow_depth"),
        )
        .orderBy(F.col("max_temperature").desc_nulls_first(), F.col("station_name").asc())
    )


def yearly_compare(partials: DataFrame, dim: DataFrame, as_of: dt.date, years: int = 5) -> DataFrame:
    """A17."""
    p = partials.filter(F.col(MONTH) >= F.lit(dt.date(as_of.year - years, 1, 1)))
    p = _named(p, dim, ["station_name"])
    return (
        p.groupBy("station_name", F.year("measurement_date").alias("measurement_year"))
        .agg(
            _mean("temperature_2m").alias("avg_temperature"),
            _total("precipitation_total_mm").alias("total_precipitation"),
            _mean("global_radiation_mean_wm2").alias("avg_solar_radiation"),
        )
        .orderBy("measurement_year", "station_name")
    )


# --- distinct stations that roll up ------------------------------------------------

def station_bitmaps(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """(station_canton, measurement_date, bucket, bits): the stations of the
    dimension that report, as bitmaps over their dense numbers."""
    numbers = dense_numbers(dim, "station_key")
    stations = join_dimension(dim.select("station_key", "station_canton"), numbers, on="station_key")
    pairs = fact.select("station_key", "measurement_date").distinct()
    return key_bitmaps(join_dimension(pairs, stations, on="station_key"), ["station_canton", "measurement_date"])


def active_stations_monthly(bitmaps: DataFrame) -> DataFrame:
    """Distinct stations per canton and month, and of all cantons (canton
    NULL) per month, merged from daily bitmaps."""
    month = F.trunc("measurement_date", "month").alias("month")
    monthly = merge_bitmaps(bitmaps, ["station_canton", month])
    by_canton = distinct_keys(monthly, ["station_canton", "month"], "active_stations")
    overall = distinct_keys(merge_bitmaps(monthly, ["month"]), ["month"], "active_stations")
    return by_canton.unionByName(overall.withColumn("station_canton", F.lit(None).cast("string")))
