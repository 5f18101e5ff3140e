"""Data-quality and monitoring queries (A1-A9, A18, A19, duplicate and
overlap checks, orphan check)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import fill_pct
from ..functions.time import on_or_after_days_back
from ..operators.joins import orphans
from ..schema import KEY_COLUMNS, MEASURE_CODES

F_ = F.col


def row_count(df: DataFrame) -> DataFrame:
    """A1."""
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def station_coverage(
    df: DataFrame, station: str = "station_abbr", ts: str = "reference_timestamp", by: Sequence[str] = ()
) -> DataFrame:
    """A2: rows, first/last measurement and days covered per station (and per
    ``by``, e.g. the tier)."""
    return (
        df.groupBy(*by, station)
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.min(ts).alias("earliest_measurement"),
            F.max(ts).alias("latest_measurement"),
        )
        .withColumn("days_of_data", F.datediff(F.to_date("latest_measurement"), F.to_date("earliest_measurement")))
        .orderBy(*by, station)
    )


def fill_rates(df: DataFrame, columns: Sequence[str] = MEASURE_CODES, by: Sequence[str] = ()) -> DataFrame:
    """A3 for every measure: total rows, non-NULL count and fill % per column
    (one row, or one per ``by``), all in one pass."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for c in columns:
        aggs += [F.count(c).alias(f"{c}_count"), fill_pct(c).alias(f"{c}_fill_pct")]
    return df.groupBy(*by).agg(*aggs)


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Keys present more than once (expected empty in silver/gold)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter(F_("duplicate_count") > 1)
        .orderBy(F_("duplicate_count").desc(), *keys)
    )


def tier_overlap(tagged_union: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Keys delivered by more than one tier, with the tiers listed
    in name order."""
    # collect_set is merged map-side, and a key holds at most three tier
    # names, so no task ever buffers a whole group.
    tiers = F.array_sort(F.collect_set("data_tier"))
    return (
        tagged_union.select(*keys, "data_tier")
        .groupBy(*keys)
        .agg(tiers.alias("__tiers"))
        .select(
            *keys,
            F.size("__tiers").cast("long").alias("tier_count"),
            F.array_join("__tiers", ", ").alias("tiers_present"),
        )
        .filter(F_("tier_count") > 1)
    )


def station_completeness(silver: DataFrame) -> DataFrame:
    """Coverage and fill % per station.  ``latest_data_tier`` keeps the
    reference's MAX(data_tier) (alphabetical, Q4); ``tier_of_latest`` is the
    tier of the newest measurement."""
    ts = F_("reference_timestamp")
    return (
        silver.groupBy("station_abbr")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.min(ts).alias("earliest_measurement"),
            F.max(ts).alias("latest_measurement"),
            fill_pct("tre200s0").alias("temp_2m_pct"),
            fill_pct("gre000z0").alias("solar_rad_pct"),
            fill_pct("rre150z0").alias("precip_pct"),
            fill_pct("prestas0").alias("pressure_pct"),
            F.max("data_tier").alias("latest_data_tier"),
            F.max_by("data_tier", ts).alias("tier_of_latest"),
        )
        .withColumn("days_covered", F.datediff(F.to_date("latest_measurement"), F.to_date("earliest_measurement")))
        .orderBy("station_abbr")
    )


def tier_counts(df: DataFrame, tier: str = "data_tier", ts: str = "reference_timestamp") -> DataFrame:
    """Rows and time range per tier."""
    return (
        df.groupBy(tier)
        .agg(F.count(F.lit(1)).alias("record_count"), F.min(ts).alias("earliest"), F.max(ts).alias("latest"))
        .orderBy(tier)
    )


def stations_per_canton(stations: DataFrame) -> DataFrame:
    """A8."""
    return (
        stations.groupBy("station_canton")
        .agg(F.count(F.lit(1)).alias("station_count"))
        .orderBy(F_("station_count").desc(), F_("station_canton").asc())
    )


def freshness(stations: DataFrame) -> DataFrame:
    """A9."""
    return stations.agg(F.count(F.lit(1)).alias("station_count"), F.max("loaded_at").alias("last_refresh"))


def measurements_per_day(fact: DataFrame, as_of: dt.date | None, days: int = 7) -> DataFrame:
    """A18."""
    return (
        fact.filter(on_or_after_days_back("measurement_date", as_of, days))
        .groupBy("measurement_date")
        .agg(F.count(F.lit(1)).alias("measurement_count"), F.countDistinct("station_key").alias("station_count"))
        .orderBy(F_("measurement_date").desc())
    )


def completeness_per_day(fact: DataFrame, as_of: dt.date | None, days: int = 7) -> DataFrame:
    """A19."""
    return (
        fact.filter(on_or_after_days_back("measurement_date", as_of, days))
        .groupBy("measurement_date")
        .agg(
            F.count(F.lit(1)).alias("total_measurements"),
            F.count("temperature_2m").alias("temp_measurements"),
            F.count("precipitation_total_mm").alias("precip_measurements"),
            F.count("wind_speed_mean_ms").alias("wind_measurements"),
            F.count("global_radiation_mean_wm2").alias("solar_measurements"),
            fill_pct("temperature_2m").alias("temp_completeness_pct"),
        )
        .orderBy(F_("measurement_date").desc())
    )


def orphan_measurements(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows whose station is missing from the dimension (they vanish
    from every inner-joined report)."""
    return orphans(fact, dim, "station_key", "station_key").select(
        "station_key", "measurement_timestamp", "source_tier"
    )


def sample(df: DataFrame, n: int = 100) -> DataFrame:
    """Any ``n`` rows (LIMIT without order; which rows is undefined)."""
    return df.limit(n)
