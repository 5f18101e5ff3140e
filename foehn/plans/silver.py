"""Silver layer: unified, de-duplicated measurements (U1 + W1, K8, K9) and
the station view (P6)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import ts_date_range
from ..operators import generations
from ..operators.dedup import dedup_tiers, drop_lower_tiers, union_tiers
from ..schema import BRONZE_COLUMNS, FINGERPRINT, STATION_COLUMNS

SILVER_COLUMNS = BRONZE_COLUMNS + ["data_tier"]
PARTITION_COLUMN = "measurement_date"

#: Parquet writes the filter into row groups whose station dictionary outgrew
#: its page; in the others the dictionary itself rules a station out.
STATION_FILTER = {
    "parquet.bloom.filter.enabled#station_abbr": "true",
    "parquet.bloom.filter.expected.ndv#station_abbr": "10000",
}


def all_measurements(tiers: dict[str, DataFrame]) -> DataFrame:
    """The three bronze tiers stacked, tagged with tier and priority."""
    return union_tiers(tiers, BRONZE_COLUMNS)


def silver_measurements(tiers: dict[str, DataFrame], keep: Iterable[str] | None = None) -> DataFrame:
    """W1 over U1: one row per (station, timestamp), most trusted tier wins.

    ``keep`` restricts the tiers; dropping only the lowest-priority tiers
    before the window gives the same rows as filtering after it (E2), so the
    standard fact never scans the live tier.
    """
    if keep is not None:
        tiers = drop_lower_tiers(tiers, list(keep))
    stored = all(FINGERPRINT in df.columns for df in tiers.values())
    rows = union_tiers(tiers, [*BRONZE_COLUMNS, FINGERPRINT] if stored else BRONZE_COLUMNS)
    return dedup_tiers(rows).select(*SILVER_COLUMNS)


def _day(df: DataFrame) -> Column:
    """The row's day: the partition column where the tier has one, so that a
    day filter prunes its folders."""
    return F.col(PARTITION_COLUMN) if PARTITION_COLUMN in df.columns else F.to_date("reference_timestamp")


def restrict_dates(tiers: dict[str, DataFrame], dates: Iterable[dt.date | None]) -> dict[str, DataFrame]:
    """Keep only rows of the given days, None for rows without a time
    (partition filters, or sargable ranges pushed to the scan)."""
    given = set(dates)
    if not given:
        raise ValueError("no dates given")
    days = sorted(d for d in given if d is not None)
    out = {}
    for t, df in tiers.items():
        cond = F.lit(False) if None not in given else _day(df).isNull()
        if PARTITION_COLUMN in df.columns:
            cond = cond | _day(df).isin(days) if days else cond
        else:
            for d in days:
                cond = cond | ts_date_range("reference_timestamp", d, d + dt.timedelta(days=1))
        out[t] = df.filter(cond)
    return out


def restrict_to_days(tiers: dict[str, DataFrame], days: DataFrame, day_col: str = PARTITION_COLUMN) -> dict[str, DataFrame]:
    """Keep only rows whose day is in the ``days`` frame (semi join; the day
    list never passes through the driver).  A NULL day stands for the rows
    without a time.  The days are broadcast: there are at most as many as
    calendar days.  The comparison with the first representable day is true
    of every day; it tells the planner that the list is selective, so it
    prunes the partitions of a tier at run time."""
    d = days.select(F.col(day_col).alias("__day")).distinct()
    known = d.filter(F.col("__day") >= F.expr("DATE'0001-01-01'"))
    with_null = not d.filter(F.col("__day").isNull()).isEmpty()
    out = {}
    for t, df in tiers.items():
        kept = df.join(F.broadcast(known), _day(df) == F.col("__day"), "left_semi")
        out[t] = kept.unionByName(df.filter(_day(df).isNull())) if with_null else kept
    return out


def refresh_silver(
    spark: SparkSession,
    tiers: dict[str, DataFrame],
    out_path: str,
    touched_dates: Iterable[dt.date] | DataFrame | None = None,
    station_slots: int = 1,
) -> str:
    """K8/K9: materialise silver as Parquet partitioned by day; returns the
    path of the version written.

    ``out_path`` holds versions (see ``operators.tables``).  A full refresh
    writes a new version, which readers see only once its job committed, so
    a failed or interrupted refresh leaves the previous silver readable.
    With ``touched_dates`` only those days are recomputed, written beside the
    current version and published together by a pointer (see
    ``operators.generations``): a reader sees all of them as they were or all
    as they are now.  Days of which no tier has a row any more go.
    Files are rebalanced by day (AQE splits a heavy day, merges light ones)
    and sorted by station and time inside each file, which keeps the
    per-file min/max statistics tight for station and time predicates.
    A day beyond one file's size is split by AQE into files that hold all
    stations each; with ``station_slots`` (a day's bytes over a file's) it is
    split by station instead, so that a station's rows of a day lie in one of
    that many files, and a reader of one station skips the others by their
    dictionaries or bloom filters.
    """
    from ..operators import tables

    if isinstance(touched_dates, DataFrame):
        tiers = restrict_to_days(tiers, touched_dates)
    elif touched_dates is not None:
        tiers = restrict_dates(tiers, touched_dates)
    silver = silver_measurements(tiers).withColumn(PARTITION_COLUMN, F.to_date("reference_timestamp"))
    slot = F.pmod(F.xxhash64("station_abbr"), F.lit(station_slots))
    together = [PARTITION_COLUMN, "station_slot"] if station_slots > 1 else [PARTITION_COLUMN]
    out = silver.withColumn("station_slot", slot).hint("rebalance", *together)
    out = out.sortWithinPartitions(PARTITION_COLUMN, "station_abbr", "reference_timestamp").drop("station_slot")
    current = tables.current_path(spark, out_path)
    if touched_dates is None or current is None:
        return tables.write_version(out, out_path, [PARTITION_COLUMN], STATION_FILTER)
    if not isinstance(touched_dates, DataFrame):
        touched_dates = spark.createDataFrame([(d,) for d in set(touched_dates)], f"{PARTITION_COLUMN} date")
    generations.replace_partitions(out, touched_dates, out_path, PARTITION_COLUMN, STATION_FILTER)
    return current


def read_silver(spark: SparkSession, path: str, with_partition: bool = False) -> DataFrame:
    """Materialised silver as of its newest complete refresh.  With
    ``with_partition`` the day column is kept, so day filters on the fact
    become partition filters."""
    from ..operators import tables

    cols = SILVER_COLUMNS + ([PARTITION_COLUMN] if with_partition else [])
    held = tables.versions(spark, path)
    return (generations.read(spark, path, PARTITION_COLUMN) if held else spark.read.parquet(path)).select(*cols)


def station_view(bronze_stations: DataFrame) -> DataFrame:
    """Identity projection of the bronze station table."""
    return bronze_stations.select(*STATION_COLUMNS, "file_name", "loaded_at")
