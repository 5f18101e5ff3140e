"""One refresh run over all layers (what the source system's task graph
does): stations and the three measurement tiers are loaded, then silver is
refreshed from the bronze tables.

Layout under ``warehouse``: ``bronze/{historical,recent,now,stations}``,
``silver/measurements`` (partitioned by day) and ``_ledger``.  Landing
folders hold the tiers' files side by side; each load picks its own files by
name pattern.
"""

from __future__ import annotations

from collections.abc import Iterable
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..operators import generations, tables
from ..schema import BRONZE_COLUMNS, FINGERPRINT, bronze_measurement_schema, bronze_station_schema
from . import bronze, gold, silver


def paths(warehouse: str) -> dict[str, str]:
    w = warehouse.rstrip("/")
    return {
        "historical": f"{w}/bronze/historical",
        "recent": f"{w}/bronze/recent",
        "now": f"{w}/bronze/now",
        "stations": f"{w}/bronze/stations",
        "silver": f"{w}/silver/measurements",
        "ledger": f"{w}/_ledger",
    }


def _with_day(df: DataFrame) -> DataFrame:
    """Bronze columns, the stored fingerprint and, where the table has
    partitions, the day they are named for (a table without any has no such
    column)."""
    day = [bronze.PARTITION_COLUMN] if bronze.PARTITION_COLUMN in df.columns else []
    return df.select(*BRONZE_COLUMNS, FINGERPRINT, *day)


def bronze_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    p = paths(warehouse)
    schema = bronze_measurement_schema(fingerprint=True)
    return {
        "historical": _with_day(bronze.read_historical(spark, p["historical"], p["ledger"], fingerprint=True)),
        "recent": _with_day(tables.read_table_partitioned(spark, p["recent"], schema)),
        "now": _with_day(tables.read_table(spark, p["now"], schema)),
    }


def station_table(spark: SparkSession, warehouse: str) -> DataFrame:
    return tables.read_table(spark, paths(warehouse)["stations"], bronze_station_schema())


def refresh_all(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    loaded_at=None,
    silver_days: Iterable[dt.date] | None = None,
    keep_versions: int = 2,
) -> DataFrame:
    """Run every load, then refresh silver (all days, or only
    ``silver_days``) and drop versions older than ``keep_versions``.
    Returns the ledger rows of this run."""
    p = paths(warehouse)
    runs = [
        bronze.load_stations(spark, landing, p["stations"], loaded_at, p["ledger"]),
        bronze.load_historical(spark, landing, p["historical"], loaded_at, p["ledger"]),
        bronze.load_recent(spark, landing, p["recent"], loaded_at, p["ledger"]),
        bronze.load_now(spark, landing, p["now"], loaded_at, p["ledger"]),
    ]
    silver.refresh_silver(spark, bronze_tables(spark, warehouse), p["silver"], silver_days)
    # keep the previous version of each replaced table for readers still on it
    generations.vacuum(spark, p["silver"], keep_versions)
    for name in ("now", "stations"):
        tables.vacuum(spark, p[name], keep=keep_versions)
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out


def gold_views(spark: SparkSession, warehouse: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(standard fact, realtime fact, station dimension) over the refreshed
    silver table, with day filters pruning silver partitions."""
    s = silver.read_silver(spark, paths(warehouse)["silver"], with_partition=True)
    dim = gold.dim_stations(silver.station_view(station_table(spark, warehouse)))
    return gold.fact_standard_from_silver(s), gold.fact_from_silver(s), dim
