"""Layer views for SQL users (K10): temp views over the DataFrames of each
layer, with table and column comments carried as column metadata.

Views are lazy: a SQL query over ``gold_fact`` expands into the silver
de-duplication and the bronze scans, and Catalyst pushes its filters down
exactly as for the DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import GOLD_NAMES
from . import gold, silver

TABLE_COMMENTS = {
    "silver_measurements": "Unified measurements, one row per station and 10-minute time; "
    "historical wins over recent, recent over now.",
    "silver_stations": "Station metadata as loaded, one row per station.",
    "gold_fact": "Measurements of the historical and recent tiers with business column names.",
    "gold_fact_realtime": "Measurements of all tiers, including the live tier, with business column names.",
    "gold_dim_stations": "Station dimension with English defaults and a coordinate completeness flag.",
}


def with_comments(df: DataFrame, comments: dict[str, str], table_comment: str | None = None) -> DataFrame:
    """Attach ``comment`` metadata to columns (and the table comment to all
    columns under ``table_comment``)."""
    cols = []
    for c in df.columns:
        meta = {}
        if c in comments:
            meta["comment"] = comments[c]
        if table_comment:
            meta["table_comment"] = table_comment
        cols.append(F.col(c).alias(c, metadata=meta) if meta else F.col(c))
    return df.select(*cols)


def _measure_comments(gold_names: bool) -> dict[str, str]:
    if gold_names:
        return {name: f"source measure {code}" for code, name in GOLD_NAMES.items()}
    return {code: f"gold name {name}" for code, name in GOLD_NAMES.items()}


def register_views(
    spark: SparkSession, tiers: dict[str, DataFrame], stations: DataFrame, prefix: str = ""
) -> dict[str, str]:
    """Create or replace the layer views; returns view name -> comment."""
    frames = {
        "silver_measurements": with_comments(
            silver.silver_measurements(tiers), _measure_comments(False), TABLE_COMMENTS["silver_measurements"]
        ),
        "silver_stations": with_comments(silver.station_view(stations), {}, TABLE_COMMENTS["silver_stations"]),
        "gold_fact": with_comments(gold.fact_standard(tiers), _measure_comments(True), TABLE_COMMENTS["gold_fact"]),
        "gold_fact_realtime": with_comments(
            gold.fact_realtime(tiers), _measure_comments(True), TABLE_COMMENTS["gold_fact_realtime"]
        ),
        "gold_dim_stations": with_comments(
            gold.dim_stations(silver.station_view(stations)),
            {"data_quality_flag": "Incomplete when latitude or longitude is missing"},
            TABLE_COMMENTS["gold_dim_stations"],
        ),
    }
    for t, df in tiers.items():
        frames[f"bronze_measurements_{t}"] = df
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
    return {prefix + k: TABLE_COMMENTS.get(k, "") for k in frames}
