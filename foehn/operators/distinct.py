"""Exact distinct counts that roll up.

Keys get dense numbers; a group's keys are a bitmap (one per 32,768 numbers),
and bitmaps of days merge into those of months or regions by OR, where
distinct counts themselves can't be added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rejects import stage

BUCKET, BITS = "key_bucket", "key_bits"


def dense_numbers(df: DataFrame, key: str, name: str = "key_number") -> DataFrame:
    """(key, number): every distinct non-NULL key with its place in key order,
    from 1.  Keys are numbered within range partitions; only the partitions'
    sizes are added up in one place."""
    keys = df.filter(F.col(key).isNotNull()).select(key).distinct()
    part = stage(keys.repartitionByRange(key).withColumn("__part", F.spark_partition_id()), "distinct-keys")
    sizes = part.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row per partition
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("__part", before.alias("__before")))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(key))
    return part.join(offsets, "__part").select(key, (F.col("__before") + place).cast("long").alias(name))


def key_bitmaps(df: DataFrame, by: Sequence[str | Column], number: str = "key_number") -> DataFrame:
    """Bitmaps of the key numbers of each group (rows without a number are in
    none).  Bits are set map-side, so a hot group is a few bitmaps per task."""
    rows = df.filter(F.col(number).isNotNull())
    return rows.groupBy(*by, F.bitmap_bucket_number(number).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS)
    )


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Bitmaps of coarser groups."""
    return bitmaps.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_keys(bitmaps: DataFrame, by: Sequence[str | Column], name: str) -> DataFrame:
    """COUNT(DISTINCT key) of each group of the bitmaps' own groups."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias(name))
