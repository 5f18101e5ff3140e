"""One station's rows are found in materialised silver without reading it all (K9, F1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from foehn.plans import silver
from foehn.schema import BRONZE_COLUMNS, bronze_measurement_schema

DAYS, STATIONS = 2, 400


def rows_read(df):
    """Rows of df, and rows its scans put out."""
    n = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan()
    return n, sum(int(x) for x in scans(plan))


def scans(plan):
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        plan = plan.executedPlan()
    if plan.nodeName().startswith("Scan parquet"):
        yield plan.metrics().apply("numOutputRows").value()
    children = plan.children()
    for i in range(children.size()):
        yield from scans(children.apply(i))


@pytest.fixture
def tiers(spark):
    types = {f.name: f.dataType for f in bronze_measurement_schema().fields}
    at = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.col("id") % DAYS, F.lit(0), (F.floor(F.col("id") / DAYS) % 144) * 10)
    own = {"station_abbr": F.concat(F.lit("s"), F.floor(F.col("id") / (DAYS * 144))), "reference_timestamp": at, "tre200s0": F.col("id") % 30}
    df = spark.range(DAYS * 144 * STATIONS).select(*(own.get(c, F.lit(None)).cast(types[c]).alias(c) for c in BRONZE_COLUMNS))
    return {t: df.where(cond) for t, cond in (("historical", "tre200s0 >= 0"), ("recent", "false"), ("now", "false"))}


@pytest.mark.parametrize("touched", [False, True])
def test_lookup_reads_one_slot_of_stations(spark, tmp_path, tiers, touched):
    total, out = DAYS * 144 * STATIONS, str(tmp_path / "silver")
    held = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        silver.refresh_silver(spark, tiers, out, station_slots=16)
        if touched:
            days = [dt.date(2024, 1, 1 + d) for d in range(DAYS)]
            silver.refresh_silver(spark, tiers, out, touched_dates=days, station_slots=16)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", held)
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    table = silver.read_silver(spark, out)
    assert table.count() == total
    n, read = rows_read(table.where("station_abbr = 's7'"))
    assert n == DAYS * 144 and n <= read < total / 6, (n, read, total)
    # a station that no file holds, though it lies between the smallest and the largest
    assert rows_read(table.where("station_abbr = 's7x'")) == (0, 0)


def test_slots_change_no_row(spark, tmp_path, tiers):
    silver.refresh_silver(spark, tiers, str(tmp_path / "a"))
    silver.refresh_silver(spark, tiers, str(tmp_path / "b"), station_slots=5)
    a, b = (silver.read_silver(spark, str(tmp_path / x), with_partition=True) for x in "ab")
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_bloom_filters_are_written_where_dictionaries_end(spark, tmp_path):
    """With dictionaries off, absent values are ruled out by the filter."""
    path = str(tmp_path / "t")
    df = spark.range(20_000).selectExpr("concat('s', id * 2) as station_abbr", "id").coalesce(1)
    df.write.options(**silver.STATION_FILTER).option("parquet.enable.dictionary", "false").parquet(path)
    assert rows_read(spark.read.parquet(path).where("station_abbr = 's11111'")) == (0, 0)
    assert rows_read(spark.read.parquet(path).where("station_abbr = 's11112'"))[0] == 1
