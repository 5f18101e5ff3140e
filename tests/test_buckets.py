"""Joins of bucketed tables: no exchange, the rows of a plain join, hot keys
in several buckets."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from foehn.operators import buckets
from foehn.plans import analogue as A
from foehn.plans import analytics, gold, silver


def tables(spark, tmp_path, fact, dim, n=4, **options):
    name = re.sub(r"\W", "_", tmp_path.name)
    f = buckets.write_fact(fact, f"fact_{name}", str(tmp_path / "fact"), "station_key", "t", n, **options)
    return f, buckets.write_dimension(dim, f"dim_{name}", str(tmp_path / "dim"), "station_key", n)


@pytest.fixture
def hot(spark):
    """A third of the rows have one key; null and unknown keys occur."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("s"), F.col("id") % 40))
    fact = spark.range(6000).select(key.alias("station_key"), F.col("id").alias("t"), (F.col("id") % 5).alias("day"))
    return fact, spark.createDataFrame([("hot", "x"), (None, "n"), *((f"s{i}", f"c{i}") for i in range(30))], "station_key string, station_canton string")


def test_join_equals_the_plain_join_without_an_exchange(spark, tmp_path, hot):
    fact, dim = hot
    f, d = tables(spark, tmp_path, fact, dim, partition_by=["day"], sort_by=["t"])
    assert f.count() == 6000 and d.count() == 32 * buckets.SLICES
    for how in ("inner", "left", "left_semi", "left_anti"):
        joined = buckets.join_sliced(f, d, "station_key", how)
        p = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p and "Exchange" not in p, p
        plain = fact.join(dim, "station_key", how).select(*joined.columns)
        assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect())), how
    with pytest.raises(ValueError, match="per slice"):
        buckets.join_sliced(f, d, "station_key", "right")


def test_hot_key_lies_in_several_buckets(spark, tmp_path, hot):
    f, _ = tables(spark, tmp_path, *hot, n=8)
    file = F.regexp_extract(F.input_file_name(), r"_([0-9]{5})\.", 1)
    sizes = [r["count"] for r in f.where("station_key = 'hot'").groupBy(file.alias("bucket")).count().collect()]
    assert sum(sizes) == 2000 and len(sizes) >= 3 and max(sizes) < 1200


def test_empty_tables(spark, tmp_path, hot):
    fact, dim = hot
    f, d = tables(spark, tmp_path, fact.limit(0), dim.limit(0))
    assert buckets.join_sliced(f, d, "station_key", "left").count() == 0


def test_reports_take_bucketed_tables(spark, tmp_path):
    fact = gold.fact_standard(A.bronze_tiers(spark, SF_SMALL))
    dim = gold.dim_stations(silver.station_view(A.bronze_stations(spark, SF_SMALL)))
    name = re.sub(r"\W", "_", tmp_path.name)
    f = buckets.write_fact(fact, f"rf_{name}", str(tmp_path / "f"), "station_key", "measurement_timestamp", 4, partition_by=["measurement_date"])
    d = buckets.write_dimension(dim, f"rd_{name}", str(tmp_path / "d"), "station_key", 4)
    got = analytics.canton_daily(f, d, A.AS_OF)
    p = got._jdf.queryExecution().executedPlan().toString()
    # what is exchanged is aggregated already
    assert "SortMergeJoin" in p and "Exchange" not in p[p.index("SortMergeJoin") :], p
    assert got.collect() == analytics.canton_daily(fact, dim, A.AS_OF).collect()


def test_bucket_count_follows_the_bytes():
    assert [buckets.bucket_count(n) for n in (0, 1, 128 << 20, (128 << 20) + 1, 27 << 30)] == [1, 1, 1, 2, 216]
