"""A hot key holding a third of all rows: results stay exact and every
shuffle is preceded by map-side reduction (partial top-1 / partial
aggregate), so the hot key never arrives whole at one reducer."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from foehn.operators.upsert import merge_counts, merge_upsert
from foehn.plans import analytics, gold, silver
from foehn.schema import bronze_measurement_schema, bronze_station_schema

T0 = dt.datetime(2024, 1, 1)


def tiers_with_hot_station(spark, n=3000):
    schema = bronze_measurement_schema()
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        st = "HOT" if hot else f"S{i % 50}"
        # the hot station repeats the same ten keys over and over
        ts = T0 + dt.timedelta(minutes=10 * ((i // 3) % 10 if hot else i % 500))
        r = {c.name: None for c in schema.fields}
        r.update(station_abbr=st, reference_timestamp=ts, tre200s0=Decimal(i % 17),
                 file_name=f"f{i % 2}", loaded_at=dt.datetime(2024, 2, 1))
        rows.append(r)
    df = spark.createDataFrame(rows, schema)
    return {"historical": df.filter(F.col("tre200s0") < 9), "recent": df, "now": df.filter(F.col("tre200s0") > 3)}


def stations(spark):
    schema = bronze_station_schema()
    out = []
    for s in ["HOT"] + [f"S{i}" for i in range(50)]:
        r = {c.name: None for c in schema.fields}
        r.update(station_abbr=s, station_name=s, station_canton="C1" if s == "HOT" else "C2")
        out.append(r)
    return spark.createDataFrame(out, schema)


def test_hot_station_dedup_and_report(spark):
    tiers = tiers_with_hot_station(spark)
    s = silver.silver_measurements(tiers)
    hot = s.filter(F.col("station_abbr") == "HOT")
    assert hot.count() == 10  # ten distinct keys survive from 1000 hot rows per tier
    assert s.groupBy("station_abbr", "reference_timestamp").count().filter("count > 1").count() == 0
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan

    dim = gold.dim_stations(silver.station_view(stations(spark)))
    rep = analytics.canton_daily(gold.fact_standard(tiers), dim, dt.date(2024, 1, 5), days=30)
    got = {r["station_canton"]: r["active_stations"] for r in rep.collect()}
    assert got == {"C1": 1, "C2": 50}
    p = rep._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in p or "partial_sum" in p


def test_hot_key_upsert(spark):
    target = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                      F.col("id").alias("v"))
    source = spark.createDataFrame([(0, -1), (1, -2), (5000, -3)], "k long, v long")
    c = merge_counts(merge_upsert(target, source, ["k"])).collect()[0]
    assert (c["rows_updated"], c["rows_inserted"]) == (1000 + 1, 1)  # every hot target row updated
