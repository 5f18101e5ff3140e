"""Tier de-duplication (W1, FIXTURES §4) and MERGE upsert (K4/K5, §5)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from foehn.operators.upsert import merge_counts, merge_upsert
from foehn.plans import gold, quality, silver
from foehn.schema import bronze_measurement_schema

T0 = dt.datetime(2024, 1, 1, 0, 0)


def bronze(spark, rows):
    """rows: (station, minutes after T0, temperature, file, loaded_at hour)."""
    schema = bronze_measurement_schema()
    data = []
    for st, m, temp, f, h in rows:
        r = {c.name: None for c in schema.fields}
        r.update(station_abbr=st, reference_timestamp=T0 + dt.timedelta(minutes=m),
                 tre200s0=Decimal(str(temp)), file_name=f, loaded_at=dt.datetime(2024, 2, 1, h))
        data.append(r)
    return spark.createDataFrame(data, schema)


def test_tier_priority_cases(spark):
    tiers = {
        "historical": bronze(spark, [("A", 30, 1, "h", 1), ("A", 40, 1, "h", 1)]),
        "recent": bronze(spark, [("A", 10, 2, "r", 1), ("A", 20, 2, "r", 1), ("A", 40, 2, "r", 1),
                                 ("A", 50, 2, "r1", 1), ("A", 50, 3, "r2", 2)]),
        "now": bronze(spark, [("A", 0, 9, "n", 1), ("A", 10, 9, "n", 1), ("A", 40, 9, "n", 1)]),
    }
    out = {r["reference_timestamp"].minute: r for r in silver.silver_measurements(tiers).collect()}
    assert out[0]["data_tier"] == "now"          # now only
    assert out[10]["data_tier"] == "recent"      # recent + now
    assert out[30]["data_tier"] == "historical"  # historical only
    assert out[40]["data_tier"] == "historical"  # all three
    assert out[20]["data_tier"] == "recent"
    assert out[50]["file_name"] == "r2"          # recent twice: newest load wins
    assert len(out) == 6
    # invariants: silver key unique; rows = distinct keys of the union
    assert quality.duplicate_keys(silver.silver_measurements(tiers)).count() == 0
    union = silver.all_measurements(tiers)
    assert union.select("station_abbr", "reference_timestamp").distinct().count() == 6
    # standard fact (E2: live tier dropped before W1) equals filtering after W1
    std = gold.fact_standard(tiers).select("station_key", "measurement_timestamp", "source_tier")
    rt = gold.fact_realtime(tiers).filter(F.col("source_tier").isin("historical", "recent")).select(
        "station_key", "measurement_timestamp", "source_tier")
    assert sorted(std.collect()) == sorted(rt.collect())
    overlap = {r["reference_timestamp"].minute: r["tiers_present"] for r in quality.tier_overlap(union).collect()}
    assert overlap == {10: "now, recent", 40: "historical, now, recent", 50: "recent"} or overlap[40] == "historical, now, recent"


def kv(spark, rows):
    return spark.createDataFrame(rows, "k long, n int, v string")


def test_upsert_cases(spark):
    target = kv(spark, [(1, 1, "t1"), (2, 1, "t2"), (2, 1, "t2b"), (3, 1, "t3")])
    source = kv(spark, [(2, 1, "s2"), (4, 1, "s4"), (4, 1, "s4b"), (None, 1, "snull"), (5, 1, "s5")])
    merged = merge_upsert(target, source, ["k", "n"])
    rows = sorted((r["k"], r["v"], r["_merge_action"]) for r in merged.collect())
    assert rows == [
        (1, "t1", "unchanged"),           # key in target only stays
        (2, "s2", "updated"),             # matched: every target row updated
        (2, "s2", "updated"),
        (3, "t3", "unchanged"),
        (4, "s4", "inserted"),            # duplicate source key: one deterministic survivor
        (5, "s5", "inserted"),            # new key
    ]                                     # NULL key never inserted
    c = merge_counts(merged).collect()[0]
    assert (c["rows_inserted"], c["rows_updated"], c["rows_unchanged"]) == (2, 2, 2)
    # replaying the same batch changes nothing
    again = merge_upsert(merged.drop("_merge_action"), source, ["k", "n"], with_action=False)
    assert sorted(again.collect()) == sorted(merged.drop("_merge_action").collect())


def test_upsert_all_new_and_all_matched(spark):
    t = kv(spark, [(1, 1, "a")])
    assert merge_counts(merge_upsert(t, kv(spark, [(2, 1, "b")]), ["k", "n"])).collect()[0]["rows_inserted"] == 1
    c = merge_counts(merge_upsert(t, kv(spark, [(1, 1, "b")]), ["k", "n"])).collect()[0]
    assert (c["rows_inserted"], c["rows_updated"]) == (0, 1)
