"""Partials for touched days, distinct counts by bitmap, page chains and
better tiers that arrive late on streams."""

import datetime as dt
import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from foehn.operators import distinct
from foehn.plans import analytics, gold, rollups, silver
from foehn.schema import BRONZE_COLUMNS, bronze_measurement_schema, bronze_station_schema
from foehn.sources import catalogue
from foehn.streaming import ingest

T0 = dt.datetime(2024, 1, 30)


def tier(spark, rows):
    """rows: (station, hours after T0 or None, temperature, load hour)."""
    schema = bronze_measurement_schema()
    data = []
    for station, hours, value, loaded in rows:
        r = dict.fromkeys(c.name for c in schema.fields)
        time = None if hours is None else T0 + dt.timedelta(hours=hours)
        r.update(station_abbr=station, reference_timestamp=time, tre200s0=Decimal(value), gre000z0=Decimal(value) / 3, file_name="f", loaded_at=dt.datetime(2024, 3, 1, loaded))
        data.append(r)
    return spark.createDataFrame(data, schema)


def stations(spark, names):
    schema = bronze_station_schema()
    rows = [{**dict.fromkeys(c.name for c in schema.fields), "station_abbr": s, "station_name": f"n{s}", "station_canton": f"C{s[-1]}"} for s in names]
    return gold.dim_stations(silver.station_view(spark.createDataFrame(rows, schema)))


def rows(df):
    return sorted(map(str, df.collect()))


def test_partials_of_touched_days_equal_a_recompute(spark, tmp_path):
    r = random.Random(1)
    make = lambda n: [(f"s{r.randrange(4)}", r.choice([None, *range(-80, 80, 7)]), r.randrange(50), r.randrange(9)) for _ in range(n)]
    first, second = make(150), make(60)
    hist = tier(spark, make(80))
    held, path = str(tmp_path / "silver"), str(tmp_path / "partials")
    dim = stations(spark, [f"s{i}" for i in range(3)])  # s3 has no station row
    fact = lambda: gold.fact_standard_from_silver(silver.read_silver(spark, held, with_partition=True))
    silver.refresh_silver(spark, {"historical": hist, "recent": tier(spark, first)}, held)
    rollups.refresh_partials(spark, fact(), path)
    day = lambda h: None if h is None else (T0 + dt.timedelta(hours=h)).date()
    # another recent tier: days change, come and go, in two months and without a time
    touched = spark.createDataFrame([(d,) for d in {day(h) for _, h, _, _ in first + second} | {dt.date(2030, 1, 1)}], "measurement_date date")
    tiers = {"historical": hist, "recent": tier(spark, second)}
    silver.refresh_silver(spark, tiers, held, touched)
    rollups.refresh_partials(spark, fact(), path, touched)
    plain, partials = gold.fact_standard(tiers), rollups.read_partials(spark, path)
    assert rows(partials.drop(rollups.MONTH)) == rows(rollups.daily_partials(plain).drop(rollups.MONTH).select(partials.drop(rollups.MONTH).columns))
    as_of = dt.date(2024, 2, 2)
    for mine, its in [
        (rollups.daily_station(partials, as_of), analytics.daily_station(plain, as_of)),
        (rollups.canton_daily(partials, dim, as_of, 3), analytics.canton_daily(plain, dim, as_of, 3)),
        (rollups.monthly_station(partials, dim, 2024), analytics.monthly_station(plain, dim, 2024)),
        (rollups.extremes(partials, dim, as_of, 3), analytics.extremes(plain, dim, as_of, 3)),
        (rollups.yearly_compare(partials, dim, as_of), analytics.yearly_compare(plain, dim, as_of)),
    ]:
        assert mine.columns == its.columns and rows(mine) == rows(its)
    # a report reads partials only, and only the months it needs
    report = rollups.daily_station(partials, dt.date(2024, 2, 29), 20)
    files = report.inputFiles()
    assert files and all("/partials/" in f for f in files)
    assert "PartitionFilters: [isnotnull(partial_month" in report._jdf.queryExecution().executedPlan().toString()


def test_untouched_partials_are_not_recomputed(spark, tmp_path):
    path = str(tmp_path / "partials")
    make = lambda v: gold.fact_standard({"historical": tier(spark, [("a", 0, v, 1), ("a", -24, v, 1), ("a", 72, v, 1)])})
    rollups.refresh_partials(spark, make(1), path)
    rollups.refresh_partials(spark, make(2), path, spark.createDataFrame([(T0.date(),)], "measurement_date date"))
    held = {r["measurement_date"]: int(r["max_temperature_2m"]) for r in rollups.read_partials(spark, path).collect()}
    assert held == {T0.date(): 2, T0.date() - dt.timedelta(days=1): 1, T0.date() + dt.timedelta(days=3): 1}


def test_dense_numbers_and_bitmaps(spark):
    r = random.Random(2)
    pairs = [(r.choice(["x", "y", None]), f"k{r.randrange(200)}" if r.random() < 0.95 else None) for _ in range(2000)]
    pairs += [("hot", "k1")] * 1500
    df = spark.createDataFrame(pairs, "g string, k string").repartition(5)
    numbers = {x["k"]: x["key_number"] for x in distinct.dense_numbers(df, "k").collect()}
    names = sorted({k for _, k in pairs if k})
    assert numbers == {k: i for i, k in enumerate(names, 1)}
    bits = distinct.key_bitmaps(df.join(distinct.dense_numbers(df, "k"), "k", "left"), ["g"])
    found = {x["g"]: x["n"] for x in distinct.distinct_keys(bits, ["g"], "n").collect()}
    assert found == {g: len({k for h, k in pairs if h == g and k}) for g in ("x", "y", None, "hot")}
    whole = distinct.distinct_keys(distinct.merge_bitmaps(bits, [F.lit(1).alias("one")]), ["one"], "n").first()["n"]
    assert whole == len(names)
    assert distinct.dense_numbers(df.limit(0), "k").count() == 0


def test_bitmaps_beyond_one_bucket(spark):
    df = spark.range(1, 70_001).select(F.col("id").alias("key_number"), (F.col("id") % 2).alias("g"))
    bits = distinct.key_bitmaps(df.unionByName(df), ["g"])
    assert bits.count() == 6
    assert {x["g"]: x["n"] for x in distinct.distinct_keys(bits, ["g"], "n").collect()} == {0: 35_000, 1: 35_000}


def chain(spark, pages):
    """pages: (catalogue, cursor, next)."""
    text = lambda n: json.dumps({"features": [], "links": [{"rel": "self"}] + ([{"rel": "next", "body": {"cursor": n}}] if n is not None else [])})
    df = spark.createDataFrame([(c, x, text(n)) for c, x, n in pages], "catalogue string, cursor string, json string")
    return {(r["catalogue"], r["cursor"]): (r["position"], r["status"]) for r in catalogue.page_chain(df, ["catalogue"]).collect()}


def test_page_chains(spark):
    assert chain(spark, [("a", None, "1"), ("a", "1", "2"), ("a", "2", None)]) == {("a", None): (0, "ok"), ("a", "1"): (1, "ok"), ("a", "2"): (2, "ok")}
    long = [("a", None if i == 0 else str(i), str(i + 1) if i < 40 else None) for i in range(41)]
    assert chain(spark, long) == {("a", x): (i, "ok") for i, (_, x, _) in enumerate(long)}
    faults = chain(
        spark,
        [("gap", None, "1"), ("gap", "2", "3"), ("gap", "3", None), ("loop", None, "1"), ("loop", "1", "2"), ("loop", "2", "1"), ("self", None, "s"), ("self", "s", "s"),
         ("twice", None, "1"), ("twice", "1", "2"), ("twice", "1", "2"), ("twice", "2", None), ("headless", "5", "6"), ("empty", None, None)],
    )
    assert faults == {
        ("gap", None): (0, "ok"), ("gap", "1"): (1, "missing"), ("gap", "2"): (None, "unreachable"), ("gap", "3"): (None, "unreachable"),
        ("loop", None): (0, "ok"), ("loop", "1"): (1, "ok"), ("loop", "2"): (2, "cyclic"), ("self", None): (0, "ok"), ("self", "s"): (1, "cyclic"),
        ("twice", None): (0, "ok"), ("twice", "1"): (1, "repeated"), ("twice", "2"): (2, "ok"),
        ("headless", None): (0, "missing"), ("headless", "5"): (None, "unreachable"), ("headless", "6"): (None, "missing"), ("empty", None): (0, "ok"),
    }
    assert chain(spark, []) == {}


def test_better_tiers_win_when_they_arrive_late(spark, tmp_path):
    names = ("historical", "recent", "now")
    land, table, ck = tmp_path / "land", str(tmp_path / "best"), str(tmp_path / "ck")
    arrivals = [
        {"now": [("a", 0, 1, 5), ("a", 1, 2, 5), ("b", 30, 3, 5)]},
        {"recent": [("a", 0, 10, 4), ("c", 0, 11, 4)], "now": [("a", 1, 4, 6), ("a", 0, 5, 6)]},
        {"historical": [("a", 0, 20, 1), ("c", 0, 21, 1)], "recent": [("a", 0, 12, 9), ("b", 30, 13, 2), ("b", None, 1, 1)]},
    ]
    seen = {t: [] for t in names}
    schema = bronze_measurement_schema()
    for arrived in arrivals:
        for t in names:
            seen[t] += arrived.get(t, [])
            tier(spark, arrived.get(t, [])).write.mode("append").parquet(str(land / t))
        streams = {t: spark.readStream.schema(schema).parquet(str(land / t)) for t in names}
        ingest.start_best_rows(streams, table, ck, "40 days").awaitTermination()
        want = silver.silver_measurements({t: tier(spark, seen[t]) for t in names}).filter("reference_timestamp is not null")
        assert rows(spark.read.parquet(table).select(*BRONZE_COLUMNS, "data_tier")) == rows(want.select(*BRONZE_COLUMNS, "data_tier"))
