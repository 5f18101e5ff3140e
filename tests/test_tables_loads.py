"""Versioned replace, partition upsert and the bronze load procedures."""

import datetime as dt

import pytest

from conftest import write_file
from foehn.operators import tables
from foehn.plans import bronze
from foehn.schema import MEASURE_CODES

HEADER = "station_abbr;reference_timestamp;" + ";".join(MEASURE_CODES) + "\n"


def test_replace_refuses_empty(spark, tmp_path):
    root = str(tmp_path / "t")
    assert tables.replace(spark.range(3), root) == 3
    with pytest.raises(ValueError):
        tables.replace(spark.range(0), root)
    assert tables.read_table(spark, root).count() == 3
    assert tables.replace(spark.range(5), root) == 5
    assert tables.versions(spark, root) == [1, 2]
    assert tables.read_table(spark, root).count() == 5
    tables.vacuum(spark, root, keep=1)
    assert tables.versions(spark, root) == [2]


def test_load_procedures(spark, tmp_path):
    land = tmp_path / "land"
    write_file(land / "bas" / "ogd-smn_bas_t_now.csv", HEADER + "BAS;01.01.2024 00:00;1\nBAS;xx;2\n")
    write_file(land / "bas" / "ogd-smn_bas_t_recent.csv",
               HEADER + "BAS;01.01.2024 00:00;1\nBAS;02.01.2024 00:00;2\n")
    write_file(land / "bas" / "ogd-smn_bas_t_historical_2020-2029.csv",
               HEADER + "BAS;31.12.2023 23:50;0\n")
    ledger = str(tmp_path / "ledger")
    now = bronze.load_now(spark, str(land), str(tmp_path / "now"), ledger_root=ledger).collect()[0]
    assert now["status"] == "SUCCESS" and now["rows_loaded"] == 1 and now["rows_rejected"] == 1
    assert (now["files_found"], now["files_loaded"]) == (1, 1)  # the tier's pattern skips the other files
    alt = bronze.load_now(spark, str(land), str(tmp_path / "alt"), glob="*_t_recent.csv").collect()[0]
    assert (alt["files_found"], alt["rows_loaded"]) == (1, 2)

    rec = bronze.load_recent(spark, str(land), str(tmp_path / "recent"), ledger_root=ledger).collect()[0]
    assert rec["status"] == "SUCCESS" and (rec["rows_inserted"], rec["rows_updated"]) == (2, 0)
    rec2 = bronze.load_recent(spark, str(land), str(tmp_path / "recent"), ledger_root=ledger).collect()[0]
    assert (rec2["rows_inserted"], rec2["rows_updated"], rec2["rows_loaded"]) == (0, 2, 2)  # idempotent

    # a corrected recent file touches only its own day
    write_file(land / "bas" / "ogd-smn_bas_t_recent.csv", HEADER + "BAS;02.01.2024 00:00;5\n")
    rec3 = bronze.load_recent(spark, str(land), str(tmp_path / "recent"), ledger_root=ledger).collect()[0]
    assert (rec3["rows_inserted"], rec3["rows_updated"], rec3["rows_loaded"]) == (0, 1, 2)
    vals = {r["reference_timestamp"].day: float(r["tre200s0"])
            for r in spark.read.parquet(str(tmp_path / "recent")).collect()}
    assert vals == {1: 1.0, 2: 5.0}

    h1 = bronze.load_historical(spark, str(land), str(tmp_path / "hist"), ledger_root=ledger).collect()[0]
    assert h1["status"] == "SUCCESS" and h1["rows_loaded"] == 1
    h2 = bronze.load_historical(spark, str(land), str(tmp_path / "hist"), ledger_root=ledger).collect()[0]
    assert h2["rows_loaded"] == 0  # already loaded file skipped (FORCE=FALSE)
    assert spark.read.parquet(str(tmp_path / "hist")).count() == 1

    # strict: a bad historical file fails the batch and adds nothing
    write_file(land / "zrh" / "ogd-smn_zrh_t_historical_2020-2029.csv", HEADER + "ZRH;bad;1\n")
    h3 = bronze.load_historical(spark, str(land), str(tmp_path / "hist"), ledger_root=ledger).collect()[0]
    assert h3["status"] == "FAILED" and h3["errors"]
    assert h3["files_found"] == 2  # both landed historical files are listed; only the new one is read
    assert spark.read.parquet(str(tmp_path / "hist")).count() == 1

    led = bronze.read_ledger(spark, ledger)
    assert led.count() == 7
    recent_runs = bronze.load_history(led, "recent", dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(minutes=1))
    assert recent_runs.count() == 3

    # empty live batch never replaces the table
    for p in (land / "bas").glob("*_t_now.csv"):
        write_file(p, HEADER)
    empty = bronze.load_now(spark, str(land), str(tmp_path / "now"), ledger_root=ledger).collect()[0]
    assert empty["status"] == "FAILED"
    assert tables.read_table(spark, str(tmp_path / "now")).count() == 1


def test_touched_partitions_prune_at_run_time(spark, tmp_path):
    from pyspark.sql import functions as F

    root = str(tmp_path / "p")
    spark.range(100).withColumn("d", (F.col("id") % 10).cast("int")).write.partitionBy("d").parquet(root)
    src = spark.createDataFrame([(1, 3), (2, 4)], "id long, d int")
    t = tables.touched_partitions(spark, root, src, "d")
    assert sorted({r["d"] for r in t.collect()}) == [3, 4]
    p = t._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in p and "dynamicpruning" in p
    spark.createDataFrame([(7, None)], "id long, d int").write.mode("append").partitionBy("d").parquet(root)
    null = spark.createDataFrame([(1, 3), (2, None)], "id long, d int")
    assert {r["d"] for r in tables.touched_partitions(spark, root, null, "d").collect()} == {3, None}


def test_refresh_all_end_to_end(spark, tmp_path):
    from foehn.plans import analytics, refresh

    land, wh = tmp_path / "land", str(tmp_path / "wh")
    write_file(land / "bas" / "ogd-smn_bas_t_historical_2020-2029.csv", HEADER + "BAS;01.01.2024 00:00;1\n")
    write_file(land / "bas" / "ogd-smn_bas_t_recent.csv",
               HEADER + "BAS;01.01.2024 00:00;2\nBAS;01.01.2024 00:10;3\n")
    write_file(land / "bas" / "ogd-smn_bas_t_now.csv", HEADER + "BAS;01.01.2024 00:10;9\nBAS;01.01.2024 00:20;4\n")
    st = ";".join(f"c{i}" for i in range(1, 25)) + "\n" + ";".join(
        ["BAS", "Basel", "BS", "w", "t", "t", "t", "t", "o", "01.01.1900", "316", "316", "1", "2", "47.5", "7.5"]
        + ["e"] * 4 + ["u"] * 4) + "\n"
    write_file(land / "ogd-smn_meta_stations.csv", st, encoding="latin-1")
    runs = refresh.refresh_all(spark, str(land), wh).collect()
    assert [r["status"] for r in runs] == ["SUCCESS"] * 4
    std, rt, dim = refresh.gold_views(spark, wh)
    tiers = {r["measurement_timestamp"].minute: r["source_tier"] for r in rt.collect()}
    assert tiers == {0: "historical", 10: "recent", 20: "now"}
    assert std.count() == 2
    daily = analytics.canton_daily(std, dim, dt.date(2024, 1, 2)).collect()
    assert [(r["station_canton"], r["active_stations"], r["avg_temperature"]) for r in daily] == [("BS", 1, 2.0)]
