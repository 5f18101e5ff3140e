"""Loads and refreshes that must leave what a full recompute would."""

import datetime as dt
import re

import pytest
from conftest import write_file
from pyspark.sql import functions as F

from foehn.operators import tables
from foehn.operators.rejects import staged
from foehn.plans import bronze, refresh, silver
from foehn.schema import MEASURE_CODES
from foehn.streaming import ingest

HEADER = "station_abbr;reference_timestamp;" + ";".join(MEASURE_CODES) + "\n"


def rows(df):
    return sorted((r["station_abbr"], r["reference_timestamp"], r["data_tier"]) for r in df.collect())


def test_historical_files_load_once(spark, tmp_path):
    land, root, ledger = tmp_path / "land", str(tmp_path / "hist"), str(tmp_path / "ledger")
    names = ["x_t_historical_2020 (1).csv", "zür+ich_t_historical_2020.csv"]
    for name in names:
        write_file(land / "a b" / name, HEADER + "BAS;31.12.2023 23:50;0\n")
    assert bronze.pending_files(spark, str(land), ledger).count() == 2
    assert [bronze.load_historical(spark, str(land), root, ledger_root=ledger).first()["rows_loaded"] for _ in range(2)] == [2, 0]
    assert {r[0] for r in spark.read.parquet(root).select("file_name").collect()} == {f"a b/{n}" for n in names}
    # published again under its name with other content
    write_file(land / "a b" / names[0], HEADER + "BAS;31.12.2023 23:50;1\nBAS;31.12.2023 23:40;1\n")
    again = bronze.load_historical(spark, str(land), root, ledger_root=ledger).first()
    assert (again["files_loaded"], again["rows_loaded"]) == (1, 2)


def test_failed_load_leaves_its_files_pending(spark, tmp_path):
    land, root, ledger = tmp_path / "land", str(tmp_path / "hist"), str(tmp_path / "ledger")
    write_file(land / "x_t_historical_2020.csv", HEADER + "BAS;bad;0\n")
    failed = bronze.load_historical(spark, str(land), root, ledger_root=ledger).first()
    assert failed["status"] == "FAILED" and bronze.pending_files(spark, str(land), ledger).count() == 1


def test_refresh_after_a_failed_backfill(spark, tmp_path):
    land, wh = tmp_path / "land", str(tmp_path / "wh")
    write_file(land / "x_t_historical_2020.csv", HEADER + "BAS;bad;0\n")
    write_file(land / "x_t_recent.csv", HEADER + "BAS;01.01.2024 00:00;2\n")
    status = {r["data_tier"]: r["status"] for r in refresh.refresh_all(spark, str(land), wh).collect()}
    assert status["historical"] == "FAILED" and status["recent"] == "SUCCESS"
    assert len(rows(silver.read_silver(spark, refresh.paths(wh)["silver"]))) == 1


def test_every_parsed_row_is_accounted_for(spark, tmp_path):
    land, root, ledger = tmp_path / "land", str(tmp_path / "recent"), str(tmp_path / "ledger")
    write_file(land / "x_t_recent.csv", HEADER + "BAS;01.01.2024 00:00;1\nBAS;01.01.2024 00:00;2\n;01.01.2024 00:00;3\nBAS;;4\nBAS;xx;5\nGEN;01.01.2024 00:00;6\n")
    r = bronze.load_recent(spark, str(land), root, ledger_root=ledger).first()
    assert (r["rows_rejected"], r["rows_null_key"], r["rows_duplicate_key"], r["rows_inserted"], r["rows_updated"]) == (1, 2, 1, 2, 0)
    assert r["rows_parsed"] == r["rows_rejected"] + r["rows_null_key"] + r["rows_duplicate_key"] + r["rows_inserted"] + r["rows_updated"]
    reasons = spark.read.parquet(bronze.rejects_root(ledger)).groupBy("reason").count().collect()
    assert {x["reason"]: x["count"] for x in reasons} == {"bad_reference_timestamp": 1, "null_key": 2, "duplicate_key": 1}


@pytest.mark.parametrize("as_frame", [True, False])
def test_touched_days_equal_a_full_recompute(spark, tmp_path, as_frame):
    land, wh = tmp_path / "land", str(tmp_path / "wh")
    write_file(land / "x_t_historical_2020.csv", HEADER + "BAS;01.01.2024 00:00;1\nBAS;05.01.2024 00:00;1\n")
    write_file(land / "x_t_now.csv", HEADER + "BAS;02.01.2024 00:00;9\nBAS;03.01.2024 00:00;9\nBAS;;7\n")
    refresh.refresh_all(spark, str(land), wh)
    path = refresh.paths(wh)["silver"]
    assert len(rows(silver.read_silver(spark, path).filter("reference_timestamp is not null"))) == 4
    write_file(land / "x_t_now.csv", HEADER + "BAS;02.01.2024 00:10;9\n")
    bronze.load_now(spark, str(land), refresh.paths(wh)["now"])
    tiers = refresh.bronze_tables(spark, wh)
    days = [dt.date(2024, 1, 2), dt.date(2024, 1, 3), None]
    touched = spark.createDataFrame([(d,) for d in days], "measurement_date date") if as_frame else days
    silver.refresh_silver(spark, tiers, path, touched)
    assert rows(silver.read_silver(spark, path)) == rows(silver.silver_measurements({t: df.drop("measurement_date") for t, df in tiers.items()}))
    assert len(rows(silver.read_silver(spark, path))) == 3


def test_touched_days_prune_historical(spark, tmp_path):
    land, wh = tmp_path / "land", str(tmp_path / "wh")
    write_file(land / "x_t_historical_2020.csv", HEADER + "".join(f"BAS;{d:02}.01.2024 00:00;1\n" for d in range(1, 29)))
    bronze.load_historical(spark, str(land), refresh.paths(wh)["historical"])
    tiers = {"historical": refresh.bronze_tables(spark, wh)["historical"]}
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    listed = silver.restrict_dates(tiers, [dt.date(2024, 1, 5)])["historical"]
    assert re.search(r"PartitionFilters: \[[^\]]*measurement_date", plan(listed)) and listed.count() == 1
    days = str(tmp_path / "days")
    spark.createDataFrame([(dt.date(2024, 1, 5),)], "measurement_date date").write.parquet(days)
    joined = silver.restrict_to_days(tiers, spark.read.parquet(days))["historical"]
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan(joined)) and joined.count() == 1


def test_live_table_holds_all_stations_of_the_newest_run(spark, tmp_path):
    land, table, ck = tmp_path / "land", str(tmp_path / "now"), str(tmp_path / "ck")
    line = lambda s, minute: HEADER + f"{s};01.01.2024 00:{minute};1\n"
    write_file(land / "run=9" / "bas" / "bas_t_now.csv", line("BAS", "00"))
    write_file(land / "run=9" / "old" / "old_t_now.csv", line("OLD", "00"))
    ingest.start_now_ingest(spark, str(land), table, ck).awaitTermination()
    for station in ("BAS", "GEN"):  # two micro-batches of one run
        write_file(land / "run=10" / station / f"{station}_t_now.csv", line(station, "10"))
        ingest.start_now_ingest(spark, str(land), table, ck).awaitTermination()
    assert {r["station_abbr"] for r in tables.read_table(spark, table).collect()} == {"BAS", "GEN"}
    again = str(tmp_path / "again")
    assert bronze.load_now(spark, str(land), again).first()["rows_loaded"] == 2


def test_versions_of_any_length(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.range(1).write.parquet(tables.version_path(root, 999_999))
    assert tables.replace(spark.range(2), root) == 2
    assert tables.versions(spark, root) == [999_999, 1_000_000] and tables.read_table(spark, root).count() == 2


def test_staged_copy_survives_a_failure(spark):
    with pytest.raises(RuntimeError), staged(spark.range(3), "kept") as copy:
        raise RuntimeError
    assert copy.count() == 3


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from foehn import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    monkeypatch.setattr(session, "_context", lambda _: Context())
    monkeypatch.setattr(session, "checkpoint_root", lambda _: None)
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(None)


def test_years_have_no_upper_bound(spark):
    from foehn.functions.time import from_year

    times = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS t UNION ALL SELECT timestamp_ntz'9000-01-01 00:00:00' UNION ALL SELECT timestamp_ntz'2019-12-31 23:50:00'")
    assert times.filter(from_year("t", 2020)).agg(F.count("*")).first()[0] == 2
