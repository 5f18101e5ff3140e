"""A load's data, files, rejects and ledger row count together or not at all
(K1, K7, S16), and a replayed micro-batch counts once (T2)."""

import os

import pytest
from conftest import write_file

from foehn.plans import bronze, refresh
from foehn.schema import MEASURE_CODES
from foehn.streaming import ingest

HEADER = "station_abbr;reference_timestamp;" + ";".join(MEASURE_CODES) + "\n"


def test_a_load_killed_before_its_ledger_row_counts_nothing(spark, tmp_path, monkeypatch):
    land, wh = tmp_path / "land", str(tmp_path / "wh")
    p = refresh.paths(wh)
    load = lambda: bronze.load_historical(spark, str(land), p["historical"], ledger_root=p["ledger"])
    held = lambda: bronze.read_historical(spark, p["historical"], p["ledger"]).count()
    write_file(land / "a_t_historical_2020.csv", HEADER + "A;01.01.2024 00:00;1\n")
    assert load().first()["rows_loaded"] == 1 and held() == 1
    write_file(land / "b_t_historical_2020.csv", HEADER + "B;01.01.2024 00:00;1\nB;02.01.2024 00:00;1\n")

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(bronze, "_ledger_row", killed)
    with pytest.raises(KeyboardInterrupt):
        load()
    monkeypatch.undo()
    assert spark.read.parquet(p["historical"]).count() == 3  # the rows are there
    assert held() == 1 and refresh.bronze_tables(spark, wh)["historical"].count() == 1  # and don't count
    assert bronze.pending_files(spark, str(land), p["ledger"]).count() == 1
    again = load().first()
    assert (again["files_loaded"], again["rows_loaded"], held()) == (1, 2, 3)  # once, without any de-duplication
    assert load().first()["files_loaded"] == 0 and held() == 3


def test_rows_loaded_without_a_ledger_stay_visible(spark, tmp_path):
    land, root, ledger = tmp_path / "land", str(tmp_path / "hist"), str(tmp_path / "ledger")
    write_file(land / "a_t_historical_2020.csv", HEADER + "A;01.01.2024 00:00;1\n")
    bronze.load_historical(spark, str(land), root)
    write_file(land / "b_t_historical_2020.csv", HEADER + "B;01.01.2024 00:00;1\n")
    assert bronze.load_historical(spark, str(land), root, ledger_root=ledger).first()["rows_loaded"] == 2
    assert bronze.read_historical(spark, root, ledger).count() == 3
    assert bronze.read_historical(spark, str(tmp_path / "none"), ledger).count() == 0


def test_a_replayed_micro_batch_writes_nothing_twice(spark, tmp_path):
    land, table, ck, ledger = tmp_path / "land", str(tmp_path / "recent"), tmp_path / "ck", str(tmp_path / "ledger")
    write_file(land / "run=1" / "a_t_recent.csv", HEADER + "A;01.01.2024 00:00;1\nA;xx;2\nA;;3\nA;01.01.2024 00:00;4\n")
    run = lambda: ingest.start_recent_ingest(spark, str(land), table, str(ck), ledger_root=ledger).awaitTermination()
    run()
    state = lambda: (bronze.read_ledger(spark, ledger).count(), bronze.read_rejects(spark, ledger).count(), spark.read.parquet(table).count())
    assert state() == (1, 3, 1)
    # as if the driver had died after the batch and before the stream's commit
    for name in ("0", ".0.crc"):
        if os.path.exists(ck / "commits" / name):
            os.remove(ck / "commits" / name)
    run()
    assert state() == (1, 3, 1)


def test_rejects_of_a_failed_attempt_do_not_count(spark, tmp_path, monkeypatch):
    land, table, ledger = tmp_path / "land", str(tmp_path / "recent"), str(tmp_path / "ledger")
    write_file(land / "a_t_recent.csv", HEADER + "A;01.01.2024 00:00;1\nA;xx;2\n")

    def broken(*_, **__):
        raise RuntimeError("no space")

    monkeypatch.setattr(bronze.tables, "upsert_partitions", broken)
    assert bronze.load_recent(spark, str(land), table, ledger_root=ledger).first()["status"] == "FAILED"
    monkeypatch.undo()
    assert spark.read.parquet(bronze.rejects_root(ledger)).count() == 1 and bronze.read_rejects(spark, ledger).count() == 0
    assert bronze.load_recent(spark, str(land), table, ledger_root=ledger).first()["status"] == "SUCCESS"
    assert bronze.read_rejects(spark, ledger).count() == 1
