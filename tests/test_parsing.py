"""CSV parse rules (S1-S11, X1, X4, K1, K2) on small landed files."""

import datetime as dt
from decimal import Decimal

import pytest

from conftest import write_file
from foehn.operators.rejects import REASON, fail_on_rejects, split_rejects
from foehn.schema import MEASURE_CODES
from foehn.sources import csv as csv_src

HEADER = "station_abbr;reference_timestamp;" + ";".join(MEASURE_CODES) + "\n"
LOADED = "2024-01-30 11:30:00"


def rows_by_ts(df):
    return {(r["station_abbr"], r["reference_timestamp"]): r for r in df.collect()}


@pytest.fixture
def now_files(landing):
    lines = [
        "BAS;01.01.2024 00:00; 1.5 ",
        "BAS;01.01.2024 00:10;-",
        "BAS;01.01.2024 00:20;NULL",
        "BAS;01.01.2024 00:30;abc",
        "BAS;01.01.2024 00:40",
        "BAS;01.01.2024 01:00;" + ";".join(["7"] * 29) + ";x;y",
        "BAS;31.02.2024 x;1",
        "BAS;;1",
        "ABCDEFGHIJK;01.01.2024 00:00;1",
        'BAS;01.01.2024 00:00;"2.5"',
        "BAS;01.01.2024 00:50;1.00000000005",
    ]
    write_file(landing / "bas" / "ogd-smn_bas_t_now.csv", HEADER + "\n".join(lines) + "\n")
    write_file(landing / "bas" / "ogd-smn_bas_t_recent.csv", HEADER + "BAS;01.01.2024 00:00;9\n")
    return landing


def test_tolerant_parse_rules(spark, now_files):
    typed = csv_src.read_measurements(spark, str(now_files), "*_t_now.csv", loaded_at=LOADED)
    good, bad = split_rejects(typed)
    g = good.collect()
    b = bad.collect()
    assert len(g) == 9 and len(b) == 2
    assert sorted(r[REASON] for r in b) == ["bad_reference_timestamp", "station_abbr_too_long"]
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    by = {}
    for r in g:
        by.setdefault(r["reference_timestamp"], []).append(r)
    assert sorted(r["tre200s0"] for r in by[t(0, 0)]) == [Decimal("1.5"), Decimal("2.5")]  # trim, quotes
    assert by[t(0, 10)][0]["tre200s0"] is None  # '-'
    assert by[t(0, 20)][0]["tre200s0"] is None  # 'NULL'
    assert by[t(0, 30)][0]["tre200s0"] is None  # failed cast, row kept
    assert all(by[t(0, 40)][0][c] is None for c in MEASURE_CODES)  # short row
    assert all(by[t(1, 0)][0][c] == Decimal("7") for c in MEASURE_CODES)  # long row, extras ignored
    assert by[t(0, 50)][0]["tre200s0"] == Decimal("1.0000000001")  # 11th digit rounds half-up
    assert by[None][0]["tre200s0"] == Decimal("1")  # NULL timestamp kept
    assert {r["file_name"] for r in g} == {"bas/ogd-smn_bas_t_now.csv"}  # relative path, tier glob
    assert {r["loaded_at"] for r in g} == {dt.datetime(2024, 1, 30, 11, 30)}


def test_strict_parse_fails_whole_batch(spark, now_files, tmp_path):
    typed = csv_src.read_measurements(spark, str(now_files), "*_t_now.csv", loaded_at=LOADED)
    out = str(tmp_path / "out")
    with pytest.raises(Exception):
        fail_on_rejects(typed).write.parquet(out)
    import os

    assert not os.path.exists(os.path.join(out, "_SUCCESS"))


def test_station_file_latin1(spark, landing):
    fields = [
        "ABO", "Adelboden Zürich", "BE", "0-20000-0-06735", "Messstation", "Station", "Stazione", "Station",
        "Owner", "01.01.1990", "1321.50", "1325", "2609372.00", "1148939.00", "46.491700", "7.560800",
        "Hang", "pente", "pendio", "slope", "u_de", "u_fr", "u_it", "u_en",
    ]
    nolat = list(fields)
    nolat[0], nolat[1], nolat[14], nolat[9], nolat[10] = "GVE", "Genève", "", "31.02.1990", "2500"
    text = ";".join(f"c{i}" for i in range(1, 25)) + "\n" + ";".join(fields) + "\n" + ";".join(nolat) + "\n"
    write_file(landing / "ogd-smn_meta_stations.csv", text, encoding="latin-1")
    good, bad = split_rejects(csv_src.read_stations(spark, str(landing), loaded_at=LOADED))
    rows = {r["station_abbr"]: r for r in good.collect()}
    assert bad.count() == 0
    assert rows["ABO"]["station_name"] == "Adelboden Zürich"
    assert rows["GVE"]["station_name"] == "Genève"
    assert rows["GVE"]["station_coordinates_wgs84_lat"] is None
    assert rows["GVE"]["station_data_since"] is None  # bad date -> NULL
    assert rows["ABO"]["station_data_since"] == dt.date(1990, 1, 1)
    assert rows["GVE"]["station_height_masl"] == Decimal("2500.00")

    from foehn.plans import gold, silver

    dim = gold.dim_stations(silver.station_view(good))
    flags = {r["station_key"]: r["data_quality_flag"] for r in dim.collect()}
    assert flags == {"ABO": "Complete", "GVE": "Incomplete"}
    assert len(dim.columns) == 28


def test_crlf_bom_and_quoted_separators(spark, landing):
    lines = [HEADER.strip(), "BAS;01.01.2024 00:00;1.5", 'BAS;01.01.2024 00:10;"2;5";7',
             'BAS;01.01.2024 00:20;"3""x"', "BAS;01.01.2024 00:30;" + ";".join(["4"] * 29)]
    write_file(landing / "bas" / "ogd-smn_bas_t_now.csv", "﻿" + "\r\n".join(lines) + "\r\n")
    raw = {r["c2"]: r for r in csv_src.read_raw_csv(spark, str(landing), "*_t_now.csv", 31).collect()}
    assert raw["01.01.2024 00:10"]["c3"] == "2;5" and raw["01.01.2024 00:10"]["c4"] == "7"
    assert raw["01.01.2024 00:20"]["c3"] == '3"x'
    assert raw["01.01.2024 00:30"]["c31"] == "4"  # no carriage return left on the last field
    typed = csv_src.read_measurements(spark, str(landing), "*_t_now.csv", loaded_at=LOADED)
    assert typed.filter("reject_reason IS NOT NULL").count() == 0
    assert typed.filter("sre000z0 = 4").count() == 1


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_timestamps_and_file_names_need_no_pattern_per_row(spark, tmp_path):
    from pyspark.sql import functions as F

    from foehn.functions.parsing import parse_timestamp
    from foehn.sources.csv import read_raw_csv, relative_path

    texts = ["01.02.2024 00:10", " 1.2.2024 3:05 ", "31.02.2024 00:00", "01.02.2024 00:35\n", "01.02.2024  00:35", "...  ::", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_timestamp("t").alias("ts"))
    assert "split(" not in _plan(rows)
    day = dt.datetime(2024, 2, 1)
    assert {r["t"]: r["ts"] for r in rows.collect() if r["ts"]} == {
        "01.02.2024 00:10": day.replace(minute=10), " 1.2.2024 3:05 ": day.replace(hour=3, minute=5), "01.02.2024 00:35\n": day.replace(minute=35),
    }

    # a path below the root is cut before any pattern is tried
    for n, name in enumerate(["x.csv", "ä b%+.csv", "c+d.csv"]):
        (tmp_path / f"s{n}").mkdir()
        (tmp_path / f"s{n}" / name).write_text("h\nv;w\n")
    raw = read_raw_csv(spark, str(tmp_path), "*.csv", 2).select("file_name")
    plan = _plan(raw)
    assert plan.index("StartsWith(") < plan.index("regexp_replace(") and "Contains(" in plan
    assert {r[0] for r in raw.collect()} == {"s0/x.csv", "s1/ä b%+.csv", "s2/c+d.csv"}

    paths = ["file:/a/b/c.csv", "file:///a/b/c.csv", "hdfs://a/b/c.csv", "file:/a/bc/d.csv", "/a/b/c.csv", None]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select("p", relative_path(F.col("p"), "/a/b").alias("r")).collect()
    assert {r["p"]: r["r"] for r in got} == {
        "file:/a/b/c.csv": "c.csv", "file:///a/b/c.csv": "c.csv", "hdfs://a/b/c.csv": "c.csv", "file:/a/bc/d.csv": "file:/a/bc/d.csv", "/a/b/c.csv": "c.csv", None: None,
    }
