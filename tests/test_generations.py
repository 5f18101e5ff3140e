"""Partial refreshes that become visible as a whole (K8)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from foehn.operators import generations, tables
from foehn.plans import silver
from foehn.plans import analogue as A

from conftest import SF_SMALL

SCHEMA = "id long, day date"
D = [dt.date(2024, 1, d) for d in range(1, 6)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def days(spark, values):
    return spark.createDataFrame([(v,) for v in values], "day date")


def held(spark, root, **at):
    return sorted(((r["id"], r["day"]) for r in generations.read(spark, root, "day", **at).collect()), key=str)


def test_partitions_are_replaced_removed_and_added(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_version(frame(spark, [(1, D[0]), (2, D[1]), (3, None)]), root, ["day"])
    first = generations.read(spark, root, "day")
    # one day replaced, one removed, the NULL day replaced, one new
    generations.replace_partitions(frame(spark, [(20, D[1]), (30, None), (40, D[3])]), days(spark, [D[0], D[1], D[3], None]), root, "day")
    assert held(spark, root) == sorted([(20, D[1]), (30, None), (40, D[3])], key=str)
    # a second refresh keeps what the first replaced
    generations.replace_partitions(frame(spark, [(21, D[1])]), days(spark, [D[1], D[4]]), root, "day")
    assert held(spark, root) == sorted([(21, D[1]), (30, None), (40, D[3])], key=str)
    # earlier readers go on with their files
    assert sorted(r["id"] for r in first.collect()) == [1, 2, 3]
    assert held(spark, root, pointer=1) == sorted([(20, D[1]), (30, None), (40, D[3])], key=str)
    assert tables.versions(spark, root) == [1] and generations.pointers(spark, root, 1) == [1, 2]
    # a refresh without rows removes its days
    generations.replace_partitions(frame(spark, []), days(spark, [D[1], D[3], None]), root, "day")
    assert held(spark, root) == []


def test_a_refresh_that_dies_before_its_pointer_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    tables.write_version(frame(spark, [(1, D[0]), (2, D[1])]), root, ["day"])
    generations.replace_partitions(frame(spark, [(10, D[0])]), days(spark, [D[0]]), root, "day")
    real = generations.pointer_path
    monkeypatch.setattr(generations, "pointer_path", lambda root, v, n: "/proc/no-such-place" if n == 2 else real(root, v, n))
    with pytest.raises(Exception):  # noqa: B017
        generations.replace_partitions(frame(spark, [(11, D[0]), (21, D[1])]), days(spark, D[:2]), root, "day")
    monkeypatch.undo()
    assert held(spark, root) == [(10, D[0]), (2, D[1])]
    # an unfinished pointer folder (no _SUCCESS) is no pointer
    (tmp_path / "t" / "g000001" / "p000002").mkdir()
    assert held(spark, root) == [(10, D[0]), (2, D[1])]


def test_vacuum_keeps_what_kept_pointers_name(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_version(frame(spark, [(1, D[0]), (2, D[1])]), root, ["day"])
    for n in range(3):
        generations.replace_partitions(frame(spark, [(10 + n, D[0])]), days(spark, [D[0]]), root, "day")
    before = held(spark, root, pointer=2)
    assert len([g for g in generations.vacuum(spark, root, keep=2) if "gen=" in g]) == 1
    assert held(spark, root) == [(12, D[0]), (2, D[1])] and held(spark, root, pointer=2) == before
    for _ in range(2):
        tables.write_version(frame(spark, [(9, D[2])]), root, ["day"])
    generations.vacuum(spark, root, keep=2)
    assert tables.versions(spark, root) == [2, 3] and not (tmp_path / "t" / "g000001").exists()
    assert held(spark, root) == [(9, D[2])]


def test_silver_days_are_read_as_one_state(spark, tmp_path):
    """A reader sees both touched days as they were, or both as they are; the
    day filter still prunes folders of both the version and the generations."""
    out, tiers = str(tmp_path / "silver"), A.bronze_tiers(spark, SF_SMALL)
    silver.refresh_silver(spark, tiers, out)
    before = silver.read_silver(spark, out, with_partition=True)
    touched = [dt.date(2024, 1, 25), dt.date(2024, 1, 26)]
    changed = {**tiers, "recent": tiers["recent"].withColumn("tre200s0", F.lit(-99).cast("decimal(38,10)"))}
    count = lambda df: {r["measurement_date"]: r["n"] for r in df.filter(F.col("tre200s0") == -99).groupBy("measurement_date").agg(F.count("*").alias("n")).collect()}
    silver.refresh_silver(spark, changed, out, touched)
    after = silver.read_silver(spark, out, with_partition=True)
    assert count(before) == {} and set(count(after)) <= set(touched) and count(after)
    assert after.count() == before.count()
    one = after.filter(F.col("measurement_date") == touched[0])
    p = one._jdf.queryExecution().executedPlan().toString()
    assert p.count("PartitionFilters: [isnotnull(measurement_date") == 2
    assert {f.split("measurement_date=")[1][:10] for f in one.inputFiles()} >= {"2024-01-25"}
