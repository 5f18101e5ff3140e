"""A landing with a folder per station: the files Spark's writer makes, and a
listing of many folders."""

import os

from pyspark.sql import functions as F

from foehn.plans import landed
from foehn.sources import inventory


def _texts(root):
    """Folder -> lines of its files in some order, files, and all file names."""
    found, names = {}, []
    for at, _, files in os.walk(root):
        names += files
        for f in files:
            if f.endswith(".csv"):
                with open(os.path.join(at, f), encoding="utf-8") as lines:
                    header, *rest = lines.read().splitlines()
                found.setdefault(os.path.relpath(at, root), []).append((header, sorted(rest)))
    return found, names


def test_a_folder_per_station_holds_what_the_writer_makes(spark, tmp_path):
    stations = [None, "", "7", "a b", "x/y=%z", "Kündin", *(f"s{i}" for i in range(40))]
    rows = [(s, f"{s or ''};{i};\"q\" ü ") for s in stations for i in range(3)]
    lines = spark.createDataFrame(rows, "file_name string, line string").repartition(5)
    landed.land(lines, str(tmp_path / "writer"), F.col("file_name"))
    landed.land_folders(lines, str(tmp_path / "folders"), F.col("file_name"))
    want, _ = _texts(tmp_path / "writer")
    got, names = _texts(tmp_path / "folders")
    merged = {f: ("line", sorted(line for _, part in parts for line in part)) for f, parts in want.items()}
    assert {f: parts[0] for f, parts in got.items()} == merged
    assert len(names) == len(got) == 45, names  # one file each, and nothing beside them


def test_a_listing_of_many_folders_runs_few_tasks(spark, tmp_path, monkeypatch):
    for i in range(60):  # Spark lists 32 folders and fewer without a job
        (tmp_path / f"run={i}").mkdir()
        (tmp_path / f"run={i}" / "a.csv").write_text("line\n")
    monkeypatch.setattr(inventory, "LISTING_TASKS_PER_CORE", 2)
    before = spark.conf.get(inventory.LISTING_TASKS)
    group = f"listing-{tmp_path.name}"
    spark.sparkContext.setJobGroup(group, "listing")
    files = inventory.list_files(spark, str(tmp_path), "*.csv")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [s.numTasks for s in stages] == [2 * spark.sparkContext.defaultParallelism]
    assert files.count() == 60 and spark.conf.get(inventory.LISTING_TASKS) == before
