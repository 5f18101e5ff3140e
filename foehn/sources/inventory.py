"""Landing-zone file inventory (S12) and incremental file selection
(S15/S16 anti joins against what is already landed or loaded)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Tasks per core of the job that lists folders: Spark's own bound is 10,000
#: in all, so it starts a task for a single folder.
LISTING_TASKS_PER_CORE = 32


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a listing of many folders runs as so many tasks a core
    at most; then the session has its setting again."""
    try:
        want = spark.sparkContext.defaultParallelism * LISTING_TASKS_PER_CORE
    except Exception:  # noqa: BLE001 - no classic context (e.g. Spark Connect)
        yield
        return
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), want)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, size and modification time of every file under ``root``
    matching ``glob``, ordered by path (R4).  The content column is pruned,
    so files are not read."""
    with _few_listing_tasks(spark):  # load() lists
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return files.select(
        F.col("path").alias("file_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    ).orderBy("file_path")


def not_yet_loaded(files: DataFrame, loaded: DataFrame, key: str = "file_name") -> DataFrame:
    """Files whose name is absent from the loaded set (FORCE=FALSE)."""
    done = loaded.select(F.col(key)).distinct()
    return files.join(done, key, "left_anti")
