"""Versioned Parquet tables: atomic replace (K3), append (K1), keyed upsert
(K4) and day-partitioned refresh, on plain files.

A table is a folder of versions ``v000001``, ``v000002`` ...; readers use
the highest version that Spark's job commit marked with ``_SUCCESS``.  A
write never touches the version being read, so a job may read a table and
write its next version (Spark refuses to overwrite a path it reads), and a
failed job leaves no committed version behind.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rejects import staged
from .upsert import ACTION, merging, prepare_source

class EmptyBatchError(ValueError):
    """A replace was asked for with no rows; the current content stays."""



def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def numbered_folders(spark: SparkSession, root: str, prefix: str) -> list[int]:
    """Numbers of the committed folders ``<prefix><number>``, ascending."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = re.match(rf"^{prefix}(\d+)$", st.getPath().getName())
        if m and st.isDirectory() and fs.exists(st.getPath().suffix("/_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, ascending."""
    return numbered_folders(spark, root, "v")


def version_path(root: str, v: int) -> str:
    return f"{root.rstrip('/')}/v{v:06d}"


def current_path(spark: SparkSession, root: str) -> str | None:
    vs = versions(spark, root)
    return version_path(root, vs[-1]) if vs else None


def read_table(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version; an empty frame of ``schema`` if none exists."""
    path = current_path(spark, root)
    if path is None:
        if schema is None:
            raise FileNotFoundError(root)
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_table_partitioned(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """A plain partitioned table folder; an empty frame of ``schema`` if absent."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        if schema is None:
            raise FileNotFoundError(root)
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(root)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder (staged copies) if it exists."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def write_version(df: DataFrame, root: str, partition_by: Sequence[str] = (), options: dict[str, str] | None = None) -> str:
    """Write ``df`` as the next version and return its path.  ``options`` go
    to the Parquet writer."""
    spark = df.sparkSession
    vs = versions(spark, root)
    path = version_path(root, (vs[-1] if vs else 0) + 1)
    w = df.write.mode("errorifexists").options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def replace(df: DataFrame, root: str, allow_empty: bool = False, partition_by: Sequence[str] = ()) -> int:
    """K3: full atomic replace.  Refuses to publish an empty version unless
    ``allow_empty`` (the current content stays); that is checked before
    anything is published.  Returns rows written."""
    if not allow_empty and df.isEmpty():
        raise EmptyBatchError(f"refusing to replace {root} with an empty batch")
    obs = Observation("replace")
    write_version(df.observe(obs, F.count(F.lit(1)).alias("rows")), root, partition_by)
    return int(obs.get["rows"])


def append(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """K1: append the batch's files to a plain (partitioned) table folder;
    O(batch), old files are not rewritten.  Spark commits the job as a whole,
    so a failed batch adds nothing."""
    path = root
    obs = Observation("append")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


def upsert(
    source: DataFrame,
    root: str,
    keys: Sequence[str],
    order: Sequence[Column | str] = (),
    schema: T.StructType | None = None,
) -> dict[str, int]:
    """K4 + K5: MERGE ``source`` into the table as a new version; returns
    the counters, taken while the version is written (no extra pass)."""
    spark = source.sparkSession
    target = read_table(spark, root, schema or source.schema)
    with staged(prepare_source(source, keys, order), "upsert-source") as src, merging(target, src, keys) as merged:
        counted, obs = _counted(merged, "rows_total")
        write_version(counted, root)
    return {k: int(v) for k, v in obs.get.items()}


def _counted(merged: DataFrame, total: str) -> tuple[DataFrame, Observation]:
    """The merged rows, their counters taken while they are written."""
    obs, a = Observation("upsert"), F.col(ACTION)
    out = merged.observe(
        obs,
        F.count_if(a == "inserted").alias("rows_inserted"),
        F.count_if(a == "updated").alias("rows_updated"),
        F.count(F.lit(1)).alias(total),
    )
    return out.drop(ACTION), obs


def touched_partitions(spark: SparkSession, root: str, source: DataFrame, partition_col: str) -> DataFrame:
    """Rows of the partitions that ``source`` touches.

    A semi join on the partition column, whatever the number of partitions:
    the touched values are broadcast (at most as many as calendar days), and
    dynamic pruning reads only their folders.  The comparison with the empty
    text is true of every value; it tells the planner that the list is
    selective.  A NULL value touches the NULL partition."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return spark.createDataFrame([], source.schema)
    target = spark.read.schema(source.schema).parquet(root)
    touched = source.select(F.col(partition_col).alias("__touched")).distinct()
    known = touched.filter(F.col("__touched").cast("string") >= "")
    out = target.join(F.broadcast(known), F.col(partition_col) == F.col("__touched"), "left_semi")
    if not touched.filter(F.col("__touched").isNull()).isEmpty():
        out = out.unionByName(target.filter(F.col(partition_col).isNull()))
    return out.select(*source.columns)


def upsert_partitions(
    source: DataFrame,
    root: str,
    keys: Sequence[str],
    partition_col: str,
    order: Sequence[Column | str] = (),
    prepared: bool = False,
) -> dict[str, int]:
    """K4 for a day-partitioned table: only the partitions present in the
    source are read, once (semi-join on the partition column, so Spark prunes
    the others at run time), merged through a staged copy (the job replaces
    the partitions it read) and written back with dynamic partition overwrite.
    Other days are never touched.  ``partition_col`` must be derivable from
    the key, so a key never spans two partitions.  ``prepared`` tells that the
    source is staged and has one row per key already."""
    if not prepared:
        with staged(prepare_source(source, keys, order), "upsert-source") as src:
            return upsert_partitions(src, root, keys, partition_col, prepared=True)
    target = touched_partitions(source.sparkSession, root, source, partition_col)
    with merging(target, source, keys) as merged:
        counted, obs = _counted(merged, "rows_written")
        (
            counted.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition_col)
            .parquet(root)
        )
    return {k: int(v) for k, v in obs.get.items()}


def vacuum(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Delete all but the newest ``keep`` committed versions."""
    vs = versions(spark, root)
    gone = [version_path(root, v) for v in vs[:-keep]] if keep > 0 else []
    for p in gone:
        _drop(spark, p)
    return gone
