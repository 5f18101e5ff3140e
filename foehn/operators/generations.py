"""A partitioned table whose partitions are replaced together.

``root`` holds versions (see ``tables``): ``v000001`` ... are full contents,
partitioned by one column. A partial refresh of version n never changes its
files. It writes the new content of the touched partitions as a *generation*,
``g000001/gen=<name>/<column>=<value>/...``, and then, last, a *pointer*
``g000001/p000001``: one row for each partition that any partial refresh of
this version replaced, with the generation that now holds it, or NULL if the
partition is gone. Spark's ``_SUCCESS`` marks a pointer as complete, so a reader
sees all partitions of a refresh or none, and a reader that began before goes
on with the files it has.

A pointer has at most as many rows as there are partitions (days).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables

_POINTER = "p"


def _side(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/g{version:06d}"


def pointers(spark: SparkSession, root: str, version: int) -> list[int]:
    """Complete pointers of a version, ascending."""
    return tables.numbered_folders(spark, _side(root, version), _POINTER)


def pointer_path(root: str, version: int, n: int) -> str:
    return f"{_side(root, version)}/{_POINTER}{n:06d}"


def _pointer(spark: SparkSession, root: str, version: int, n: int, column_type: str) -> DataFrame:
    return spark.read.schema(f"part {column_type}, gen string").parquet(pointer_path(root, version, n))


def _folder(column: str, value) -> str:
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def _among(column: Column, values: list) -> Column:
    """Whether the partition is one of values (None: the NULL partition)."""
    some = [v for v in values if v is not None]
    found = F.coalesce(column.isin(some), F.lit(False)) if some else F.lit(False)
    return found | column.isNull() if None in values else found


def read(spark: SparkSession, root: str, column: str, version: int | None = None, pointer: int | None = None) -> DataFrame:
    """The table's rows with the partition column, as of its newest complete
    version and pointer (or those given)."""
    if version is None:
        version = tables.versions(spark, root)[-1]
    base = spark.read.parquet(tables.version_path(root, version))
    have = pointers(spark, root, version)
    if pointer is None:
        pointer = have[-1] if have else 0
    if not pointer:
        return base
    kind = dict(base.dtypes)[column]
    # partitions only: at most as many rows as days
    moved = [(r["part"], r["gen"]) for r in _pointer(spark, root, version, pointer, kind).collect()]
    out = base.filter(~_among(F.col(column), [p for p, _ in moved]))
    side = _side(root, version)
    paths = [f"{side}/gen={gen}/{_folder(column, part)}" for part, gen in moved if gen is not None]
    if not paths:
        return out
    newer = spark.read.schema(base.schema).option("basePath", side).parquet(*paths)
    return out.unionByName(newer.select(*base.columns))


def replace_partitions(rows: DataFrame, touched: DataFrame, root: str, column: str, options: dict[str, str] | None = None) -> int:
    """Replace the ``touched`` partitions (a frame with ``column``, NULL for
    the NULL partition) of the current version by ``rows``, which hold rows of
    those partitions only; a touched partition without rows is gone.  All of
    it becomes visible at once.  ``options`` go to the Parquet writer.  Returns
    the pointer's number."""
    spark = rows.sparkSession
    version = tables.versions(spark, root)[-1]
    side, gen = _side(root, version), uuid.uuid4().hex
    gen = f"x{gen}"  # never read as a number
    path = f"{side}/gen={gen}"
    rows.write.options(**(options or {})).partitionBy(column).parquet(path)
    kind = dict(rows.dtypes)[column]
    there = spark.read.schema(rows.schema).parquet(path).select(F.col(column).alias("part")).distinct().withColumn("gen", F.lit(gen))
    asked = touched.select(F.col(column).cast(kind).alias("asked")).distinct()
    new = asked.join(there, F.col("asked").eqNullSafe(F.col("part")), "left").select(F.col("asked").alias("part"), "gen")
    have = pointers(spark, root, version)
    if have:
        old = _pointer(spark, root, version, have[-1], kind)
        kept = old.join(asked, F.col("part").eqNullSafe(F.col("asked")), "left_anti")
        new = kept.unionByName(new)
    n = (have[-1] if have else 0) + 1
    new.coalesce(1).write.mode("errorifexists").parquet(pointer_path(root, version, n))
    return n


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` versions and, of each, all but the
    newest ``keep`` pointers with the generations that only older ones name.
    Readers of anything kept stay whole.  Call it while no refresh runs."""
    gone = tables.vacuum(spark, root, keep)
    kept = set(tables.versions(spark, root))
    fs, p = tables._fs(spark, root)
    sides = [st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("g")] if fs.exists(p) else []
    for side in sides:
        version = int(side.getName()[1:])
        if version not in kept:
            fs.delete(side, True)
            gone.append(str(side))
            continue
        have = pointers(spark, root, version)
        for n in have[:-keep]:
            tables.remove_path(spark, pointer_path(root, version, n))
        named = {r["gen"] for n in have[-keep:] for r in _pointer(spark, root, version, n, "string").select("gen").distinct().collect()}
        for st in fs.listStatus(side):
            name = st.getPath().getName()
            if name.startswith("gen=") and name[4:] not in named:
                fs.delete(st.getPath(), True)
                gone.append(f"{side}/{name}")
    return gone
