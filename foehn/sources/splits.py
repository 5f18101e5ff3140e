"""Input splits: keep every core busy on coarsely split inputs.

Spark splits a Parquet file only at row-group boundaries, so a file written
as a single row group is read by one task, and every expression fused into
that scan stage (CSV rendering, parsing, decimal casts) runs on one core.
``spread`` round-robins such an input over the session's cores.  A file of a
few row groups has as many byte ranges as any other, but all rows lie in a few
of them: the rows of every split are counted, and an input is dealt out anew
if fewer splits than cores hold rows or one holds more than a task should
turn into wide rows.  Any other input passes through unchanged, so no shuffle
is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A task gets at least this much input file; a small file on a large cluster
# is spread over a few tasks, not over every core.
MIN_BYTES_PER_TASK = 64 * 1024

# Rows a task turns into wide ones at most: a measurement takes about half a
# kilobyte in memory, and a task sorts its rows.
MAX_ROWS_PER_TASK = 500_000


def input_splits(df: DataFrame) -> int | None:
    """Number of partitions the scan of ``df`` yields (planning only, no job);
    None where the session has no RDD API (e.g. Spark Connect)."""
    try:
        return df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no classic context
        return None


def parallelism(df: DataFrame) -> int | None:
    try:
        return df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no classic context
        return None


def input_bytes(df: DataFrame, max_files: int) -> int | None:
    """Total size of the files ``df`` reads (file-system metadata only), or
    None when it reads more than ``max_files`` files or sizes are unknown."""
    try:
        files = df.inputFiles()
        if not files or len(files) > max_files:
            return None
        sc = df.sparkSession.sparkContext
        conf = sc._jsc.hadoopConfiguration()
        total = 0
        for f in files:
            p = sc._jvm.org.apache.hadoop.fs.Path(f)
            total += p.getFileSystem(conf).getFileStatus(p).getLen()
        return total
    except Exception:  # noqa: BLE001 - no classic context
        return None


def split_rows(df: DataFrame) -> list[int]:
    """Rows of every split that holds any, one number per task.  No column is
    read: Parquet takes the numbers from its footers."""
    counts = df.select(F.spark_partition_id().alias("__part")).groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    return [int(r["n"]) for r in counts.collect()]


def spread(
    df: DataFrame, cores: int | None = None, min_bytes: int = MIN_BYTES_PER_TASK, max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """``df`` round-robined over up to ``cores`` partitions (default: the
    session's parallelism) when fewer splits than that hold rows, and over as
    many more as keep each at ``max_rows``, also when one split holds more;
    otherwise ``df``.  Of the partitions up to ``cores`` none gets less than
    ``min_bytes`` of input file.

    Filters above the result are still pushed below the repartition into the
    scan, so only the rows a query keeps are moved.
    """
    want = cores or parallelism(df)
    have = input_splits(df)
    if want is None or have is None:
        return df
    rows = split_rows(df)
    have = len(rows)
    if have >= want and max(rows) <= max_rows:
        return df
    size = input_bytes(df, max_files=want)
    if size is not None:
        want = min(want, max(1, -(-size // min_bytes)))
    want = max(want, -(-sum(rows) // max_rows))
    return df if want <= have and max(rows, default=0) <= max_rows else df.repartition(want)
