"""Co-located joins with a dimension too large to broadcast.

Fact and dimension are written as tables bucketed by the join key and a slice,
in as many buckets, so that their join moves no row of either. A key's rows are
dealt over the slices by a hash of another column: a hot key lies in as many
buckets as there are slices. The dimension holds every row once per slice.

The tables are entries of the session's catalogue over files at a given path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.splits import MAX_ROWS_PER_TASK

SLICE = "key_slice"
#: Slices of a key, and bytes of a bucket to aim at.
SLICES, BUCKET_BYTES = 8, 128 << 20
#: Rows of a bucket to aim at: one task sorts the rows that it writes into a
#: bucket, of all partitions (days).
BUCKET_ROWS = MAX_ROWS_PER_TASK


def bucket_count(partition_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for a fact whose partitions (days) hold about so many bytes."""
    return max(1, -(-partition_bytes // bucket_bytes))


def bucket_count_of_rows(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets for a fact of so many rows."""
    return max(1, -(-rows // bucket_rows))


def _save(df: DataFrame, table: str, path: str, key: str, buckets: int, sort_by: Sequence[str], partition_by: Sequence[str]) -> None:
    # the exchange places rows as the buckets do, so a task writes one file per bucket and partition
    writer = df.repartition(buckets, key, SLICE).write.format("parquet").bucketBy(buckets, key, SLICE).sortBy(key, SLICE, *sort_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("path", path).mode("overwrite").saveAsTable(table)


def write_fact(
    fact: DataFrame, table: str, path: str, key: str, spread_by: str, buckets: int, slices: int = SLICES,
    sort_by: Sequence[str] = (), partition_by: Sequence[str] = (),
) -> DataFrame:
    """The fact as a bucketed table with a column ``key_slice``, the slice of
    ``spread_by`` (NULL is a value)."""
    sliced = fact.withColumn(SLICE, F.pmod(F.xxhash64(spread_by), F.lit(slices)).cast("int"))
    _save(sliced, table, path, key, buckets, sort_by, partition_by)
    return fact.sparkSession.table(table)


def write_dimension(dim: DataFrame, table: str, path: str, key: str, buckets: int, slices: int = SLICES) -> DataFrame:
    """The dimension as a bucketed table, every row once per slice."""
    sliced = dim.withColumn(SLICE, F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    _save(sliced, table, path, key, buckets, (), ())
    return dim.sparkSession.table(table)


def is_sliced(df: DataFrame) -> bool:
    return SLICE in df.columns


def join_sliced(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of a bucketed fact (left) with its dimension, by merging buckets;
    equal to the join by ``key`` alone.  ``how`` is one of those that keep a
    fact row at most once per dimension row: inner, left, left_semi, left_anti."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a dimension held once per slice can't be joined by {how!r}")
    return fact.join(dim.hint("merge"), [key, SLICE], how).drop(SLICE)
