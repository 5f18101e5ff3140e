"""Row rejection for tolerant loads (K2) and all-or-nothing loads (K1).

A row is rejected when a field that carried text could not be converted to a
type that has no NULL fallback in the target (the reference timestamp), or
when a code is longer than its column allows.  Measures that do not parse
become NULL and keep the row.  A NULL timestamp (empty field) keeps the row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def reject_reason(checks: list[tuple[str, Column]]) -> Column:
    """First failing check's name, or NULL when the row is good."""
    expr = F.lit(None).cast("string")
    for name, failed in reversed(checks):
        expr = F.when(failed, F.lit(name)).otherwise(expr)
    return expr


def split_rejects(df_with_reason: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the reason column, rejected rows with it)."""
    good = df_with_reason.filter(F.col(REASON).isNull()).drop(REASON)
    bad = df_with_reason.filter(F.col(REASON).isNotNull())
    return good, bad


def fail_on_rejects(df_with_reason: DataFrame) -> DataFrame:
    """K1: the load aborts as a whole on the first bad row.  The check runs
    inside the write job, so no extra pass over the data is made."""
    r = F.col(REASON)
    guard = F.when(r.isNotNull(), F.raise_error(F.concat(F.lit("rejected row: "), r)))
    return df_with_reason.filter(guard.isNull()).drop(REASON)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """K6: materialise a parsed batch once, so the good rows and the rejects
    are both read from the staged copy instead of parsing the input twice.

    The batch is written as Parquet to a fresh folder inside the session's
    checkpoint folder (shared storage on a cluster) and read back: the
    lineage is cut, so a lost executor re-reads the staged files, the copy
    is compressed and columnar, and a reader of the rejects reads only the
    columns it selects."""
    return _stage(df, name)[0]


def _stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    from ..session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """``stage`` for one block of work (a load, a micro-batch): the staged
    folder is removed when the block ends, so repeated loads do not pile up
    copies in the checkpoint folder; if the block raises it stays, as it may
    be the only copy left of rows that an overwrite has already removed.  Every job reading the copy must run
    inside the block."""
    from .tables import remove_path

    out, path = _stage(df, name)
    yield out
    remove_path(df.sparkSession, path)
