"""Measured sizes, for the checks in front of broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side of a join is broadcast up to this many bytes in memory.
BROADCAST_BYTES = 64 << 20

#: Bytes of a row beside its fields: null bits, lengths and the hash table's
#: entry.
ROW_BYTES = 56


def _field_bytes(field: T.StructField) -> Column:
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.DecimalType) and kind.precision > 18:
        return F.lit(24)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) * 2 + 16
    return F.lit(8)


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes in memory) of a frame, in one pass that sends two numbers
    per task."""
    width = sum((_field_bytes(f) for f in df.schema.fields), F.lit(ROW_BYTES))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES, max_rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is within the bounds,
    else as it is (the planner then joins by sort-merge)."""
    rows, size = measured_size(df)
    return F.broadcast(df) if size <= max_bytes and (max_rows is None or rows <= max_rows) else df
