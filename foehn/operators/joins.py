"""Star joins between measurements and the station dimension
and the orphan check (fact rows without a dimension row).

A dimension is broadcast only after its rows and bytes are measured and
checked against bounds; above them the join is left to the planner
(sort-merge, with AQE free to switch to broadcast from the runtime size and to
split skewed partitions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizes import BROADCAST_BYTES, broadcast_if_small

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | None = None,
    how: str = "inner",
    left_on: str | None = None,
    right_on: str | None = None,
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fact-to-dimension equi-join with a size-checked broadcast of ``dim``."""
    if max_broadcast_rows is not None:
        dim = broadcast_if_small(dim, max_broadcast_bytes, max_broadcast_rows)
    if on is not None:
        return fact.join(dim, on, how)
    return fact.join(dim, fact[left_on] == dim[right_on], how)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (inner joins drop them)."""
    keys = dim.select(F.col(dim_key).alias("__k")).distinct()
    return fact.join(keys, fact[fact_key] == keys["__k"], "left_anti")
