"""Aggregate expressions with a fixed, engine-independent result.

Averages and percentages are computed in exact decimal arithmetic, rounded
half-up, then returned as DOUBLE so that results do not depend on the order
in which partial sums are combined.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def avg_exact(col: Column | str, scale: int = 6) -> Column:
    """AVG over a decimal column, rounded half-up to ``scale`` digits."""
    return F.round(F.avg(_c(col)), scale).cast("double")


def fill_pct(col: Column | str, scale: int = 2) -> Column:
    """Share of non-NULL values in percent: ROUND(COUNT(c) * 100 / COUNT(*), 2)."""
    return pct(F.count(_c(col)), F.count(F.lit(1)), scale)


def pct(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    num = numerator.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
    return F.round(num / denominator.cast("decimal(20,0)"), scale).cast("double")
