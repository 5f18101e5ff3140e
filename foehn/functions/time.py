"""Time helpers: grid flooring, calendar parts and sargable ranges.

Relative ranges take an explicit ``as_of`` so every query is replayable;
``None`` means "now" in the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def floor_minutes(col: Column | str, minutes: int = 10) -> Column:
    """Floor a TIMESTAMP_NTZ to an n-minute grid (n divides 60).  Built from
    calendar parts, so it keeps NULL as NULL, keeps the NTZ type and does not
    depend on the session time zone."""
    if 60 % minutes:
        raise ValueError("minutes must divide 60")
    ts = _c(col)
    m = F.minute(ts)
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), m - m % F.lit(minutes), F.lit(0)
    )


def day_of_week(col: Column | str) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(_c(col)) - 1


def time_parts(ts: Column | str, prefix: str = "measurement") -> list[Column]:
    t = _c(ts)
    return [
        F.to_date(t).alias(f"{prefix}_date"),
        F.hour(t).alias(f"{prefix}_hour"),
        day_of_week(t).alias("day_of_week"),
        F.month(t).alias(f"{prefix}_month"),
        F.year(t).alias(f"{prefix}_year"),
    ]


def _date_lit(d: dt.date | None) -> Column:
    return F.current_date() if d is None else F.lit(d)


def ntz_literal(t: dt.datetime | dt.date) -> Column:
    """TIMESTAMP_NTZ literal from wall-clock text (no time-zone conversion)."""
    if not isinstance(t, dt.datetime):
        t = dt.datetime.combine(t, dt.time())
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _ts_lit(t: dt.datetime | None) -> Column:
    return F.current_timestamp().cast("timestamp_ntz") if t is None else ntz_literal(t)


def on_or_after_days_back(date_col: Column | str, as_of: dt.date | None, days: int) -> Column:
    """``date >= as_of - days`` (pushes down as a plain comparison)."""
    return _c(date_col) >= F.date_sub(_date_lit(as_of), days)


def on_day_before(date_col: Column | str, as_of: dt.date | None, days: int = 1) -> Column:
    return _c(date_col) == F.date_sub(_date_lit(as_of), days)


def within_hours(ts_col: Column | str, as_of_ts: dt.datetime | None, hours: int) -> Column:
    """``ts >= as_of_ts - n hours``."""
    return _c(ts_col) >= _ts_lit(as_of_ts) - F.make_dt_interval(F.lit(0), F.lit(hours))


def ts_date_range(ts_col: Column | str, start: dt.date, end_exclusive: dt.date) -> Column:
    """Half-open timestamp range for whole days; sargable, so the parquet
    reader can skip row groups (``year(ts) = y`` cannot be pushed)."""
    c = _c(ts_col)
    return (c >= ntz_literal(start)) & (c < ntz_literal(end_exclusive))


def from_year(ts_col: Column | str, first_year: int) -> Column:
    """On or after the first of January of the year; sargable."""
    return _c(ts_col) >= ntz_literal(dt.date(first_year, 1, 1))


def year_range(ts_col: Column | str, first_year: int, last_year: int | None = None) -> Column:
    last = first_year if last_year is None else last_year
    return ts_date_range(ts_col, dt.date(first_year, 1, 1), dt.date(last + 1, 1, 1))
