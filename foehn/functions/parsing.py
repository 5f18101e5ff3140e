"""Column expressions that turn raw CSV text into typed values.

All of them are built-in Spark expressions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DATE_FORMAT, NULL_TOKENS, TIMESTAMP_FORMAT


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_tokens(col: Column | str, tokens=NULL_TOKENS) -> Column:
    """Trimmed text, or NULL when it is one of the null tokens."""
    t = F.trim(_c(col))
    return F.when(~t.isin(*tokens), t)


def try_decimal(col: Column | str, type_: str = "decimal(38,10)") -> Column:
    """Tolerant numeric cast: unparsable text becomes NULL, extra decimals
    round half-up, overflow becomes NULL.  The null tokens never parse as
    numbers, so they need no separate test here."""
    return F.trim(_c(col)).try_cast(type_)


def parse_timestamp(col: Column | str, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Tolerant ``dd.MM.yyyy HH:mm`` parse to TIMESTAMP_NTZ: NULL when the
    text does not parse.  Independent of the session time zone."""
    t = F.trim(_c(col))
    if fmt != TIMESTAMP_FORMAT:
        return F.to_timestamp_ntz(t, F.lit(fmt))
    # day.month.year hour:minute -> five numbers; anything else -> NULL.  Where
    # the shape is right the separators cut it; a split by a pattern would
    # compile that for every row and number
    cut = F.substring_index
    date, time = cut(t, " ", 1), cut(t, " ", -1)
    day, month, year = cut(date, ".", 1), cut(cut(date, ".", 2), ".", -1), cut(date, ".", -1)
    hour, minute = cut(time, ":", 1), cut(time, ":", -1)
    shape_ok = t.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4} \d{1,2}:\d{2}$")
    return F.when(
        shape_ok,
        F.try_make_timestamp_ntz(
            year.cast("int"), month.cast("int"), day.cast("int"), hour.cast("int"), minute.cast("int"), F.lit(0)
        ),
    )


def parse_date(col: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """Tolerant date parse: bad text becomes NULL."""
    return F.try_to_date(null_tokens(col), fmt)


def bad_value(raw: Column, parsed: Column) -> Column:
    """True where text was present but could not be converted."""
    return null_tokens(raw).isNotNull() & parsed.isNull()


def too_long(col: Column | str, max_len: int) -> Column:
    return F.coalesce(F.length(null_tokens(col)) > F.lit(max_len), F.lit(False))
