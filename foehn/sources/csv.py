"""CSV scans of measurement and station files.

Files are read with an explicit all-string positional schema (no inference,
header skipped and never checked), so a short row yields NULLs and extra
fields are ignored (PERMISSIVE).  The typed projection is written once and
shared by every tier.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import bad_value, null_tokens, parse_date, parse_timestamp, too_long, try_decimal
from ..operators.rejects import REASON, reject_reason
from ..schema import (
    MEASURE_CODES,
    MEASURE_TYPE,
    MEASUREMENT_CSV_FIELDS,
    STATION_ABBR_MAX_LEN,
    STATION_CSV_FIELDS,
    STATION_FIELDS,
    raw_schema,
)

CSV_OPTIONS = {
    "sep": ";",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
    "multiLine": "false",
}


def _uri(path: str) -> str:
    if re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", path):
        return path.rstrip("/")
    return "file:" + os.path.abspath(path).rstrip("/")


def relative_path(path: Column, root: str) -> Column:
    """``path`` (a full file URI) relative to the landing root.  A path that
    begins with the root's own text, which is every one of a scan below it, is
    cut without a pattern: this runs for every row."""
    scheme, _, rest = _uri(root).partition(":")
    prefix = rest.lstrip("/")  # without the scheme: file:/a and file:///a are one place
    inner = F.ltrim(F.regexp_replace(path, "^[a-zA-Z][a-zA-Z0-9+.-]*:", ""), F.lit("/"))
    rest = inner.substr(F.lit(len(prefix) + 2), F.char_length(inner))
    found = F.when(inner.startswith(prefix + "/"), rest).otherwise(path)
    for slashes in ("/", "//", "///"):
        start = f"{scheme}:{slashes}{prefix}/"
        found = F.when(path.startswith(start), F.substring(path, len(start) + 1, 2**31 - 1)).otherwise(found)
    return found


def relative_file_name(root: str) -> Column:
    """Source path relative to the landing root (``bas/x_t_now.csv``)."""
    return relative_path(decoded_path(F.col("_metadata.file_path")), root)


def decoded_path(uri: Column) -> Column:
    """The path as file listings give it: ``_metadata.file_path`` is a URI in
    which blanks and non-ASCII characters are percent-encoded ("+" is not).  A
    URI without a percent sign is the path."""
    return F.when(uri.contains("%"), F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))).otherwise(uri)


def read_raw_csv(
    spark: SparkSession,
    root: str,
    glob: str,
    n_fields: int,
    encoding: str = "UTF-8",
    paths: list[str] | None = None,
) -> DataFrame:
    """Recursive scan of ``root`` for files matching ``glob``
    (or exactly ``paths``, files under ``root``); columns ``c1..cN`` plus
    ``file_name``."""
    reader = spark.read.schema(raw_schema(n_fields)).options(**CSV_OPTIONS)
    reader = reader.option("encoding", encoding)
    if paths is None:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        df = reader.csv(root)
    else:
        df = reader.csv(paths)
    return df.select(*[F.col(f"c{i}") for i in range(1, n_fields + 1)], relative_file_name(root).alias("file_name"))


def parse_lines(df: DataFrame, line_col: str, n_fields: int, keep: list[str] | None = None) -> DataFrame:
    """Positional split of CSV text lines already in a DataFrame (same
    options as the file reader)."""
    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "multiLine")}
    parsed = F.from_csv(F.col(line_col), raw_schema(n_fields).simpleString(), opts)
    cols = [parsed[f"c{i}"].alias(f"c{i}") for i in range(1, n_fields + 1)]
    return df.select(*cols, *[F.col(k) for k in (keep or [])])


def load_time(loaded_at=None) -> Column:
    """Load time, UTC without zone; a parameter makes loads replayable."""
    if loaded_at is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(loaded_at).cast("timestamp_ntz")


def typed_measurements(raw: DataFrame, loaded_at=None) -> DataFrame:
    """S8 + X1/X4 + K2 rule: typed bronze rows with ``reject_reason``.

    Rejected: timestamp text that does not parse; station code longer than
    its column.  Kept: NULL timestamp, unparsable measures (become NULL).
    """
    ts = parse_timestamp("c2")
    station = null_tokens("c1")
    measures = [try_decimal(f"c{i + 3}", MEASURE_TYPE).alias(code) for i, code in enumerate(MEASURE_CODES)]
    reason = reject_reason(
        [
            ("station_abbr_too_long", too_long("c1", STATION_ABBR_MAX_LEN)),
            ("bad_reference_timestamp", bad_value(F.col("c2"), ts)),
        ]
    )
    return raw.select(
        station.alias("station_abbr"),
        ts.alias("reference_timestamp"),
        *measures,
        F.col("file_name"),
        load_time(loaded_at).alias("loaded_at"),
        reason.alias(REASON),
    )


def typed_stations(raw: DataFrame, loaded_at=None) -> DataFrame:
    """S9 + X2/X5: typed station rows with ``reject_reason`` (over-length text)."""
    cols = []
    checks = []
    for i, (name, type_, max_len) in enumerate(STATION_FIELDS, start=1):
        src = f"c{i}"
        if type_ == "string":
            cols.append(null_tokens(src).alias(name))
            if max_len is not None:
                checks.append((f"{name}_too_long", too_long(src, max_len)))
        elif type_ == "date":
            cols.append(parse_date(src).alias(name))
        else:
            cols.append(try_decimal(src, type_).alias(name))
    return raw.select(
        *cols,
        F.col("file_name"),
        load_time(loaded_at).alias("loaded_at"),
        reject_reason(checks).alias(REASON),
    )


def read_measurements(spark: SparkSession, root: str, glob: str, loaded_at=None) -> DataFrame:
    return typed_measurements(read_raw_csv(spark, root, glob, MEASUREMENT_CSV_FIELDS), loaded_at)


def read_stations(spark: SparkSession, root: str, glob: str = "*meta_stations.csv", loaded_at=None) -> DataFrame:
    raw = read_raw_csv(spark, root, glob, STATION_CSV_FIELDS, encoding="ISO-8859-1")
    return typed_stations(raw, loaded_at)
