"""Bronze loads (R1-R3 and the historical backfill) with a load ledger (K7).

Each load reads the landed CSV files of one tier, types them, sets rejected
rows aside, writes the tier table and returns one ledger row (status
``SUCCESS`` or ``FAILED`` with the error text - a failure is reported, not
raised).  The ledger row is also appended to ``ledger_root`` when given.

Table layouts:

* historical - append-only, partitioned by load and day; files already in the
  ledger are skipped (FORCE=FALSE) and any bad row aborts the batch
  (ON_ERROR=ABORT).  Rows of a load become visible with its ledger row
  (``read_historical``): data, file list and ledger are one commit.
* recent - day-partitioned, keyed upsert that rewrites only touched days.
* now, stations - versioned, fully replaced; an empty batch never replaces.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import tables
from ..operators.dedup import row_fingerprint
from ..operators.rejects import REASON, fail_on_rejects, split_rejects, staged
from ..operators.upsert import prepare_source
from ..operators.sizes import broadcast_if_small
from ..schema import BRONZE_COLUMNS, FINGERPRINT, KEY_COLUMNS, MEASURE_CODES, TIER_SPECS, bronze_measurement_schema, bronze_station_schema
from ..sources import csv as csv_src
from ..sources.inventory import list_files

PARTITION_COLUMN = "measurement_date"
LOAD_COLUMN = "load_id"
#: Load of rows that were loaded without a ledger: always visible.
UNLEDGERED = "unledgered"

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("procedure", T.StringType()),
        T.StructField("data_tier", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("files_found", T.LongType()),
        T.StructField("files_loaded", T.LongType()),
        T.StructField("rows_parsed", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("rows_null_key", T.LongType()),
        T.StructField("rows_duplicate_key", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("load_id", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _ledger_row(spark: SparkSession, stats: dict, ledger_root: str | None) -> DataFrame:
    row = {f.name: stats.get(f.name) for f in LEDGER_SCHEMA.fields}
    row["errors"] = list(stats.get("errors") or [])
    df = spark.createDataFrame([row], LEDGER_SCHEMA)
    if ledger_root:
        df.write.mode("append").parquet(ledger_root)
    return df


def read_ledger(spark: SparkSession, ledger_root: str) -> DataFrame:
    """All ledger rows; none if the ledger does not exist yet (any other
    failure is raised: an unread ledger would have files loaded again)."""
    if not tables.exists(spark, ledger_root):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_root)


FILE_SCHEMA = "file_name string, size long, last_modified timestamp, load_id string"


def files_root(ledger_root: str) -> str:
    return f"{ledger_root.rstrip('/')}_files"


def loaded_files(spark: SparkSession, ledger_root: str) -> DataFrame:
    """Historical files of successful loads: one row per file and state of it
    (name, size, modification time), so a file published again under its name
    counts as new."""
    root = files_root(ledger_root)
    if not tables.exists(spark, root):
        return spark.createDataFrame([], FILE_SCHEMA)
    done = broadcast_if_small(succeeded(spark, ledger_root).select("load_id"))
    return spark.read.schema(FILE_SCHEMA).parquet(root).join(done, "load_id", "left_semi")


def pending_files(spark: SparkSession, landing_root: str, ledger_root: str | None, glob: str | None = None) -> DataFrame:
    """Landed historical files (name, size, modification time) that no
    successful load has read in this state."""
    landed = list_files(spark, landing_root, glob or TIER_SPECS["historical"].glob)
    landed = landed.withColumn("file_name", csv_src.relative_path(F.col("file_path"), landing_root))
    if not ledger_root:
        return landed
    return landed.join(loaded_files(spark, ledger_root), ["file_name", "size", "last_modified"], "left_anti")


def load_history(ledger: DataFrame, tier: str, as_of: dt.datetime, hours: int = 1) -> DataFrame:
    """Ledger rows of one tier started within the last ``hours``."""
    since = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz") - F.make_dt_interval(
        F.lit(0), F.lit(hours)
    )
    return ledger.filter((F.col("data_tier") == tier) & (F.col("start_time") >= since))


def succeeded(spark: SparkSession, ledger_root: str) -> DataFrame:
    """Ledger rows of the loads that count."""
    return read_ledger(spark, ledger_root).filter("status = 'SUCCESS'")


def run_load(
    spark, procedure, tier, ledger_root, body: Callable[[dict], None], raise_: bool = False, batch: str | None = None
) -> DataFrame:
    """One load and its ledger row.  With ``raise_`` a failure is also raised
    (a stream must not commit a micro-batch that was not loaded).  ``batch``
    names a micro-batch: one that already succeeded is not run again, and its
    ledger row is returned."""
    if batch is not None and ledger_root:
        done = succeeded(spark, ledger_root).filter(F.col("batch") == batch).limit(1)
        if not done.isEmpty():
            return done
    # the letter keeps an id of digits from being read as a number in a folder name
    stats = {"procedure": procedure, "data_tier": tier, "start_time": _now(), "errors": [], "load_id": f"l{uuid.uuid4().hex}", "batch": batch}
    try:
        body(stats)
        stats["status"] = "SUCCESS"
    except Exception as e:  # noqa: BLE001 - reported in the ledger like the source system
        stats["status"] = "FAILED"
        stats["errors"].append(f"{type(e).__name__}: {e}")
        if raise_:
            stats["end_time"] = _now()
            _ledger_row(spark, stats, ledger_root)
            raise
    stats["end_time"] = _now()
    return _ledger_row(spark, stats, ledger_root)


def _typed_batch(spark, landing_root, tier, loaded_at, stats, paths: list[str] | None = None, glob: str | None = None):
    spec = TIER_SPECS[tier]
    glob = glob or spec.glob
    raw = csv_src.read_raw_csv(
        spark, landing_root, glob,
        csv_src.MEASUREMENT_CSV_FIELDS if tier != "stations" else csv_src.STATION_CSV_FIELDS,
        encoding=spec.encoding, paths=paths,
    )
    if paths is None:
        # the scan's own file index (listed once, on the driver or by a
        # parallel listing job), not a second listing of the landing folder
        stats["files_found"] = len(raw.inputFiles())
    typed = csv_src.typed_stations(raw, loaded_at) if tier == "stations" else csv_src.typed_measurements(raw, loaded_at)
    return typed


def _observe_counts(df: DataFrame, name: str):
    obs = Observation(name)
    r = F.col(REASON)
    df = df.observe(
        obs,
        F.count(F.lit(1)).alias("rows_parsed"),
        F.count_if(r.isNotNull()).alias("rows_rejected"),
    )
    return df, obs


def rejects_root(ledger_root: str) -> str:
    return f"{ledger_root.rstrip('/')}_rejects"


REJECT_COLUMNS = ["load_id", "data_tier", "file_name", "station_abbr", "reference_timestamp", "loaded_at", "reason"]


def _keep_rejects(bad: DataFrame, reason: str, tier: str, stats: dict, ledger_root: str | None) -> None:
    """Append rows that a load leaves out, with the reason, to the rejects
    table beside the ledger."""
    if not ledger_root:
        return
    time = F.col("reference_timestamp") if "reference_timestamp" in bad.columns else F.lit(None).cast("timestamp_ntz")
    rows = bad.select(
        F.lit(stats["load_id"]).alias("load_id"), F.lit(tier).alias("data_tier"), "file_name", "station_abbr",
        time.alias("reference_timestamp"), "loaded_at", F.col(reason).alias("reason"),
    )
    rows.write.mode("append").parquet(rejects_root(ledger_root))


def read_rejects(spark: SparkSession, ledger_root: str) -> DataFrame:
    """Rows left out by the loads that count.  What an attempt without a
    SUCCESS row left behind is not among them."""
    schema = "load_id string, data_tier string, file_name string, station_abbr string, reference_timestamp timestamp_ntz, loaded_at timestamp_ntz, reason string"
    if not tables.exists(spark, rejects_root(ledger_root)):
        return spark.createDataFrame([], schema)
    done = broadcast_if_small(succeeded(spark, ledger_root).select("load_id"))
    return spark.read.schema(schema).parquet(rejects_root(ledger_root)).join(done, "load_id", "left_semi")


def _files(batch: DataFrame) -> int:
    return batch.select("file_name").distinct().count()


def newest_run(spark: SparkSession, landing_root: str, glob: str) -> str:
    """The folder of the newest landing run.  A run is a folder ``run=<n>`` of
    the landing root that holds the files of all stations of one fetch; the
    newest is the longest, then largest name.  A root without run folders is
    one run itself."""
    name = F.regexp_extract(csv_src.relative_path(F.col("file_path"), landing_root), "^(run=[^/]+)/", 1)
    newest = list_files(spark, landing_root, glob).select(F.struct(F.length(name).alias("n"), name.alias("run")).alias("r")).agg(F.max("r")).first()[0]
    return f"{landing_root.rstrip('/')}/{newest['run']}" if newest and newest["run"] else landing_root


def load_now(spark, landing_root, table_root, loaded_at=None, ledger_root=None, allow_empty=False,
             glob=None, raise_=False, batch=None) -> DataFrame:
    """Live tier, tolerant parse, full replace by the files of the newest
    landing run.  ``glob`` overrides the tier's file-name pattern."""

    def body(stats):
        run = newest_run(spark, landing_root, glob or TIER_SPECS["now"].glob)
        typed, obs = _observe_counts(_typed_batch(spark, run, "now", loaded_at, stats, glob=glob), "now")
        with staged(typed) as rows:
            m = obs.get
            stats.update(rows_parsed=m["rows_parsed"], rows_rejected=m["rows_rejected"], files_loaded=_files(rows))
            good, bad = split_rejects(rows)
            _keep_rejects(bad, REASON, stats["data_tier"], stats, ledger_root)
            stats["rows_loaded"] = tables.replace(with_fingerprint(good), table_root, allow_empty=allow_empty)

    return run_load(spark, "load_now", "now", ledger_root, body, raise_, batch)


def load_stations(spark, landing_root, table_root, loaded_at=None, ledger_root=None, allow_empty=False,
                  glob=None) -> DataFrame:
    """Station metadata (Latin-1), tolerant parse, full replace."""

    def body(stats):
        typed, obs = _observe_counts(
            _typed_batch(spark, landing_root, "stations", loaded_at, stats, glob=glob), "stations"
        )
        with staged(typed) as batch:
            m = obs.get
            stats.update(rows_parsed=m["rows_parsed"], rows_rejected=m["rows_rejected"], files_loaded=_files(batch))
            good, bad = split_rejects(batch)
            _keep_rejects(bad, REASON, stats["data_tier"], stats, ledger_root)
            stats["rows_loaded"] = tables.replace(good, table_root, allow_empty=allow_empty)

    return run_load(spark, "load_stations", "stations", ledger_root, body)


def with_partition(df: DataFrame) -> DataFrame:
    return with_fingerprint(df).withColumn(PARTITION_COLUMN, F.to_date("reference_timestamp"))


def with_fingerprint(df: DataFrame) -> DataFrame:
    """Measurement rows as the bronze tables store them."""
    return df.withColumn(FINGERPRINT, row_fingerprint(MEASURE_CODES))


def upsert_recent(
    typed: DataFrame, table_root: str, stats: dict, ledger_root: str | None,
    then: Callable[[DataFrame], None] | None = None,
) -> None:
    """Upsert a typed batch into the day-partitioned recent table; rows left
    out are kept and counted.  The batch is parsed once and numbered by key
    once.  ``then`` gets the touched days."""
    spark = typed.sparkSession
    obs, r = Observation("recent"), F.col(REASON)
    no_key = F.col(KEY_COLUMNS[0]).isNull() | F.col(KEY_COLUMNS[1]).isNull()
    typed = typed.observe(
        obs, F.count(F.lit(1)).alias("rows_parsed"), F.count_if(r.isNotNull()).alias("rows_rejected"),
        F.count_if(r.isNull() & no_key).alias("rows_null_key"),
    )
    order = [F.col("loaded_at").desc_nulls_last(), F.col("file_name").asc_nulls_last()]
    with staged(typed, "recent-batch") as batch:
        stats.update({k: int(v) for k, v in obs.get.items()}, files_loaded=_files(batch))
        left_out = batch.withColumn(REASON, F.coalesce(REASON, F.when(no_key, F.lit("null_key"))))
        good, bad = split_rejects(left_out)
        firsts, seen = prepare_source(good, KEY_COLUMNS, order), Observation("firsts")
        firsts = with_partition(firsts).observe(seen, F.count(F.lit(1)).alias("n"))
        with staged(firsts, "recent-source") as src:
            stats["rows_duplicate_key"] = stats["rows_parsed"] - stats["rows_rejected"] - stats["rows_null_key"] - seen.get["n"]
            if stats["rows_parsed"] > seen.get["n"]:
                # rows of a key after its first: the batch less the firsts, compared on the columns that are kept
                kept = ["file_name", "station_abbr", "reference_timestamp", "loaded_at"]
                rest = good.select(*kept).exceptAll(src.select(*kept)).withColumn(REASON, F.lit("duplicate_key"))
                _keep_rejects(bad.select(*kept, REASON).unionByName(rest), REASON, "recent", stats, ledger_root)
            counts = tables.upsert_partitions(src, table_root, KEY_COLUMNS, PARTITION_COLUMN, prepared=True)
            if then is not None:
                then(src.select(PARTITION_COLUMN).distinct())
    stats["rows_inserted"] = counts["rows_inserted"]
    stats["rows_updated"] = counts["rows_updated"]
    stats["rows_loaded"] = spark.read.parquet(table_root).count()


def load_recent(spark, landing_root, table_root, loaded_at=None, ledger_root=None, glob=None) -> DataFrame:
    """R2: recent tier, tolerant parse, keyed upsert of the touched days."""

    def body(stats):
        upsert_recent(_typed_batch(spark, landing_root, "recent", loaded_at, stats, glob=glob), table_root, stats, ledger_root)

    return run_load(spark, "load_recent", "recent", ledger_root, body)


def load_historical(spark, landing_root, table_root, loaded_at=None, ledger_root=None, glob=None) -> DataFrame:
    """Backfill: strict parse (any bad row fails the batch), files already in
    the ledger are skipped, new rows are appended by day."""

    def body(stats):
        # file listing only (no content read); the loaded set comes from the ledger
        landed = list_files(spark, landing_root, glob or TIER_SPECS["historical"].glob)
        stats["files_found"] = landed.count()
        with staged(pending_files(spark, landing_root, ledger_root, glob), "pending-files") as pending:
            # file paths are listing metadata (the driver lists them for any scan)
            paths = [r["file_path"] for r in pending.select("file_path").collect()]
            stats["files_loaded"] = len(paths)
            if not paths:
                stats.update(rows_parsed=0, rows_rejected=0, rows_loaded=0)
                return
            typed, obs = _observe_counts(_typed_batch(spark, landing_root, "historical", loaded_at, stats, paths), "hist")
            if ledger_root:
                # counts only once the ledger row says SUCCESS
                files = pending.select("file_name", "size", "last_modified", F.lit(stats["load_id"]).alias("load_id"))
                files.write.mode("append").parquet(files_root(ledger_root))
            load = F.lit(stats["load_id"] if ledger_root else UNLEDGERED)
            rows = with_partition(fail_on_rejects(typed)).withColumn(LOAD_COLUMN, load)
            rows = tables.append(rows, table_root, [LOAD_COLUMN, PARTITION_COLUMN])
            m = obs.get
            stats.update(rows_parsed=m["rows_parsed"], rows_rejected=m["rows_rejected"], rows_loaded=rows)

    return run_load(spark, "load_historical", "historical", ledger_root, body)


def read_historical(spark: SparkSession, table_root: str, ledger_root: str | None = None, fingerprint: bool = False) -> DataFrame:
    """Historical rows in bronze columns with their day, of the loads that
    count: those with a SUCCESS row in the ledger, and rows loaded without a
    ledger.  Only folders of these loads are listed and read.  Without a
    ledger all rows count."""
    schema = bronze_measurement_schema(fingerprint)
    if not tables.exists(spark, table_root):
        return spark.createDataFrame([], schema)
    if not ledger_root:
        return spark.read.schema(schema).parquet(table_root)
    # one id per backfill load that added rows
    done = succeeded(spark, ledger_root).filter((F.col("data_tier") == "historical") & (F.col("rows_loaded") > 0)).select("load_id")
    folders = [f"{table_root.rstrip('/')}/{LOAD_COLUMN}={i}" for i in [UNLEDGERED, *(r[0] for r in done.collect())]]
    folders = [f for f in folders if tables.exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table_root).parquet(*folders)


def read_tier(spark: SparkSession, table_root: str, tier: str, ledger_root: str | None = None) -> DataFrame:
    """Bronze table of a tier in the bronze column layout."""
    if tier in ("now",):
        return tables.read_table(spark, table_root, bronze_measurement_schema()).select(*BRONZE_COLUMNS)
    if tier == "stations":
        return tables.read_table(spark, table_root, bronze_station_schema())
    if tier == "historical":
        return read_historical(spark, table_root, ledger_root)
    return tables.read_table_partitioned(spark, table_root, bronze_measurement_schema())
