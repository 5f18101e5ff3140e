"""Structured Streaming ingestion.

The source system polls on a schedule; here each tier is a file-source
stream over its landing folder (one sub-folder per landing run, so a
re-downloaded file is a new path).  ``trigger(availableNow=True)`` processes
whatever has landed and stops (the scheduled-batch equivalent);
``processingTime="10 minutes"`` keeps it running.  Progress and the set of
processed files live in the checkpoint, so a restarted or replayed job skips
files it already committed.

* T1 live tier: each micro-batch fully replaces the live table.
* T2 recent tier: each micro-batch is upserted; T4 then refreshes the silver
  days the batch touched.
* T5 live view: watermark on the reference time and de-duplication within
  it, for a continuously updated live table without unbounded state; over all
  tiers, the better tier's row replaces a worse one whenever it arrives
  (``start_best_rows``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import tables
from ..operators.dedup import row_fingerprint, union_tiers
from ..operators.rejects import split_rejects, staged
from ..plans.bronze import PARTITION_COLUMN, load_now, run_load, upsert_recent
from ..schema import BRONZE_COLUMNS, FINGERPRINT, KEY_COLUMNS, MEASURE_CODES, MEASUREMENT_CSV_FIELDS, TIER_SPECS, raw_schema
from ..sources.csv import CSV_OPTIONS, relative_file_name, typed_measurements


def stream_tier(spark: SparkSession, landing_root: str, tier: str, loaded_at=None, glob: str | None = None) -> DataFrame:
    """Typed rows (with ``reject_reason``) of files landing for ``tier``;
    ``glob`` overrides its file-name pattern."""
    spec = TIER_SPECS[tier]
    raw = (
        spark.readStream.schema(raw_schema(MEASUREMENT_CSV_FIELDS))
        .options(**CSV_OPTIONS)
        .option("encoding", spec.encoding)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob or spec.glob)
        .csv(landing_root)
    )
    raw = raw.select(
        *[F.col(f"c{i}") for i in range(1, MEASUREMENT_CSV_FIELDS + 1)],
        relative_file_name(landing_root).alias("file_name"),
    )
    return typed_measurements(raw, loaded_at)


def _start(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict) -> StreamingQuery:
    return df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_now_ingest(
    spark: SparkSession, landing_root: str, table_root: str, checkpoint: str,
    trigger: dict | None = None, loaded_at=None, keep_versions: int = 2,
    ledger_root: str | None = None, glob: str | None = None,
) -> StreamingQuery:
    """A micro-batch replaces the live table by all files of the newest
    landing run (see ``bronze.newest_run``), not only by its own, so files of
    one run may arrive in several micro-batches.  A run without good rows
    leaves the table as it is, with a FAILED ledger row; any other failure
    stops the stream, so its files are read again.
    Versions older than the newest ``keep_versions`` are dropped after each
    replace (readers still on the previous version keep it), so a stream
    that replaces every 10 minutes does not accumulate versions."""

    def batch(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        try:
            load_now(spark, landing_root, table_root, loaded_at, ledger_root, glob=glob, raise_=True, batch=f"{checkpoint}#{batch_id}")
        except tables.EmptyBatchError:
            return
        tables.vacuum(spark, table_root, keep=keep_versions)

    return _start(stream_tier(spark, landing_root, "now", loaded_at, glob), batch, checkpoint,
                  trigger or {"availableNow": True})


def start_recent_ingest(
    spark: SparkSession, landing_root: str, table_root: str, checkpoint: str,
    silver_refresh: Callable[[DataFrame], None] | None = None,
    trigger: dict | None = None, loaded_at=None,
    ledger_root: str | None = None, glob: str | None = None,
) -> StreamingQuery:
    """T2 + T4: upsert each micro-batch by key into the day-partitioned recent
    table, then hand the touched days to ``silver_refresh``.  Each writes a
    ledger row and keeps the rows it leaves out, as the batch load does.
    Replaying a batch gives the same table (keyed upsert); with a ledger a
    batch that has a SUCCESS row is not run again, and rows left out count
    once, by the attempt that succeeded."""

    def batch(df: DataFrame, batch_id: int) -> None:
        def body(stats: dict) -> None:
            upsert_recent(df, table_root, stats, ledger_root, silver_refresh)

        run_load(spark, "stream_recent", "recent", ledger_root, body, raise_=True, batch=f"{checkpoint}#{batch_id}")

    return _start(stream_tier(spark, landing_root, "recent", loaded_at, glob), batch, checkpoint,
                  trigger or {"availableNow": True})


def _event_time(ts: Column) -> Column:
    """Reference times are UTC wall-clock; watermarks need a zoned TIMESTAMP."""
    return F.make_timestamp(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts), F.lit("UTC"))


#: A stream that holds whole rows keeps them in RocksDB, on the executors'
#: disks: Spark's default store has every key of the newest versions on the
#: heap.  All stores of an executor share one bounded cache, and a micro-batch
#: writes what it changed, not all that is held.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A stream takes the session's settings as they are when it starts; after
    that the session has its own again."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def best_rows(tiers: dict[str, DataFrame], watermark: str) -> DataFrame:
    """T5 over all tiers: a streaming aggregate (output mode update) that
    holds, per station and time, the row that wins by tier, load time, file
    name and fingerprint - W1's order - among all that have arrived.  When a
    row of a better tier arrives late, the key is emitted again.

    ``tiers``: streams in bronze columns.  State of times older than
    ``watermark`` before the newest time seen is dropped, and so are rows that
    arrive after that; rows without a time are left to the batch refresh."""
    keys = list(KEY_COLUMNS)
    rows = union_tiers(tiers, BRONZE_COLUMNS).withColumn(FINGERPRINT, row_fingerprint(MEASURE_CODES))
    rows = rows.filter(F.col(keys[1]).isNotNull()).withColumn("__event_time", _event_time(F.col(keys[1])))
    age = F.timestamp_diff("MICROSECOND", F.col("loaded_at"), F.lit("2100-01-01 00:00:00").cast("timestamp_ntz"))
    order = F.struct(
        "tier_priority", F.col("loaded_at").isNull().alias("a"), age.alias("b"),
        F.col("file_name").isNull().alias("c"), F.col("file_name").alias("d"), F.col(FINGERPRINT).alias("e"),
    )
    held = [c for c in [*BRONZE_COLUMNS, "data_tier"] if c not in keys]
    best = F.min_by(F.struct(*held), order).alias("best")
    grouped = rows.withWatermark("__event_time", watermark).groupBy("__event_time", *keys).agg(best)
    return grouped.select(*keys, "best.*")


def start_best_rows(tiers: dict[str, DataFrame], table_root: str, checkpoint: str, watermark: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep ``table_root`` (partitioned by day) equal to W1 over all rows that
    the streams have brought: each micro-batch upserts the keys whose winner it
    decided anew.  Replaying a batch gives the same table."""

    def batch(df: DataFrame, batch_id: int) -> None:
        with staged(df.withColumn(PARTITION_COLUMN, F.to_date("reference_timestamp")), "best-rows") as rows:
            if not rows.isEmpty():
                tables.upsert_partitions(rows, table_root, KEY_COLUMNS, PARTITION_COLUMN, prepared=True)

    q = best_rows(tiers, watermark).writeStream.outputMode("update").foreachBatch(batch)
    with _state_on_disk(next(iter(tiers.values())).sparkSession):
        return q.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def dedup_within_watermark(
    df: DataFrame, keys=KEY_COLUMNS, ts_col: str = "reference_timestamp", watermark: str = "1 day"
) -> DataFrame:
    """One row per key among rows whose time lies within ``watermark`` of the
    newest time seen; state older than the watermark is dropped, so the
    state store stays bounded.  (Which duplicate survives is the first to
    arrive; the de-duplication by tier priority is the batch silver job.)"""
    event_time = _event_time(F.col(ts_col))
    return (
        df.withColumn("__event_time", event_time)
        .withWatermark("__event_time", watermark)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("__event_time")
    )


def live_view(spark: SparkSession, landing_root: str, watermark: str = "1 day", loaded_at=None) -> DataFrame:
    """T5: streaming live rows, one per key within the watermark."""
    good, _ = split_rejects(stream_tier(spark, landing_root, "now", loaded_at))
    return dedup_within_watermark(good, watermark=watermark)


def run_available_now(df: DataFrame, out_path: str, checkpoint: str) -> None:
    """Process everything available into a Parquet sink and stop (the file
    sink commits exactly once per batch through its log)."""
    q = (
        df.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
