"""

Every registered query reads the driver's parquet tables through the
analogue mapping in ``foehn.plans.analogue`` (the test data holds no weather
tables) and runs the library's operators over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foehn.operators.dedup import keep_first
from foehn.operators.rejects import REASON, split_rejects, stage
from foehn.operators.upsert import merge_counts, merge_upsert
from foehn.plans import analogue as A
from foehn.plans import analytics, bronze, gold, quality, silver
from foehn.plans.landed import Landed
from foehn.sources import catalogue, csv, inventory
from foehn.schema import KEY_COLUMNS, MEASUREMENT_CSV_FIELDS, STATION_CSV_FIELDS

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed query parameters of the registered analogue queries.
SERIES_STATIONS = ["1", "2", "3"]
CANTON = "NATION_3"


def portable(df: DataFrame) -> DataFrame:
    """Report boundary: DECIMAL columns as DOUBLE (exact for the values
    involved), everything else unchanged."""
    cols = [
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


# --- shared inputs -------------------------------------------------------------

def _tiers(spark, d):
    return A.bronze_tiers(spark, d)


def _fact(spark, d):
    return gold.fact_standard(_tiers(spark, d))


def _fact_rt(spark, d):
    return gold.fact_realtime(_tiers(spark, d))


def _stations(spark, d):
    return silver.station_view(A.bronze_stations(spark, d))


def _dim(spark, d):
    return gold.dim_stations(_stations(spark, d))


def _silver(spark, d):
    return silver.silver_measurements(_tiers(spark, d))


def _typed_lines(spark, d, tier=None):
    lines = A.raw_csv_lines(spark, d, tier)
    raw = csv.parse_lines(lines, "line", MEASUREMENT_CSV_FIELDS, keep=["file_name"])
    return stage(csv.typed_measurements(raw, loaded_at=A.CSV_LOADED_AT))


# Silver as the reports read it, by session and input: the source system's
# reports read the materialised table too. The first report refreshes it.
_MATERIALISED: dict[tuple[str, str, str], str] = {}


def _kept(spark, d, name, build):
    """Path of a table that one session builds once per input."""
    from foehn.operators import tables
    from foehn.session import scratch_path

    key = (name, spark.sparkContext.applicationId, d)
    if key not in _MATERIALISED or not tables.versions(spark, _MATERIALISED[key]):
        path = scratch_path(spark, name)
        build(path)
        _MATERIALISED[key] = path
    return _MATERIALISED[key]


def _silver_table(spark, d):
    path = _kept(spark, d, "silver-of-reports", lambda p: silver.refresh_silver(spark, _tiers(spark, d), p))
    return silver.read_silver(spark, path, with_partition=True)


def _fact_table(spark, d):
    return gold.fact_standard_from_silver(_silver_table(spark, d))


def _fact_rt_table(spark, d):
    return gold.fact_from_silver(_silver_table(spark, d))


def _partials(spark, d):
    """Daily partials brought up to date after a refresh of touched days: the
    recent tier first holds other values and one day more, then what it has."""
    from foehn.plans import rollups
    from foehn.session import scratch_path

    def build(path):
        tiers = _tiers(spark, d)
        time = F.col("reference_timestamp")
        wrong = tiers["recent"].withColumn("tre200s0", F.lit(99).cast("decimal(38,10)"))
        later = tiers["recent"].withColumn("reference_timestamp", time + F.make_dt_interval(F.lit(400)))
        held = scratch_path(spark, "silver-of-partials")
        before = {**tiers, "recent": wrong.unionByName(later)}
        silver.refresh_silver(spark, before, held)
        read = lambda: gold.fact_standard_from_silver(silver.read_silver(spark, held, with_partition=True))
        rollups.refresh_partials(spark, read(), path)
        touched = before["recent"].select(F.to_date("reference_timestamp").alias(silver.PARTITION_COLUMN)).distinct()
        touched = stage(touched, "touched-days")
        silver.refresh_silver(spark, tiers, held, touched)
        rollups.refresh_partials(spark, read(), path, touched)

    return rollups.read_partials(spark, _kept(spark, d, "partials", build))


# --- queries ---------------------------------------------------------------------

def q_canton_daily(spark, d):
    return portable(analytics.canton_daily(_fact_table(spark, d), _dim(spark, d), A.AS_OF, days=30))


def q_tier_union(spark, d):
    return portable(silver.all_measurements(_tiers(spark, d)))


def q_tier_dedup(spark, d):
    return portable(_silver(spark, d))


def q_fact_standard(spark, d):
    return portable(_fact(spark, d))


def q_fact_realtime(spark, d):
    return portable(_fact_rt(spark, d))


def q_dim_station(spark, d):
    return portable(_dim(spark, d))


def q_station_coverage(spark, d):
    return quality.station_coverage(silver.all_measurements(_tiers(spark, d)), by=["data_tier"])


def q_fill_rates(spark, d):
    return quality.fill_rates(silver.all_measurements(_tiers(spark, d)), by=["data_tier"])


def q_duplicate_keys(spark, d):
    """A4 inside each tier: keys that one tier holds more than once."""
    return quality.duplicate_keys(silver.all_measurements(_tiers(spark, d)), ["data_tier", *KEY_COLUMNS])


def q_silver_duplicates(spark, d):
    return quality.duplicate_keys(_silver_table(spark, d))


def q_tier_overlap(spark, d):
    return quality.tier_overlap(silver.all_measurements(_tiers(spark, d)))


def q_station_completeness(spark, d):
    return quality.station_completeness(_silver_table(spark, d))


def q_tier_counts(spark, d):
    return quality.tier_counts(_silver_table(spark, d))


def q_fact_tier_counts(spark, d):
    return quality.tier_counts(_fact_table(spark, d), tier="source_tier", ts="measurement_timestamp")


def q_row_count(spark, d):
    return quality.row_count(_silver_table(spark, d))


def q_stations_per_canton(spark, d):
    return quality.stations_per_canton(_stations(spark, d))


def q_freshness(spark, d):
    return quality.freshness(_stations(spark, d))


def q_station_inventory(spark, d):
    return analytics.station_inventory(_dim(spark, d))


def q_quality_flags(spark, d):
    return analytics.quality_flags(_dim(spark, d))


def q_high_elevation(spark, d):
    return portable(analytics.high_elevation(_dim(spark, d)))


def q_missing_coordinates(spark, d):
    return analytics.missing_coordinates(_dim(spark, d))


def q_newest_stations(spark, d):
    return analytics.newest_stations(_dim(spark, d))


def q_station_lookup(spark, d):
    return portable(analytics.station_lookup(_dim(spark, d), SERIES_STATIONS[0]))


def q_recent_measurements(spark, d):
    return portable(analytics.recent_measurements(_fact_table(spark, d), A.AS_OF, days=7))


def q_daily_station(spark, d):
    return portable(analytics.daily_station(_fact_table(spark, d), A.AS_OF, days=30))


def q_hourly_station(spark, d):
    return portable(analytics.hourly_station(_fact_table(spark, d), _dim(spark, d), A.AS_OF, days=7))


def q_hourly_yesterday(spark, d):
    return portable(analytics.hourly_station(_fact_rt_table(spark, d), _dim(spark, d), A.AS_OF, exact_day=True))


def q_canton_daily_realtime(spark, d):
    return portable(analytics.canton_daily(_fact_rt_table(spark, d), _dim(spark, d), A.AS_OF, days=7))


def q_monthly_station(spark, d):
    return portable(analytics.monthly_station(_fact_table(spark, d), _dim(spark, d), A.AS_OF.year))


def q_extremes_30d(spark, d):
    return portable(analytics.extremes(_fact_table(spark, d), _dim(spark, d), A.AS_OF, days=30))


def q_yearly_compare(spark, d):
    return portable(analytics.yearly_compare(_fact_table(spark, d), _dim(spark, d), A.AS_OF, years=5))


def q_measurements_per_day(spark, d):
    return quality.measurements_per_day(_fact_table(spark, d), A.AS_OF, days=7)


def q_completeness_per_day(spark, d):
    return quality.completeness_per_day(_fact_table(spark, d), A.AS_OF, days=7)


def q_series_in_list(spark, d):
    return portable(analytics.series_in_list(_fact_table(spark, d), _dim(spark, d), A.AS_OF, SERIES_STATIONS, days=30))


def q_canton_series(spark, d):
    return portable(analytics.canton_series(_fact_rt_table(spark, d), _dim(spark, d), A.AS_OF, CANTON, days=7))


def q_monthly_station_realtime(spark, d):
    return portable(analytics.monthly_station(_fact_rt_table(spark, d), _dim(spark, d), A.AS_OF.year))


def q_extremes_30d_realtime(spark, d):
    return portable(analytics.extremes(_fact_rt_table(spark, d), _dim(spark, d), A.AS_OF, days=30))


def q_series_24h_realtime(spark, d):
    return portable(analytics.station_series_hours(_fact_rt_table(spark, d), _dim(spark, d), A.AS_OF_TS, SERIES_STATIONS, 24))


def q_last_hour(spark, d):
    return portable(analytics.last_hours(_fact_rt_table(spark, d), A.AS_OF_TS, hours=1))


def q_orphan_measurements(spark, d):
    return quality.orphan_measurements(_fact_rt_table(spark, d), _dim(spark, d))


def q_csv_typed_parse(spark, d):
    good, _ = split_rejects(_typed_lines(spark, d))
    return portable(good)


def q_csv_rejects(spark, d):
    _, bad = split_rejects(_typed_lines(spark, d))
    return bad.select("file_name", "station_abbr", REASON)


def q_replace_now(spark, d):
    """The live tier after a full replace from the staged batch: good rows
    of the batch, nothing of the previous content."""
    good, _ = split_rejects(_typed_lines(spark, d, "now"))
    return portable(good)


def _typed_station_lines(spark, d):
    raw = csv.parse_lines(A.station_csv_lines(spark, d), "line", STATION_CSV_FIELDS, keep=["file_name"])
    return stage(csv.typed_stations(raw, loaded_at=A.STATIONS_LOADED_AT))


def q_station_csv_parse(spark, d):
    good, _ = split_rejects(_typed_station_lines(spark, d))
    return portable(good)


def q_station_csv_rejects(spark, d):
    _, bad = split_rejects(_typed_station_lines(spark, d))
    return bad.select("station_abbr", REASON)


def q_silver_station_series(spark, d):
    return portable(analytics.silver_station_series(_silver_table(spark, d), _stations(spark, d), A.AS_OF, CANTON, days=7))


def q_sample_rows(spark, d):
    """An unordered sample of 100 bronze rows (which rows is undefined)."""
    return portable(quality.sample(silver.all_measurements(_tiers(spark, d)), 100))


def q_stream_live_keys(spark, d):
    """T5 on a stream: the live tier read as a file stream from the events
    table, de-duplicated within a watermark of the month that the table
    spans (so rows may come in any order), written by an availableNow trigger
    to a Parquet sink in the checkpoint folder."""
    from foehn.session import scratch_path
    from foehn.streaming.ingest import dedup_within_watermark, run_available_now

    schema = A.table(spark, d, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    live = dedup_within_watermark(A.bronze_tier(events, "now"), watermark="31 days")
    out, ck = scratch_path(spark, "live-out"), scratch_path(spark, "live-ck")
    run_available_now(live, out, ck)
    return spark.read.parquet(out).select("station_abbr", "reference_timestamp")


def q_canton_daily_sql(spark, d):
    """A14 through the SQL API over the layer views (same plan as the
    DataFrame version: the views expand into dedup + scans)."""
    from foehn.plans.views import register_views

    register_views(spark, _tiers(spark, d), A.bronze_stations(spark, d), prefix="q_")
    return spark.sql(f"""
        SELECT d.station_canton, f.measurement_date,
               COUNT(DISTINCT f.station_key) AS active_stations,
               CAST(ROUND(AVG(f.temperature_2m), 6) AS DOUBLE) AS avg_temperature,
               CAST(SUM(f.precipitation_total_mm) AS DOUBLE) AS total_precipitation,
               CAST(MAX(f.wind_gust_peak_ms) AS DOUBLE) AS max_wind_gust
        FROM q_gold_fact f JOIN q_gold_dim_stations d ON f.station_key = d.station_key
        WHERE f.measurement_date >= DATE '{A.AS_OF.isoformat()}' - INTERVAL 30 DAYS
        GROUP BY d.station_canton, f.measurement_date
        ORDER BY d.station_canton, f.measurement_date""")


def q_canton_daily_materialized(spark, d):
    """A14 over materialised silver: the refresh job writes silver
    partitioned by day (K8/K9) into the checkpoint folder, and the report
    reads it back, so the day filter prunes partitions instead of
    recomputing the de-duplication."""
    from foehn.session import scratch_path

    path = scratch_path(spark, "silver")
    silver.refresh_silver(spark, _tiers(spark, d), path)
    fact = gold.fact_standard_from_silver(silver.read_silver(spark, path, with_partition=True))
    return portable(analytics.canton_daily(fact, _dim(spark, d), A.AS_OF, days=30))


def _bucketed(spark, d):
    """Fact and dimension as tables bucketed for their join."""
    from foehn.operators import buckets
    from foehn.session import scratch_path

    path = scratch_path(spark, "bucketed")
    name = path.rsplit("-", 1)[1]
    fact, dim = _fact_table(spark, d), _dim(spark, d)
    n = max(8, buckets.bucket_count_of_rows(max(fact.count(), dim.count() * buckets.SLICES)))
    fact = buckets.write_fact(
        fact, f"fact_{name}", f"{path}/fact", "station_key", "measurement_timestamp", n, sort_by=["measurement_timestamp"], partition_by=["measurement_date"]
    )
    return fact, buckets.write_dimension(dim, f"dim_{name}", f"{path}/dim", "station_key", n)


def q_canton_daily_bucketed(spark, d):
    """A14 with a dimension that is not broadcast: fact and dimension lie in
    the same buckets, and the join moves neither."""
    return portable(analytics.canton_daily(*_bucketed(spark, d), A.AS_OF, days=30))


def q_hourly_station_bucketed(spark, d):
    """A13 over bucketed tables."""
    return portable(analytics.hourly_station(*_bucketed(spark, d), A.AS_OF))


def q_silver_touched_refresh(spark, d):
    """K8/T4: silver written from a live tier that also holds later days and
    rows without a time, then, with the live tier as it is, only the touched
    days refreshed; equals a full recompute, vanished days included."""
    from foehn.session import scratch_path

    tiers = _tiers(spark, d)
    now, time = tiers["now"], F.col("reference_timestamp")
    later = now.withColumn("reference_timestamp", time + F.make_dt_interval(F.lit(400)))
    timeless = now.withColumn("reference_timestamp", F.lit(None).cast("timestamp_ntz"))
    before = now.unionByName(later).unionByName(timeless)
    path = scratch_path(spark, "silver-touched")
    silver.refresh_silver(spark, {**tiers, "now": before}, path)
    touched = before.select(F.to_date("reference_timestamp").alias(silver.PARTITION_COLUMN)).distinct()
    silver.refresh_silver(spark, tiers, path, touched)
    return portable(silver.read_silver(spark, path))


def q_upsert_recent(spark, d):
    target, source = A.upsert_pair(spark, d)
    return merge_upsert(target, source, A.UPSERT_KEYS, A.upsert_order(), with_action=False)


def q_upsert_stats(spark, d):
    target, source = A.upsert_pair(spark, d)
    return merge_counts(merge_upsert(target, source, A.UPSERT_KEYS, A.upsert_order()))


def q_source_dedup(spark, d):
    _, source = A.upsert_pair(spark, d)
    return keep_first(source, A.UPSERT_KEYS, A.upsert_order())


def q_new_files(spark, d):
    files = A.tier_files(_tiers(spark, d))
    loaded = files.filter(F.col("data_tier") == "historical")
    return inventory.not_yet_loaded(files.select("file_name").distinct(), loaded)


def q_load_history(spark, d):
    """Each tier's loads of the last hour."""
    ledger = A.tier_files(_tiers(spark, d)).withColumnRenamed("loaded_at", "start_time")
    recent = [bronze.load_history(ledger, tier, A.AS_OF_TS, hours=1) for tier in A.TIER_WINDOWS]
    return reduce(DataFrame.unionByName, recent).withColumnRenamed("start_time", "loaded_at")


def q_landing_listing(spark, d):
    """Landed files in path order, one folder per station and batch."""
    return Landed(spark, d).listing()


def q_load_recent_files(spark, d):
    """R2 on landed files: two overlapping batches upserted, table read back."""
    return portable(Landed(spark, d).recent().read("recent"))


def q_stream_recent_files(spark, d):
    """The same two batches through the stream."""
    return portable(Landed(spark, d).recent(stream=True).read("recent"))


def q_load_now_files(spark, d):
    """The newest landing run replaces the live table."""
    return portable(Landed(spark, d).now().read("now"))


def q_stream_now_files(spark, d):
    """The live table replaced by the stream."""
    return portable(Landed(spark, d).now(stream=True).read("now"))


def q_load_historical_files(spark, d):
    """A backfill in three loads; every file is loaded once."""
    return portable(Landed(spark, d).historical().read("historical"))


def q_load_stations_files(spark, d):
    """Latin-1 station files."""
    return portable(Landed(spark, d).stations().read("stations"))


def q_load_ledger(spark, d):
    """K7: the ledger rows of all loads, the backfill's three among them."""
    return Landed(spark, d).stations().historical().recent().now().ledger_counts()


def q_load_reject_summary(spark, d):
    """K2: rows that the loads left out, by reason."""
    return Landed(spark, d).stations().recent().now(stream=True).reject_summary()


def q_rollup_daily_station(spark, d):
    from foehn.plans import rollups

    return portable(rollups.daily_station(_partials(spark, d), A.AS_OF))


def q_rollup_canton_daily(spark, d):
    from foehn.plans import rollups

    return portable(rollups.canton_daily(_partials(spark, d), _dim(spark, d), A.AS_OF))


def q_rollup_monthly_station(spark, d):
    from foehn.plans import rollups

    return portable(rollups.monthly_station(_partials(spark, d), _dim(spark, d), A.AS_OF.year))


def q_rollup_extremes_30d(spark, d):
    from foehn.plans import rollups

    return portable(rollups.extremes(_partials(spark, d), _dim(spark, d), A.AS_OF))


def q_rollup_yearly_compare(spark, d):
    from foehn.plans import rollups

    return portable(rollups.yearly_compare(_partials(spark, d), _dim(spark, d), A.AS_OF))


def q_active_stations_monthly(spark, d):
    """Distinct stations of months and of all cantons, from daily bitmaps."""
    from foehn.plans import rollups

    return rollups.active_stations_monthly(rollups.station_bitmaps(_fact_table(spark, d), _dim(spark, d)))


def q_stream_tier_dedup(spark, d):
    """T5 across tiers: the live tier arrives first, then the better ones,
    late; the table equals W1 over all rows."""
    from foehn.session import scratch_path
    from foehn.streaming import ingest

    tiers = _tiers(spark, d)
    land, out, ck = (scratch_path(spark, f"best-{x}") for x in ("land", "out", "ck"))
    schema = tiers["now"].schema
    for arrives in ("now", "recent", "historical"):
        for tier, rows in tiers.items():  # the others' folders exist, but are empty
            rows = rows if tier == arrives else rows.limit(0)
            rows.write.mode("append").parquet(f"{land}/{tier}")
        streams = {t: spark.readStream.schema(schema).parquet(f"{land}/{t}") for t in tiers}
        ingest.start_best_rows(streams, out, ck, watermark="400 days").awaitTermination()
    return portable(spark.read.parquet(out).select(*silver.SILVER_COLUMNS))


def q_page_chain(spark, d):
    return catalogue.page_chain(A.paged_catalogues(spark, d), ["catalogue"])


def q_asset_manifest(spark, d):
    return catalogue.flatten_pages(A.catalogue_pages(_tiers(spark, d)))


def q_asset_pick(spark, d):
    return catalogue.pick_assets(catalogue.flatten_pages(A.catalogue_pages(_tiers(spark, d))))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "canton_daily": q_canton_daily,
    "tier_union": q_tier_union,
    "tier_dedup": q_tier_dedup,
    "fact_standard": q_fact_standard,
    "fact_realtime": q_fact_realtime,
    "dim_station": q_dim_station,
    "station_coverage": q_station_coverage,
    "fill_rates": q_fill_rates,
    "duplicate_keys": q_duplicate_keys,
    "silver_duplicates": q_silver_duplicates,
    "tier_overlap": q_tier_overlap,
    "station_completeness": q_station_completeness,
    "tier_counts": q_tier_counts,
    "fact_tier_counts": q_fact_tier_counts,
    "row_count": q_row_count,
    "stations_per_canton": q_stations_per_canton,
    "freshness": q_freshness,
    "station_inventory": q_station_inventory,
    "quality_flags": q_quality_flags,
    "high_elevation": q_high_elevation,
    "missing_coordinates": q_missing_coordinates,
    "newest_stations": q_newest_stations,
    "station_lookup": q_station_lookup,
    "recent_measurements": q_recent_measurements,
    "daily_station": q_daily_station,
    "hourly_station": q_hourly_station,
    "hourly_yesterday": q_hourly_yesterday,
    "canton_daily_realtime": q_canton_daily_realtime,
    "monthly_station": q_monthly_station,
    "extremes_30d": q_extremes_30d,
    "yearly_compare": q_yearly_compare,
    "measurements_per_day": q_measurements_per_day,
    "completeness_per_day": q_completeness_per_day,
    "series_in_list": q_series_in_list,
    "canton_series": q_canton_series,
    "last_hour": q_last_hour,
    "monthly_station_realtime": q_monthly_station_realtime,
    "extremes_30d_realtime": q_extremes_30d_realtime,
    "series_24h_realtime": q_series_24h_realtime,
    "orphan_measurements": q_orphan_measurements,
    "csv_typed_parse": q_csv_typed_parse,
    "csv_rejects": q_csv_rejects,
    "replace_now": q_replace_now,
    "station_csv_parse": q_station_csv_parse,
    "station_csv_rejects": q_station_csv_rejects,
    "silver_station_series": q_silver_station_series,
    "sample_rows": q_sample_rows,
    "stream_live_keys": q_stream_live_keys,
    "canton_daily_sql": q_canton_daily_sql,
    "canton_daily_materialized": q_canton_daily_materialized,
    "canton_daily_bucketed": q_canton_daily_bucketed,
    "hourly_station_bucketed": q_hourly_station_bucketed,
    "silver_touched_refresh": q_silver_touched_refresh,
    "upsert_recent": q_upsert_recent,
    "upsert_stats": q_upsert_stats,
    "source_dedup": q_source_dedup,
    "new_files": q_new_files,
    "load_history": q_load_history,
    "landing_listing": q_landing_listing,
    "load_recent_files": q_load_recent_files,
    "stream_recent_files": q_stream_recent_files,
    "load_now_files": q_load_now_files,
    "stream_now_files": q_stream_now_files,
    "load_historical_files": q_load_historical_files,
    "load_stations_files": q_load_stations_files,
    "load_ledger": q_load_ledger,
    "load_reject_summary": q_load_reject_summary,
    "rollup_daily_station": q_rollup_daily_station,
    "rollup_canton_daily": q_rollup_canton_daily,
    "rollup_monthly_station": q_rollup_monthly_station,
    "rollup_extremes_30d": q_rollup_extremes_30d,
    "rollup_yearly_compare": q_rollup_yearly_compare,
    "active_stations_monthly": q_active_stations_monthly,
    "stream_tier_dedup": q_stream_tier_dedup,
    "page_chain": q_page_chain,
    "asset_manifest": q_asset_manifest,
    "asset_pick": q_asset_pick,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: union three tiers, de-duplicate by tier priority, project
    the fact, join the station dimension and aggregate by canton and day."""
    return q_canton_daily(spark, SMOKE_DIR)


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the optional subpackage and pipeline, if present."""
    try:
        import corpus_pipeline
        from foehn.llm import queries as llm
    except ImportError:
        return {}, {}
    sql = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_llm()[0]}


def oracle_sql() -> dict[str, str]:
    from oracle.duckdb_sql import ORACLE

    return {**{k: v for k, v in ORACLE.items() if k in _QUERIES}, **_llm()[1]}
