"""Plan assertions: partial top-1 before the shuffle (E7),
checked broadcast of the dimension (E6), pushdown through the silver
layer (E1/E5), live tier never scanned by the standard fact (E2)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from foehn.plans import analogue as A
from foehn.plans import analytics, gold, silver


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_shuffle(spark):
    p = plan(silver.silver_measurements(A.bronze_tiers(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p
    assert p.index("Partial") > p.index("Exchange")  # partial limit sits below the exchange


def test_dimension_join_is_broadcast_after_check(spark):
    tiers = A.bronze_tiers(spark, SF_SMALL)
    dim = gold.dim_stations(silver.station_view(A.bronze_stations(spark, SF_SMALL)))
    df = analytics.canton_daily(gold.fact_standard(tiers), dim, A.AS_OF)
    assert "BroadcastHashJoin" in plan(df)
    from foehn.operators.joins import join_dimension

    j = join_dimension(spark.range(10).withColumnRenamed("id", "k"), dim.withColumnRenamed("station_key", "k"),
                       on="k", max_broadcast_rows=5)
    p = j._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in p.lower() or "strategy=broadcast" not in p  # over the bound: no hint


def test_standard_fact_skips_live_tier(spark):
    tiers = A.bronze_tiers(spark, SF_SMALL)
    n_std = plan(gold.fact_standard(tiers)).count("FileScan parquet")
    n_rt = plan(gold.fact_realtime(tiers)).count("FileScan parquet")
    assert n_rt == 3 and n_std == 2


def test_silver_refresh_and_pushdown(spark, tmp_path):
    tiers = A.bronze_tiers(spark, SF_SMALL)
    out = str(tmp_path / "silver")
    silver.refresh_silver(spark, tiers, out)
    s = silver.read_silver(spark, out)
    full = s.count()
    assert full == silver.silver_measurements(tiers).count()
    q = silver.read_silver(spark, out, with_partition=True).filter(
        F.col("measurement_date") == dt.date(2024, 1, 5)).filter(
        F.col("station_abbr") == "3")
    p = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement_date" in p
    assert "PushedFilters: [IsNotNull(station_abbr), EqualTo(station_abbr,3)]" in p
    # touched-date refresh rewrites one day and leaves the others
    def per_day():
        s = silver.read_silver(spark, out, with_partition=True)
        return {r["measurement_date"]: r["c"] for r in s.groupBy("measurement_date").agg(F.count("*").alias("c")).collect()}

    before = per_day()
    silver.refresh_silver(spark, tiers, out, touched_dates=[dt.date(2024, 1, 5)])
    assert per_day() == before
    # a full refresh publishes a new version; the touched-day refresh did not
    from foehn.operators import tables

    assert tables.versions(spark, out) == [1]
    silver.refresh_silver(spark, tiers, out)
    assert tables.versions(spark, out) == [1, 2] and per_day() == before


def test_spread_only_under_split_inputs(spark):
    """A single-row-group file is round-robined over the cores with filters
    still pushed to the scan; an input with enough splits is left alone."""
    from foehn.sources.splits import input_splits, spread

    one = A.table(spark, SF_SMALL, "events")
    assert input_splits(one) == 1
    p = plan(spread(one, cores=4, min_bytes=4096).filter(F.col("user_id") == 3))
    assert "RoundRobinPartitioning(4)" in p
    assert "EqualTo(user_id,3)" in p
    many = spark.range(0, 1000, numPartitions=4)
    assert spread(many, cores=4) is many
    # a small file is not cut finer than the minimum input per task
    small = A.table(spark, SF_SMALL, "events")  # about 20 KB
    assert spread(small, cores=1000, min_bytes=8 * 1024).rdd.getNumPartitions() < 10
    assert spread(small, cores=1000, min_bytes=1 << 20) is small


def test_upsert_scans_its_target_once(spark):
    """The source is broadcast only by its measured size; beyond the bound the
    target is sort-merge joined (AQE can split a hot key), again in one scan."""
    from foehn.operators.upsert import _replaced, merge_upsert, prepare_source
    from foehn.operators.rejects import stage

    target, source = A.upsert_pair(spark, SF_SMALL)
    src = stage(prepare_source(source, A.UPSERT_KEYS, A.upsert_order()))
    by_size = {bound: plan(_replaced(target, src, A.UPSERT_KEYS, bound)) for bound in (0, 64 << 20)}
    assert all(p.count("lineitem.parquet") == 1 for p in by_size.values())
    assert "BroadcastHashJoin" not in by_size[0] and by_size[0].count("SortMergeJoin") == 1
    assert "BroadcastHashJoin" in by_size[64 << 20] and "hashpartitioning" not in by_size[64 << 20]
    p = plan(merge_upsert(target, source, A.UPSERT_KEYS, A.upsert_order()))
    assert "lineitem.parquet" not in p and "BroadcastHashJoin" not in p


def test_upsert_is_the_same_on_both_sides_of_the_bound(spark):
    from foehn.operators.upsert import merge_upsert

    target, source = A.upsert_pair(spark, SF_SMALL)
    rows = [sorted(map(str, merge_upsert(target, source, A.UPSERT_KEYS, A.upsert_order(), max_broadcast_bytes=bound).collect())) for bound in (0, 64 << 20)]
    assert rows[0] == rows[1]


def test_dimension_broadcast_is_bounded_in_bytes(spark):
    from foehn.operators.joins import join_dimension
    from foehn.operators.sizes import measured_size

    dim = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 10_000).alias("text"))
    assert measured_size(dim)[0] == 10 and 100_000 < measured_size(dim)[1] < 110_000
    fact = spark.range(100).select((F.col("id") % 10).alias("k"))
    assert "BroadcastHashJoin" in plan(join_dimension(fact, dim, on="k"))
    assert "BroadcastHashJoin" not in plan(join_dimension(fact, dim, on="k", max_broadcast_bytes=50_000))


def test_stage_cuts_lineage_at_the_checkpoint_folder(spark):
    """K6: the staged batch is read back from Parquet under the session's
    checkpoint folder, with the same rows."""
    from foehn.operators.rejects import stage
    from foehn.session import checkpoint_root

    df = spark.range(100).withColumn("x", F.col("id") * 2)
    s = stage(df)
    p = plan(s)
    root = checkpoint_root(spark).split(":", 1)[-1].rstrip("/")
    assert "FileScan parquet" in p and "Range" not in p
    files = s.inputFiles()
    assert files and all(root in f and "/foehn/stage-" in f for f in files)
    assert sorted(r.x for r in s.collect()) == [2 * i for i in range(100)]


def test_staged_copy_is_removed_after_the_block(spark):
    import os

    from foehn.operators.rejects import staged

    with staged(spark.range(10), "t-stage") as s:
        files = s.inputFiles()
        assert s.count() == 10 and files
    folder = files[0].split(":", 1)[-1].rsplit("/", 1)[0]
    assert "/foehn/t-stage-" in folder and not os.path.exists(folder)


def test_input_bytes_only_for_few_files(spark):
    """File sizes are read from file-system metadata only for inputs with few
    files; a large file list is never walked on the driver."""
    import os

    from foehn.sources.splits import input_bytes

    events = A.table(spark, SF_SMALL, "events")
    assert input_bytes(events, max_files=1) == os.path.getsize(f"{SF_SMALL}/events.parquet")
    assert input_bytes(events, max_files=0) is None


def test_winners_are_chosen_on_narrow_columns(spark, tmp_path):
    """A report on loaded bronze tables reads the stored fingerprint and its
    own measures, in the scan and in the window; the others are pruned."""
    import re

    from conftest import write_file
    from foehn.plans import refresh
    from foehn.schema import MEASURE_CODES

    header = "station_abbr;reference_timestamp;" + ";".join(MEASURE_CODES) + "\n"
    land, wh = tmp_path / "land", str(tmp_path / "wh")
    write_file(land / "a_t_historical_2020.csv", header + "A;01.01.2024 00:00;1\nA;01.01.2024 00:00;2\nA;01.01.2024 00:10;3\n")
    write_file(land / "a_t_recent.csv", header + "A;01.01.2024 00:10;5\nA;01.01.2024 00:20;6\n")
    write_file(land / "a_t_now.csv", header + "A;01.01.2024 00:30;7\nA;01.01.2024 00:30;8\n")
    write_file(land / "x_meta_stations.csv", "h\nA;a;B\n", encoding="latin-1")
    refresh.refresh_all(spark, str(land), wh)
    tiers = refresh.bronze_tables(spark, wh)
    dim = gold.dim_stations(silver.station_view(refresh.station_table(spark, wh)))
    report = analytics.canton_daily(gold.fact_standard(tiers), dim, dt.date(2024, 1, 5))
    p = plan(report)
    scans = re.findall(r"Project \[([^\]]*) AS tier_priority", p)
    assert [x.count("#") for x in scans] == [8, 8], scans  # and the tier's constant
    windows = [w for w in re.findall(r"WindowGroupLimit \[([^\]]*)\], \[([^\]]*)\]", p)]
    assert windows and all("row_fingerprint" in order and "tre005s0" not in order for _, order in windows)
    # the same rows win whether the fingerprint is stored or computed
    plain = {t: df.drop("row_fingerprint") for t, df in tiers.items()}
    assert sorted(map(str, silver.silver_measurements(tiers).collect())) == sorted(map(str, silver.silver_measurements(plain).collect()))
