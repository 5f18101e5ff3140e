"""Streaming ingestion with availableNow triggers (T1, T2, T4, T5) and replay."""

from pyspark.sql import functions as F

from conftest import write_file
from foehn.operators import tables
from foehn.schema import MEASURE_CODES
from foehn.streaming import ingest

HEADER = "station_abbr;reference_timestamp;" + ";".join(MEASURE_CODES) + "\n"


def test_now_stream_replaces_per_run(spark, tmp_path):
    land, table, ck = tmp_path / "land", str(tmp_path / "now"), str(tmp_path / "ck")
    write_file(land / "run=1" / "bas" / "ogd-smn_bas_t_now.csv", HEADER + "BAS;01.01.2024 00:00;1\nBAS;01.01.2024 00:10;2\n")
    q = ingest.start_now_ingest(spark, str(land), table, ck)
    q.awaitTermination()
    assert tables.read_table(spark, table).count() == 2
    write_file(land / "run=2" / "bas" / "ogd-smn_bas_t_now.csv", HEADER + "BAS;01.01.2024 00:20;3\n")
    q = ingest.start_now_ingest(spark, str(land), table, ck)
    q.awaitTermination()
    rows = tables.read_table(spark, table).collect()
    assert [float(r["tre200s0"]) for r in rows] == [3.0]  # replaced by the new run only
    # replay with nothing new: table unchanged
    q = ingest.start_now_ingest(spark, str(land), table, ck)
    q.awaitTermination()
    assert tables.read_table(spark, table).count() == 1


def test_recent_stream_upserts_and_refreshes(spark, tmp_path):
    land, table, ck = tmp_path / "land", str(tmp_path / "recent"), str(tmp_path / "ck")
    touched = []
    write_file(land / "run=1" / "bas" / "ogd-smn_bas_t_recent.csv",
               HEADER + "BAS;01.01.2024 00:00;1\nBAS;02.01.2024 00:00;2\n")
    ingest.start_recent_ingest(spark, str(land), table, ck,
                               silver_refresh=lambda d: touched.append(sorted(r[0].day for r in d.collect()))
                               ).awaitTermination()
    write_file(land / "run=2" / "bas" / "ogd-smn_bas_t_recent.csv", HEADER + "BAS;02.01.2024 00:00;5\n")
    ingest.start_recent_ingest(spark, str(land), table, ck,
                               silver_refresh=lambda d: touched.append(sorted(r[0].day for r in d.collect()))
                               ).awaitTermination()
    vals = {r["reference_timestamp"].day: float(r["tre200s0"]) for r in spark.read.parquet(table).collect()}
    assert vals == {1: 1.0, 2: 5.0}
    assert touched == [[1, 2], [2]]


def test_live_view_dedups_within_watermark(spark, tmp_path):
    land = tmp_path / "land"
    write_file(land / "run=1" / "a" / "ogd-smn_a_t_now.csv",
               HEADER + "A;01.01.2024 00:00;1\nA;01.01.2024 00:00;1\nA;01.01.2024 00:10;2\n")
    q = (ingest.live_view(spark, str(land)).writeStream.format("memory").queryName("live_t5")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.sql("SELECT station_abbr, reference_timestamp FROM live_t5")
    assert out.count() == 2
    assert out.select(F.countDistinct("reference_timestamp")).collect()[0][0] == 2


def test_now_stream_keeps_only_recent_versions(spark, tmp_path):
    land, table, ck = tmp_path / "land", str(tmp_path / "now"), str(tmp_path / "ck")
    for run in range(1, 4):
        write_file(land / f"run={run}" / "bas" / "ogd-smn_bas_t_now.csv", HEADER + f"BAS;01.01.2024 00:{run}0;{run}\n")
        ingest.start_now_ingest(spark, str(land), table, ck, keep_versions=2).awaitTermination()
    assert tables.versions(spark, table) == [2, 3]
    assert [float(r["tre200s0"]) for r in tables.read_table(spark, table).collect()] == [3.0]


def test_best_rows_state_is_not_on_the_heap(spark, tmp_path):
    schema = "station_abbr string, reference_timestamp timestamp_ntz, " + ", ".join(f"{c} decimal(38,10)" for c in MEASURE_CODES)
    schema += ", file_name string, loaded_at timestamp_ntz"
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    land, out, ck = f"{tmp_path}/land", f"{tmp_path}/out", f"{tmp_path}/ck"
    got = []
    for tier, value in (("now", 3.0), ("historical", 1.0), ("recent", 2.0)):
        row = spark.sql("SELECT 'A' AS station_abbr, TIMESTAMP_NTZ'2024-01-01 00:10:00' AS reference_timestamp")
        for c in MEASURE_CODES:
            row = row.withColumn(c, F.lit(value).cast("decimal(38,10)"))
        row = row.withColumn("file_name", F.lit("f")).withColumn("loaded_at", F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00")))
        for t in ("now", "recent", "historical"):
            (row if t == tier else row.limit(0)).write.mode("append").parquet(f"{land}/{t}")
        streams = {t: spark.readStream.schema(schema).parquet(f"{land}/{t}") for t in ("now", "recent", "historical")}
        q = ingest.start_best_rows(streams, out, ck, "400 days")
        q.awaitTermination()
        held = [s for p in q.recentProgress for s in p["stateOperators"]]
        assert held and all(any(m.startswith("rocksdb") for m in s["customMetrics"]) for s in held)
        got.append([(r["data_tier"], float(r[MEASURE_CODES[0]])) for r in spark.read.parquet(out).collect()])
    # the state goes over restarts: a better tier replaces, a worse one does not
    assert got == [[("now", 3.0)], [("historical", 1.0)], [("historical", 1.0)]]
    assert spark.conf.get(provider, None) == before
