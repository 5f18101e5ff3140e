"""The loads on landed CSV files, from files to bronze tables and ledger.

The driver's tables are rendered as ``;``-separated files with a header in the
shared scratch folder and go through the load procedures (or the streams) as
files from the source system would; the tables and the ledger are read back.
All rows of a station stand in one file of a batch, so which of two rows of a
key wins depends on their values alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables
from ..schema import BRONZE_COLUMNS, STATION_COLUMNS
from ..session import scratch_path
from ..sources.inventory import list_files
from ..streaming import ingest
from . import analogue as A
from . import bronze

GLOB = "*.csv"
# Recent tier: two batches that overlap; historical tier: two that do not.
RECENT_BATCHES = [("2024-01-10 00:00:00", "2024-01-22 00:00:00"), ("2024-01-18 00:00:00", "2024-01-28 00:00:00")]
RECENT_LOADED_AT = ["2024-01-22 13:00:00", "2024-01-29 13:00:00"]
HISTORICAL_SPLIT = "2024-01-10 00:00:00"
HISTORICAL_LOADED_AT = "2024-01-20 03:00:00"


def _between(low: str, high: str) -> Column:
    return (F.col("ts") >= A.ntz(low)) & (F.col("ts") < A.ntz(high))


def land(lines: DataFrame, root: str, folder: Column, encoding: str = "UTF-8") -> None:
    """Write ``line`` texts as files with a header below ``root/run=<folder>``."""
    (
        lines.withColumn("run", folder).repartition("file_name").select("run", "line")
        .write.mode("append").partitionBy("run")
        .option("header", "true").option("encoding", encoding)
        .option("sep", "\x01").option("quote", "\u0000").option("escape", "\u0000")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .csv(root)
    )


#: Spark's folder of a partition value that is NULL or empty, and the
#: characters that its folder names escape.
NO_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = {chr(c) for c in range(1, 32)} | set("\x7f\"#%'*/:=?\\{[]^")


def land_folders(lines: DataFrame, root: str, folder: Column) -> None:
    """``land`` for a folder per station: one file in every folder.

    Hadoop's local file system starts four processes for a file it creates
    (modes of file and checksum), which is most of the time where files are
    many and small.  There, tasks write the files themselves: a task has all
    lines of its folders, in folder order, and holds one batch of them.  A file
    gets its name when it is whole, and a task that runs again replaces it.
    In any other store the files go through Spark's writer."""
    fs, path = tables._fs(lines.sparkSession, root)
    if fs.getUri().getScheme() != "file":
        return land(lines, root, folder)
    local, name, escaped, spare = path.toUri().getPath(), f"part-00000-{uuid.uuid4().hex}.csv", ESCAPED, NO_FOLDER

    def write(batches):
        from itertools import groupby

        import pyarrow as pa
        from pyarrow import fs as pafs

        disk, attempt = pafs.LocalFileSystem(), uuid.uuid4().hex
        files, current, place, out = 0, None, None, None

        def close():
            if out is not None:
                out.close()
                disk.move(f"{place}/.{attempt}", f"{place}/{name}")

        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for run, group in groupby(rows, key=lambda r: r[0]):
                if run != current:
                    close()
                    text = "".join(f"%{ord(c):02X}" if c in escaped else c for c in run)
                    current, place = run, f"{local}/run={text}"
                    disk.create_dir(place, recursive=True)
                    out = disk.open_output_stream(f"{place}/.{attempt}")
                    out.write(b"line\n")
                    files += 1
                out.write("".join(f"{line or ''}\n" for _, line in group).encode())
        close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    run = F.coalesce(F.nullif(folder, F.lit("")), F.lit(spare))
    rows = lines.select(run.alias("run"), "line").repartition("run").sortWithinPartitions("run")
    rows.mapInArrow(write, "files long").agg(F.sum("files")).first()


class Landed:
    """A fresh landing folder, table folders and a ledger in the shared
    scratch folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = scratch_path(spark, "landed")
        self.ledger = f"{self.root}/ledger"

    def land_of(self, tier: str) -> str:
        return f"{self.root}/landing/{tier}"

    def table_of(self, tier: str) -> str:
        return f"{self.root}/bronze/{tier}"

    def _done(self, load: DataFrame, tier: str) -> None:
        row = load.first()
        if row["status"] != "SUCCESS":
            raise RuntimeError(f"{tier}: {row['errors']}")

    def recent(self, stream: bool = False) -> "Landed":
        """Two overlapping batches, loaded one after the other."""
        land_, table = self.land_of("recent"), self.table_of("recent")
        for n, (window, at) in enumerate(zip(RECENT_BATCHES, RECENT_LOADED_AT, strict=True)):
            land(A.raw_csv_lines(self.spark, self.sf_dir, where=_between(*window)), land_, F.lit(n))
            if stream:
                q = ingest.start_recent_ingest(self.spark, land_, table, f"{self.root}/stream-recent", loaded_at=at, ledger_root=self.ledger, glob=GLOB)
                q.awaitTermination()
            else:
                self._done(bronze.load_recent(self.spark, f"{land_}/run={n}", table, at, self.ledger, glob=GLOB), "recent")
        return self

    def now(self, stream: bool = False) -> "Landed":
        """An older and a newer landing run; the newer one replaces."""
        land_, table = self.land_of("now"), self.table_of("now")
        land(A.raw_csv_lines(self.spark, self.sf_dir, "recent"), land_, F.lit(9))
        land(A.raw_csv_lines(self.spark, self.sf_dir, "now"), land_, F.lit(10))
        if stream:
            q = ingest.start_now_ingest(self.spark, land_, table, f"{self.root}/stream-now", loaded_at=A.CSV_LOADED_AT, ledger_root=self.ledger, glob=GLOB)
            q.awaitTermination()
        else:
            self._done(bronze.load_now(self.spark, land_, table, A.CSV_LOADED_AT, self.ledger, glob=GLOB), "now")
        return self

    def historical(self) -> "Landed":
        """Backfill: files of a later load are added to those already loaded,
        and a last load finds none left.  Lines that a strict load rejects are
        not landed."""
        land_, good = self.land_of("historical"), (F.col("event_id") % 101 != 0) & (F.col("event_id") % 89 != 0)
        lines = [F.col("ts") < A.ntz(HISTORICAL_SPLIT), F.col("ts") >= A.ntz(HISTORICAL_SPLIT), None]
        for n, part in enumerate(lines):
            if part is not None:
                land(A.raw_csv_lines(self.spark, self.sf_dir, "historical", where=good & part), land_, F.lit(n))
            self._done(bronze.load_historical(self.spark, land_, self.table_of("historical"), HISTORICAL_LOADED_AT, self.ledger, glob=GLOB), "historical")
        return self

    def stations(self) -> "Landed":
        """Latin-1 files, with a letter that is not ASCII in the names."""
        land_ = self.land_of("stations")
        lines = A.station_csv_lines(self.spark, self.sf_dir).withColumn("line", F.replace("line", F.lit("Customer"), F.lit("Kündin")))
        land(lines, land_, F.lit(0), "ISO-8859-1")
        self._done(bronze.load_stations(self.spark, land_, self.table_of("stations"), A.STATIONS_LOADED_AT, self.ledger, glob=GLOB), "stations")
        return self

    def listing(self) -> DataFrame:
        """The files of two landed batches, a folder per station, as a
        user lists them before a load: in path order, without reading them."""
        land_ = self.land_of("listing")
        for n, window in enumerate(RECENT_BATCHES):
            lines = A.raw_csv_lines(self.spark, self.sf_dir, where=_between(*window))
            land_folders(lines, f"{land_}/batch-{n}", F.element_at(F.split("file_name", "/"), 1))
        folder = F.regexp_extract("file_path", "(batch-[0-9]+/run=[^/]+)/[^/]+$", 1)
        return list_files(self.spark, land_, GLOB).select(folder.alias("folder"), (F.col("size") > 0).alias("has_lines"))

    def read(self, tier: str) -> DataFrame:
        """The tier's table without file names (Spark chose them).  The landed
        files are removed: the table holds what was loaded."""
        tables.remove_path(self.spark, f"{self.root}/landing")
        columns = [*STATION_COLUMNS, "loaded_at"] if tier == "stations" else [c for c in BRONZE_COLUMNS if c != "file_name"]
        return bronze.read_tier(self.spark, self.table_of(tier), tier, self.ledger).select(*columns)

    def ledger_counts(self) -> DataFrame:
        tables.remove_path(self.spark, f"{self.root}/landing")
        return bronze.read_ledger(self.spark, self.ledger).select(
            "procedure", "data_tier", "status", "rows_parsed", "rows_rejected", "rows_null_key", "rows_duplicate_key", "rows_inserted", "rows_updated", "rows_loaded"
        )

    def reject_summary(self) -> DataFrame:
        tables.remove_path(self.spark, f"{self.root}/landing")
        rejects = bronze.read_rejects(self.spark, self.ledger)
        return rejects.groupBy("data_tier", "reason", "loaded_at").agg(F.count("*").alias("n_rows"))
