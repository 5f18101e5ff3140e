"""Tables and files that a running job keeps in the shared folder.

The folder is the one the session names in ``spark.checkpoint.dir``. Written
tables cut the lineage, so a lost executor costs only the stage at hand.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from foehn.session import scratch_path


#: Bytes of an Arrow batch between executors and their Python workers; texts
#: are long, so Spark's default would hold several times 64 MB in each task.
#: Executor and worker hold a batch each, and workers keep what they held.
BATCH_BYTES = 4 << 20


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write the rows to a fresh folder and return them read back."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give memory that is no longer in use back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow: a worker serves the tasks of all later stages, and
    its allocators keep what a task has freed, so each task ends by giving it
    back."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return whole


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it, for a path with or without a scheme. Works
    on the driver and in tasks wherever the shared folder is reachable."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class NewFile:
    """A file that appears under its name only when it is complete: written
    beside it first, then moved. A repeated task replaces it by an equal one."""

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"

    def __enter__(self):
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.part, compression=None)
        return self.out

    def __exit__(self, failed, *_):
        self.out.close()
        if failed:
            self.fs.delete_file(self.part)
        else:
            self.fs.move(self.part, self.path)


def partitions_for(pieces: int) -> int:
    """Partitions for that many pieces of work: one each while they are few,
    about 16 to a partition when they are many."""
    return max(1, min(pieces, 200), min(pieces // 16, 100_000))


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns col_0, col_1, ... and the new name of each old one, so
    that no column of the caller meets one that an operator adds."""
    names = {name: f"col_{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names
