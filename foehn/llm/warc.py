"""WARC archives as a chunked record table (operator 4).

Writing: records become rows (record, chunk number, bytes) of at most
``CHUNK`` bytes each, and only such rows are shuffled and sorted; a task
streams them into one gzip member per record, with the SHA-1 carried from chunk
to chunk and compared with the header's, and never holds a whole record. Reading: a task streams an archive and yields
the same kind of rows, each with the SHA-1 of the payload up to its end.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foehn.llm.store import NewFile, filesystem, stored
from foehn.session import scratch_path

CHUNK = 256 * 1024
DATE = "2024-01-01T00:00:00Z"
RECORD = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunk_rows(pages: DataFrame, min_revisit_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """The chunked record table of pages (page_id, url, html).

    Of pages with equal payloads of at least min_revisit_bytes, the one with
    the largest page_id holds the payload, the others refer to it. Null html
    is an empty payload; a null page_id refers to the others' largest, or
    holds its payload if all are null; a repeated row holds it again."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    pages = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    holders = pages.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("copies"))
    # chunk numbers first, so that no row but the input's holds more than a chunk
    n_chunks = F.greatest(F.lit(1), F.ceil(F.col("payload_bytes") / chunk)).cast("int")
    rows = pages.withColumn("row_id", F.monotonically_increasing_id()).select("*", F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("chunk_no"))
    rows = rows.select("page_id", "url", "digest", "payload_bytes", "row_id", "chunk_no", F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("data"))
    rows = rows.join(holders.where("copies > 1").select("digest", "holder"), "digest", "left")
    refers = F.when((F.col("payload_bytes") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder"))
    rows = rows.withColumn("refers_to", refers).where("refers_to IS NULL OR chunk_no = 0")
    rows = rows.withColumn("data", F.when(F.col("refers_to").isNull(), F.col("data")).otherwise(F.lit(b"")))
    # repeated rows differ in row_id, so the chunks of each stay together
    return rows.sortWithinPartitions("digest", "page_id", "row_id", "chunk_no").select("page_id", "url", "digest", "payload_bytes", "refers_to", "chunk_no", "data")


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _head(page_id, url, digest, payload_bytes, refers_to) -> bytes:
    """Record and HTTP header up to the payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{RECORD}{'null' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", f"sha1:{_base32(digest)}"),
        ("WARC-Refers-To", None if refers_to is None else f"<{RECORD}{refers_to}>"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(http) + (payload_bytes if refers_to is None else 0)),
    ]
    lines = [f"{k}: {v}" for k, v in fields if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n" + http).encode()


def write_archives(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """Write the chunk rows, one archive per partition, and return (path,
    records). Rows of a record must follow each other in chunk order, as
    chunk_rows gives them. Archives appear whole or not at all, and a repeated
    task replaces its own. A payload whose chunks don't add up to its digest
    fails the job."""

    def ended(member, row, sha) -> bytes:
        if row["refers_to"] is None and sha.hexdigest() != row["digest"]:
            raise ValueError(f"chunks of page {row['page_id']} do not have the digest {row['digest']}")
        return member.compress(b"\r\n\r\n") + member.flush()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        records, member, now, sha = 0, None, None, None
        with NewFile(path) as out:
            for batch in (b for part in ([first], batches) for b in part):
                meta = batch.select(["page_id", "url", "digest", "payload_bytes", "refers_to", "chunk_no"]).to_pylist()
                for row, data in zip(meta, batch.column("data"), strict=True):
                    if row.pop("chunk_no") == 0:
                        if member:
                            out.write(ended(member, now, sha))
                        member, now, sha, records = zlib.compressobj(1, wbits=31), row, hashlib.sha1(), records + 1
                        out.write(member.compress(_head(**row)))
                    sha.update(data.as_buffer())
                    out.write(member.compress(data.as_buffer()))
            out.write(ended(member, now, sha))
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64())], names=["path", "records"])

    return stored(spark, rows.mapInArrow(run, "path string, records long"), "warc-manifest")


_READ = pa.schema(
    [
        ("path", pa.string()), ("record_no", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("header_digest", pa.string()), ("chunk_no", pa.int32()), ("data", pa.binary()),
        ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_()),
    ]
)


def _fields(stream) -> dict[str, str] | None:
    """Header lines up to the empty one; None at the end of the archive."""
    line = stream.readline()
    while line == b"\r\n":
        line = stream.readline()
    if not line:
        return None
    found = {}
    while line not in (b"\r\n", b""):
        name, colon, value = line.decode().strip().partition(": ")
        if colon:
            found[name.lower()] = value
        line = stream.readline()
    return found


def _number(uri: str | None) -> int | None:
    text = (uri or "").strip("<>").removeprefix(RECORD)
    return None if text in ("", "null") else int(text)


def _read(path: str, chunk: int, with_data: bool) -> Iterator[dict]:
    fs, inner = filesystem(path)
    with fs.open_input_stream(inner, compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw)) as stream:
        number = 0
        while (record := _fields(stream)) is not None:
            http = _fields(stream)
            size = int(http["content-length"])
            revisit = record["warc-type"] == "revisit"
            left, sha, at = 0 if revisit else size, hashlib.sha1(), 0
            row = {
                "path": path, "record_no": number, "page_id": _number(record["warc-record-id"]), "record_type": record["warc-type"],
                "refers_to": _number(record.get("warc-refers-to")), "payload_bytes": size, "header_digest": record["warc-payload-digest"].removeprefix("sha1:"),
            }
            number += 1
            while True:
                data = stream.read(min(left, chunk))
                if left and not data:
                    raise EOFError(f"{path}: record {number} ends early")
                sha.update(data)
                left -= len(data)
                yield row | {
                    "chunk_no": at, "data": data if with_data else None, "bytes_so_far": (0 if revisit else size) - left,
                    "digest_so_far": base64.b32encode(sha.digest()).decode(), "last": left == 0,
                }
                at += 1
                if left == 0:
                    break


def read_archives(archives: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """Chunk rows of the archives (path): one row per chunk of payload, one
    with no bytes for an empty payload or a revisit. digest_so_far of the last
    chunk of a response is the digest of the payload as read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                for row in _read(path, chunk, with_data):
                    rows.append(row)
                    held += len(row["data"] or b"") + 400
                    if held >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    kinds = "path string, record_no long, page_id long, record_type string, refers_to long, payload_bytes long, header_digest string, chunk_no int, data binary, bytes_so_far long, digest_so_far string, last boolean"
    return archives.select("path").mapInArrow(run, kinds)


def warc_round_trip(spark: SparkSession, pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write all pages as archives into the shared folder, read them back and
    return a row per page. A response whose payload does not have the digest
    its header states fails the job."""
    folder = scratch_path(spark, "warc")
    archives = write_archives(spark, chunk_rows(pages, min_revisit_bytes), folder)
    n = max(1, archives.count())
    ends = read_archives(archives.repartition(n), with_data=False).where("last")
    digest = F.when(F.col("record_type") == "revisit", F.col("header_digest")).otherwise(F.col("digest_so_far"))
    same = F.assert_true(digest == F.col("header_digest"), F.lit("payload digest differs from the record's header"))
    return ends.select(
        "page_id", "payload_bytes", F.when(same.isNull(), digest).alias("payload_digest"), "record_type", "refers_to", "path", "record_no"
    )
