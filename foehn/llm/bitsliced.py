"""Exact top-k inner products over a bit-sliced index (operator 7).

Vectors are quantised to integers and stored, in blocks of rows dealt by hash
and ordered by id, as one bitmap per bit of each attribute. A query's scores for all rows of a
block are added up as bitmaps with carry-save adders; the top rows are picked
from the most significant score slice downward, and rows that tie at the
boundary are taken in id order, so results are exact. Queries and blocks meet
block against chunk; a task holds one of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foehn.llm.store import partitions_for, stored

SCALE = 256
BLOCK = 16384
CHUNK = 256

#: Quantised components from this size on are an error.
LARGEST = float(2**62)

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(vectors: DataFrame, id_col: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, dim, ints) of the rows that take part: neither id nor vector null,
    no component null or non-finite. A component too large for a long is an
    error, and so is, in the search, a score that is."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    scaled = lambda x: F.floor(F.lit(scale) * x.cast("double"))
    too_large = F.raise_error(F.lit("a quantised component is too large for 64-bit integers")).cast("long")
    ints = F.transform(vector, lambda x: F.when(F.abs(F.lit(scale) * x.cast("double")) < LARGEST, scaled(x)).otherwise(too_large))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)).where(finite)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.size(vector).alias("dim"), ints.alias("ints"))


def _packed(rows: DataFrame, most: int, encode) -> DataFrame:
    """Rows (id, dim, ints) of one dim, about ``most`` together, dealt by hash
    and ordered by id, as one row (dim, width, low, ids, data, part) each."""
    n = max(1, -(-rows.count() // most))

    def run(table: pa.Table) -> pa.Table:
        ids, dim = table["id"].to_numpy(), table["dim"][0].as_py()
        order = np.argsort(ids, kind="stable")
        matrix = table["ints"].combine_chunks().flatten().to_numpy().reshape(-1, dim)[order]
        low, width, data = encode(matrix)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()), "width": pa.array([int(width)], pa.int32()), "low": pa.array([low.tobytes()]),
                "ids": pa.array([ids[order].tobytes()]), "data": pa.array([data]), "part": [f"{dim}:{table['deal'][0].as_py()}"],
            }
        )

    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("id", "ints"), F.lit(n)))
    return dealt.groupBy("dim", "deal").applyInArrow(run, "dim int, width int, low binary, ids binary, data binary, part string")


def slice_bits(matrix: np.ndarray) -> tuple[np.ndarray, int, bytes]:
    """Attribute minima, bits per attribute and the bitmaps [attribute][bit]
    of 64-row words of matrix minus the minima."""
    low = matrix.min(axis=0)
    above = (matrix - low).astype(np.uint64)
    width = max(1, int(above.max()).bit_length())
    words = -(-len(matrix) // 64)
    bits = np.zeros((matrix.shape[1], width, words * 64), np.uint8)
    for b in range(width):
        bits[:, b, : len(matrix)] = ((above >> np.uint64(b)) & np.uint64(1)).T
    return low, width, np.packbits(bits, axis=2, bitorder="little").tobytes()


def build_index(spark: SparkSession, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The index of quantised rows: one row per block, in the shared folder."""
    return stored(spark, _packed(rows, block, slice_bits), "bitsliced")


def _add(levels: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Sum of bitmaps weighted 2**level: its bitmaps from low to high."""
    out, level = [], 0
    while levels:
        here = levels.pop(level, [])
        above = levels.setdefault(level + 1, []) if len(here) > 1 else []
        while len(here) > 2:
            a, b, c = here.pop(), here.pop(), here.pop()
            half = a ^ b
            a &= b
            b = half & c
            a |= b
            above.append(a)
            half ^= c
            here.insert(0, half)
        if len(here) == 2:
            a, b = here
            above.append(a & b)
            here = [a ^ b]
        out.append(here[0] if here else None)
        level += 1
    return out


def top_rows(score: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores among the marked rows; ties at the
    boundary in row order."""
    sure, open_, need = np.zeros_like(rows), rows.copy(), min(k, int(np.bitwise_count(rows).sum()))
    for bits in reversed(score):
        if not need:
            break
        high = open_ & bits if bits is not None else np.zeros_like(open_)
        n = int(np.bitwise_count(high).sum())
        if n > need:
            open_ = high
        else:
            sure |= high
            need -= n
            open_ &= ~high
    at = _positions(open_)[:need]
    return np.sort(np.concatenate((_positions(sure), at)))


def _positions(bitmap: np.ndarray) -> np.ndarray:
    words = np.flatnonzero(bitmap)
    bits = np.unpackbits(bitmap[words].view(np.uint8), bitorder="little").reshape(-1, 64)
    word, bit = np.nonzero(bits)
    return words[word] * 64 + bit


def search_block(query: np.ndarray, low: np.ndarray, width: int, slices: np.ndarray, inverse: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(position, score) of the k best marked rows of a block.

    A negative weight takes the complement of the bitmaps, so that only sums
    of non-negative terms are added: -q * x = q * (2**width - 1 - x) less a constant."""
    levels: dict[int, list[np.ndarray]] = {}
    constant = sum(int(q) * int(m) for q, m in zip(query, low, strict=True))
    for d, q in enumerate(query.tolist()):
        bitmaps = slices[d] if q >= 0 else inverse[d]
        if q < 0:
            constant -= -q * ((1 << width) - 1)
        q = abs(q)
        while q:
            shift = (q & -q).bit_length() - 1
            q &= q - 1
            for b in range(width):
                levels.setdefault(shift + b, []).append(bitmaps[b].copy())
    score = _add(levels)
    out = []
    for at in top_rows(score, rows, k).tolist():
        word, bit = at >> 6, np.uint64(at & 63)
        value = sum(int((bits[word] >> bit) & np.uint64(1)) << level for level, bits in enumerate(score) if bits is not None)
        out.append((at, value + constant))
    return out


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for task in batch.to_pylist():
            dim, width = task["dim"], task["width"]
            ids, low = np.frombuffer(task["ids"], np.int64), np.frombuffer(task["low"], np.int64)
            slices = np.frombuffer(task["data"], np.uint64).reshape(dim, width, -1)
            inverse, every = ~slices, np.zeros(slices.shape[2] * 64, np.uint8)
            every[: len(ids)] = 1
            every = np.packbits(every, bitorder="little").view(np.uint64)
            own = np.frombuffer(task["query_ids"], np.int64)
            found = []
            for number, query in enumerate(np.frombuffer(task["queries"], np.int64).reshape(len(own), dim)):
                rows = every.copy()
                for at in range(*np.searchsorted(ids, [own[number], own[number] + 1])):
                    rows[at >> 6] &= ~(np.uint64(1) << np.uint64(at & 63))
                found += [(task["chunk"], number, int(own[number]), int(ids[at]), score) for at, score in search_block(query, low, width, slices, inverse, rows, k)]
            columns = list(zip(*found, strict=True)) or [[]] * 5
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["chunk", "number", "query_id", "vec_id", "score"])


def top_k(spark: SparkSession, rows: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries the k rows of
    other id with the highest integer inner product, ties to the smaller id.

    rows, queries: (id, dim, ints) as quantised() gives them; only vectors of
    the query's dimension are compared. A repeated query row is answered each
    time, a repeated row is a candidate each time. No rows, no results."""
    index = build_index(spark, rows, block).withColumnRenamed("part", "block")
    chunks = stored(spark, _packed(queries, chunk, lambda m: (m[0], 1, m.astype(np.int64).tobytes())), "queries")
    chunks = chunks.select(F.col("dim").alias("query_dim"), F.col("part").alias("chunk"), F.col("ids").alias("query_ids"), F.col("data").alias("queries"))
    # which block meets which chunk: names only, then each task's two payloads
    tasks = index.select("block", "dim").join(chunks.select("chunk", "query_dim"), F.col("dim") == F.col("query_dim")).select("block", "chunk")
    tasks = stored(spark, tasks, "search-tasks")
    n = partitions_for(tasks.count())
    work = tasks.join(index, "block").join(chunks, "chunk").select("chunk", "dim", "width", "low", "ids", "data", "query_ids", "queries")
    found = work.repartition(n).mapInArrow(lambda batches: _search(batches, k), "chunk string, number int, query_id long, vec_id long, score long")
    best = Window.partitionBy("chunk", "number").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
