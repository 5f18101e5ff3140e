"""Centroid clustering with Ptolemaic pivots (operator 13).

Lloyd rounds over integer vectors, exact in every distance and mean. After the
first round the centroids become fixed pivots, one for each, and every vector
keeps its distances to them. In later rounds Ptolemy's inequality bounds the
distance of a vector x to a centroid c, which has moved on from pivot p, by
the pair of p and the pivot s nearest to x:

    d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s)

The bound, rounded down by more than doubles can err, rules out centroids
farther than the best one checked; the rest are checked exactly. A round reads
the vectors once and shuffles one row per task and centroid.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foehn.llm.store import stored

SCALE, DIMS, CENTROIDS, ROUNDS = 64, 64, 16, 3

#: Beyond this size of a component, distances are added up as Python integers.
NARROW = 1 << 27

#: More than the relative rounding errors of a bound's terms add up to.
SLACK = 1e-13


def quantise(flat: np.ndarray, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, in rows of dims. Components that a
    long can't hold are an error, never dropped."""
    q = np.floor(scale * flat.astype(np.float64))
    if len(q) and np.abs(q).max() >= 2.0**62:
        raise OverflowError("a quantised component is too large for 64-bit integers")
    return q.astype(np.int64).reshape(-1, dims)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between rows of a and b (or one row b), as integers
    of any size where 64 bits might not hold them."""
    if len(a) and max(int(np.abs(a).max()), int(np.abs(b).max())) >= NARROW:
        a, b = a.astype(object), b.astype(object)
    gap = a - b
    return (gap * gap).sum(axis=1)


@dataclass
class Pivots:
    """Fixed pivots, one for each centroid."""

    rows: np.ndarray

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Distance of each row to each pivot, one column a pivot."""
        out = np.empty((len(q), len(self.rows)))
        for i, p in enumerate(self.rows):
            out[:, i] = np.sqrt(exact(q, p).astype(np.float64))
        return out

    def bounds(self, to_pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances to the centroids, rows by centroids,
        from the rows' distances to the pivots. A centroid whose pivot is the
        row's nearest, or equals it, has no pair and the bound 0."""
        moved = self.distances(centroids)  # centroids by pivots
        apart = self.distances(self.rows)
        near = to_pivots.argmin(axis=1)
        left = to_pivots * moved.T[near]
        right = to_pivots[np.arange(len(near)), near][:, None] * np.diag(moved)
        gap = apart[near]
        low = np.abs(left - right) - SLACK * (left + right)
        return np.maximum(np.divide(low, gap, out=np.zeros_like(low), where=gap > 0) * (1 - SLACK), 0)


def nearest(q: np.ndarray, centroids: np.ndarray, cached: np.ndarray | None = None, pivots: Pivots | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, exact checks made);
    ties go to the smaller number. Without pivots every distance is checked."""
    if pivots is None:
        first, least = np.zeros(len(q), np.int64), np.zeros((len(q), len(centroids)))
    else:
        first, bound = cached.argmin(axis=1), pivots.bounds(cached, centroids)
        least = bound * bound * (1 - SLACK)
    cluster, best, checks = first.copy(), exact(q, centroids[first]), len(q)
    for j, centroid in enumerate(centroids):
        open_ = np.flatnonzero((least[:, j] <= best.astype(np.float64) * (1 + SLACK)) & (first != j))
        if not len(open_):
            continue
        found, checks = exact(q[open_], centroid), checks + len(open_)
        better = (found < best[open_]) | ((found == best[open_]) & (j < cluster[open_]))
        if best.dtype != found.dtype:
            best, found = best.astype(object), found.astype(object)
        best[open_[better]], cluster[open_[better]] = found[better], j
    return cluster, best, checks


def _read(batch: pa.RecordBatch, dims: int, pivots: Pivots | None) -> tuple[np.ndarray, np.ndarray | None]:
    flat = lambda name, width: batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return flat("q", dims), flat("to_pivots", len(pivots.rows)) if pivots else None


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def prepared(spark: SparkSession, vectors: DataFrame, id_col: str, vector: str, dims: int, scale: int) -> DataFrame:
    """Rows (id, q) of the vectors that are kept, in the shared folder. Kept:
    exactly ``dims`` components, none null or non-finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    rows = vectors.where((F.size(vector) == dims) & finite).select(F.col(id_col).alias("id"), F.col(vector).alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q = quantise(batch.column(1).flatten().to_numpy(zero_copy_only=False), dims, scale)
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(q)], names=["id", "q"])

    return stored(spark, rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, q array<long>"), "quantised")


def with_pivots(spark: SparkSession, rows: DataFrame, pivots: Pivots) -> DataFrame:
    """Rows (id, q, to_pivots) with their distances to the pivots, in the
    shared folder."""
    dims = pivots.rows.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q, _ = _read(batch, dims, None)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("q"), _lists(pivots.distances(q))], names=["id", "q", "to_pivots"])

    return stored(spark, rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, q array<long>, to_pivots array<double>"), "with-pivots")


def first_centroids(rows: DataFrame, k: int) -> np.ndarray:
    """The k rows of smallest sha256 of ``1:<id>``, in that order; ties (of
    repeated ids) go to the smaller vector, null ids come last."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    return np.array([r[0] for r in rows.select("q", key.alias("key")).orderBy(F.asc_nulls_last("key"), "q").limit(k).collect()], np.int64)


def moved(rows: DataFrame, centroids: np.ndarray, pivots: Pivots | None = None) -> tuple[np.ndarray, int]:
    """Centroids after a round, each the floor of its vectors' exact mean
    (unchanged without vectors), and the exact checks that the round made."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, checked = [0] * len(centroids), 0
        total = np.zeros(centroids.shape, object)
        for batch in batches:
            if not batch.num_rows:
                continue
            q, cached = _read(batch, dims, pivots)
            cluster, _, checks = nearest(q, centroids, cached, pivots)
            checked += checks
            wide = int(np.abs(q).max()) * len(q) >= 2**62
            for j in np.unique(cluster):
                own = q[cluster == j]
                count[j] += len(own)
                total[j] += (own.astype(object) if wide else own).sum(axis=0)
        some = [j for j, n in enumerate(count) if n]
        sums = [[Decimal(int(x)) for x in total[j]] for j in some]
        shares = [checked if j == some[0] else 0 for j in some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([count[j] for j in some], pa.int64()), pa.array(shares, pa.int64()), pa.array(sums, pa.list_(pa.decimal128(38, 0)))],
            names=["cluster", "n", "checked", "sums"],
        )

    parts = rows.mapInArrow(run, "cluster int, n long, checked long, sums array<decimal(38,0)>")
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)]
    out, checked = centroids.copy(), 0
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("checked").alias("checked"), *sums).collect():
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]
        checked += r["checked"]
    return out, checked


def assigned(rows: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """(id, cluster, distance) of every row. A squared distance beyond a long
    is an error."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q, cached = _read(batch, dims, pivots)
            cluster, distance, _ = nearest(q, centroids, cached, pivots)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance.tolist(), pa.int64())], names=["id", "cluster", "distance"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, cluster int, distance long")


@dataclass
class Clustering:
    """Assigned rows (id, cluster, distance) in the shared folder, the final
    centroids, vectors held, and per round the exact checks made (the first
    round, without pivots, makes all)."""

    rows: DataFrame
    centroids: np.ndarray
    vectors: int
    checks: list[int]

    def skipped(self) -> float:
        """Share of the distances of rounds with pivots that bounds ruled out."""
        every = self.vectors * len(self.centroids) * len(self.checks[1:])
        return 1 - sum(self.checks[1:]) / every if every else 0.0


def cluster_vectors(
    spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE
) -> Clustering:
    """Cluster the kept vectors (see ``prepared``) around k centroids, fewer
    where there are fewer vectors. Repeated rows count and are returned each
    time; rows of null id take part. Other columns are ignored."""
    rows, pivots = prepared(spark, vectors, id_col, vector, dims, scale), None
    centroids, checks = first_centroids(rows, k), []
    if not len(centroids):
        return Clustering(rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids, 0, checks)
    for _ in range(rounds):
        centroids, made = moved(rows, centroids, pivots)
        checks.append(made)
        if pivots is None:
            pivots = Pivots(centroids)
            rows = with_pivots(spark, rows, pivots)
    found = stored(spark, assigned(rows, centroids, pivots), "clusters")
    return Clustering(found, centroids, found.count(), checks)


def clustered(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """Per kept vector: id_col, ``cluster``, ``distance`` (squared),
    ``cluster_inertia`` and ``inertia`` (distances added up over its cluster
    and over all), ``centroid_sha256`` (of its centroid's components as
    decimals joined by commas). No kept vectors, no rows; sums beyond a long
    are an error."""
    found = cluster_vectors(spark, vectors, id_col, vector, **options)
    inertia = {r["cluster"]: int(r["d"]) for r in found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()}
    names = [sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    of_cluster = [(j, inertia.get(j, 0), sum(inertia.values()), name) for j, name in enumerate(names)]
    table = spark.createDataFrame(of_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.withColumnRenamed("id", id_col).join(F.broadcast(table), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
