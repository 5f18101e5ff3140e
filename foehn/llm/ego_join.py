"""Cosine self-join of vectors by an epsilon grid order (operator 10).

Unit vectors of cosine >= c lie within eps = sqrt(2 - 2c). Vectors are sorted
by their eps-grid cells on the leading principal directions; intervals of that
sequence form blocks with bounding boxes. A tree of intervals over the blocks
is joined with itself level by level, dropping pairs of intervals whose boxes
are more than eps apart. A task joins two blocks, again by halves, and compares
what is left in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foehn.llm.components import connected_components
from foehn.llm.ngram_join import local_roots
from foehn.llm.store import partitions_for, stored

COSINE = 0.98

#: Rows of a block, children of an interval, directions of the boxes and of
#: the sort order, rows below which an interval pair is compared directly.
BLOCK, FANOUT, BOX, ORDER, LEAF = 1024, 16, 8, 4, 128

#: Vectors on which the principal directions are fitted. They only steer what
#: is skipped; any directions give the same links.
SAMPLE = 4096


def principal_directions(vectors: DataFrame, vector: str) -> dict[int, np.ndarray]:
    """Per vector length the leading directions (BOX columns) of at most
    SAMPLE vectors, chosen by hash."""
    sample = vectors.select(vector).orderBy(F.xxhash64(vector)).limit(SAMPLE).collect()
    by_length: dict[int, list] = {}
    for (x,) in sample:
        by_length.setdefault(len(x), []).append(x)
    found = {}
    for length, rows in by_length.items():
        x = np.array(rows, float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        found[length] = np.linalg.eigh(np.cov(x.T, bias=True).reshape(length, length))[1][:, ::-1][:, :BOX]
    return found


def unit_rows(items: DataFrame, basis: dict[int, np.ndarray], eps: float) -> DataFrame:
    """(node, weight, label, dim, unit, leading coordinates p0.., cells c0..)
    of each row (node, weight, label, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(3)
            flat, ends = rows.flatten().cast(pa.float64()).to_numpy(), np.diff(rows.offsets.to_numpy())
            place = np.concatenate(([0], np.cumsum(ends)))
            for dim in np.unique(ends):
                at = np.flatnonzero(ends == dim)
                x = flat[place[at][:, None] + np.arange(dim)]
                x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                directions = basis.get(int(dim), np.eye(dim)[:, :BOX])
                p = np.zeros((len(at), BOX))
                p[:, : directions.shape[1]] = x @ directions
                cells = np.floor(p[:, :ORDER] / eps).astype(np.int32)
                part = [batch.column(i).take(pa.array(at)) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*part, pa.array(np.full(len(at), dim, np.int32)), pa.array([r.tobytes() for r in x]), *(pa.array(c) for c in p.T), *(pa.array(c) for c in cells.T)],
                    names=["node", "weight", "label", "dim", "unit", *(f"p{i}" for i in range(BOX)), *(f"c{i}" for i in range(ORDER))],
                )

    kinds = ["node long", "weight long", "label " + dict(items.dtypes)["label"], "dim int", "unit binary", *(f"p{i} double" for i in range(BOX)), *(f"c{i} int" for i in range(ORDER))]
    return items.select("node", "weight", "label", "vector").mapInArrow(run, ", ".join(kinds))


def blocks_of(items: DataFrame) -> DataFrame:
    """Blocks of the sorted sequence: (block, label, dim, low, high, nodes,
    weights, units, coordinates); block numbers follow the order."""
    n = max(1, -(-items.count() // BLOCK))
    keys = ["label", "dim", *(f"c{i}" for i in range(ORDER)), "node"]
    ordered = items.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    label_kind = dict(items.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, key = TaskContext.get().partitionId(), 0, [], None
        def block():
            nonlocal number
            places = np.array([r[4] for r in held])
            number += 1
            return {
                "block": (part << 32) + number, "label": key[0], "dim": key[1], "low": places.min(axis=0).tolist(), "high": places.max(axis=0).tolist(),
                "nodes": np.array([r[2] for r in held], np.int64).tobytes(), "weights": np.array([r[3] for r in held], np.int64).tobytes(),
                "units": b"".join(r[5] for r in held), "places": places.tobytes(),
            }

        def batch_of(row):
            return pa.RecordBatch.from_pylist([row], schema=_block_schema(kind))

        kind = None
        for batch in batches:
            kind = batch.column("label").type
            places = np.stack([batch.column(f"p{i}").to_numpy() for i in range(BOX)], axis=1)
            for i, (label, dim, node, weight, unit) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "node", "weight", "unit")), strict=True)):
                if held and (key != (label, dim) or len(held) == BLOCK):
                    yield batch_of(block())
                    held = []
                key = (label, dim)
                held.append((label, dim, node, weight, places[i], unit))
        if held:
            yield batch_of(block())

    return ordered.mapInArrow(run, f"block long, label {label_kind}, dim int, low array<double>, high array<double>, nodes binary, weights binary, units binary, places binary")


def _block_schema(label: pa.DataType) -> pa.Schema:
    sides = [(k, pa.list_(pa.float64())) for k in ("low", "high")]
    return pa.schema([("block", pa.int64()), ("label", label), ("dim", pa.int32()), *sides, *((k, pa.binary()) for k in ("nodes", "weights", "units", "places"))])


def _near(eps: float):
    """Boxes (low_a, high_a) and (low_b, high_b) at most eps apart."""
    total = F.lit(0.0)
    for i in range(BOX):
        gap = F.greatest(F.col("low_a")[i] - F.col("high_b")[i], F.col("low_b")[i] - F.col("high_a")[i], F.lit(0.0))
        total = total + gap * gap
    return total <= eps * eps


def block_pairs(spark: SparkSession, blocks: DataFrame, eps: float) -> DataFrame:
    """(a, b) with a <= b: the pairs of blocks of one label and dim that may
    hold links, by joining the interval tree with itself from its root."""
    place = Window.partitionBy("label", "dim").orderBy("block")
    leaves = stored(spark, blocks.select("block", "label", "dim", "low", "high", (F.row_number().over(place) - 1).cast("long").alias("node")), "intervals")
    most = leaves.agg(F.max("node")).first()[0]
    levels = [leaves]
    while most:
        most //= FANOUT
        low, high = (F.array(*(f(F.col(side)[i]) for i in range(BOX))).alias(side) for f, side in ((F.min, "low"), (F.max, "high")))
        parent = F.floor(F.col("node") / FANOUT).cast("long")
        levels.append(levels[-1].groupBy("label", "dim", parent.alias("node")).agg(low, high))
    pairs = levels[-1].select("label", "dim", F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        parent = F.floor(F.col("node") / FANOUT).cast("long")
        first = level.select("label", "dim", parent.alias("a"), F.col("node").alias("child_a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
        second = level.select("label", "dim", parent.alias("b"), F.col("node").alias("child_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
        near = pairs.join(first, ["label", "dim", "a"]).join(second, ["label", "dim", "b"]).where("child_a <= child_b").where(_near(eps))
        pairs = stored(spark, near.select("label", "dim", F.col("child_a").alias("a"), F.col("child_b").alias("b")), "interval-pairs")
    names = leaves.select("label", "dim", "node", "block")
    pairs = pairs.join(names.select("label", "dim", F.col("node").alias("a"), F.col("block").alias("block_a")), ["label", "dim", "a"])
    pairs = pairs.join(names.select("label", "dim", F.col("node").alias("b"), F.col("block").alias("block_b")), ["label", "dim", "b"])
    return stored(spark, pairs.select("block_a", "block_b"), "block-pairs")


def join_intervals(a: np.ndarray, b: np.ndarray, places_a: np.ndarray, places_b: np.ndarray, eps: float, cosine: float, out: np.ndarray) -> None:
    """Mark in out the rows of a and b of at least that cosine; halves whose
    boxes are more than eps apart are skipped."""
    low_a, high_a, low_b, high_b = places_a.min(axis=0), places_a.max(axis=0), places_b.min(axis=0), places_b.max(axis=0)
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    if gap @ gap > eps * eps:
        return
    if max(len(a), len(b)) <= LEAF:
        out |= a @ b.T >= cosine
        return
    ia, ib = (len(a) // 2 if len(a) > LEAF else len(a)), (len(b) // 2 if len(b) > LEAF else len(b))
    for x in (slice(0, ia), slice(ia, None)):
        for y in (slice(0, ib), slice(ib, None)):
            if len(a[x]) and len(b[y]):
                join_intervals(a[x], b[y], places_a[x], places_b[y], eps, cosine, out[x, y])


def _join(batches: Iterator[pa.RecordBatch], eps: float, cosine: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for task in batch.to_pylist():
            side = lambda s, t=task: (np.frombuffer(t[f"nodes_{s}"], np.int64), np.frombuffer(t[f"weights_{s}"], np.int64), np.frombuffer(t[f"units_{s}"]).reshape(-1, t["dim"]), np.frombuffer(t[f"places_{s}"]).reshape(-1, BOX))
            (nodes_a, weights_a, a, places_a), (nodes_b, weights_b, b, places_b) = side("a"), side("b")
            linked = np.zeros((len(a), len(b)), bool)
            join_intervals(a, b, places_a, places_b, eps, cosine, linked)
            if task["block_a"] == task["block_b"]:
                np.fill_diagonal(linked, False)
                nodes, links, square = nodes_a, linked @ weights_a, linked
            else:
                nodes, links = np.concatenate((nodes_a, nodes_b)), np.concatenate((linked @ weights_b, linked.T @ weights_a))
                square = np.zeros((len(nodes), len(nodes)), bool)
                square[: len(a), len(a) :] = linked
                square[len(a) :, : len(a)] = linked.T
            some = np.flatnonzero(links)
            roots = local_roots(square[np.ix_(some, some)], nodes[some]) if len(some) else nodes[some]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(links[some].astype(np.int64)), pa.array(roots)], names=["node", "links", "root"])


def cosine_self_join(
    spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE
) -> DataFrame:
    """One row per input row: id_col, ``n_links`` (other rows of the same
    label and at least that cosine), ``component_id`` (smallest id reachable by
    links, itself included) and ``kept`` (whether that is its own id).

    Rows whose label or vector is null, or whose vector is empty, zero or holds
    a null or non-finite component, link with nothing; so do vectors of unlike
    lengths. A null id is a component id only if the component has no other.
    Repeated rows link with each other."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine))) * (1 + 1e-9) + 1e-12  # rounding never skips a link
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    takes_part = F.col(label).isNotNull() & F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    node = F.when(F.coalesce(takes_part, F.lit(False)), F.xxhash64(F.col(label), F.col(vector))).alias("node")
    rows = stored(spark, vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"), node), "vectors")
    heads = stored(spark, rows.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("weight")), "vector-classes")
    # one row per distinct vector: the join keys hold the id, which spreads copies
    one = rows.select("node", F.col("id").alias("own"), "label", "vector")
    one = one.join(heads, (one["node"] == heads["node"]) & one["own"].eqNullSafe(heads["id"])).select(one["node"], "weight", "label", "vector").dropDuplicates(["node"])
    basis = principal_directions(rows.where("node is not null"), "vector")
    items = stored(spark, unit_rows(one, basis, eps), "units")
    blocks = stored(spark, blocks_of(items), "blocks")
    pairs = block_pairs(spark, blocks, eps)
    sides = [blocks.select(F.col("block").alias(f"block_{s}"), "dim", *(F.col(k).alias(f"{k}_{s}") for k in ("nodes", "weights", "units", "places"))) for s in "ab"]
    work = pairs.join(sides[0], "block_a").join(sides[1].drop("dim"), "block_b")
    n = partitions_for(pairs.count())
    links = stored(spark, work.repartition(n).mapInArrow(lambda x: _join(x, eps, cosine), "node long, links long, root long"), "links")

    parts = connected_components(spark, links.where("root != node").select(F.col("node").alias("u"), F.col("root").alias("v")))
    named = heads.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = named.join(lowest, "component").join(counted, "node", "left").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    component = F.when(F.col("n_links") > 0, F.col("component_id")).otherwise(F.col("id"))
    return rows.select("id", "node").join(named, "node", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept")
    )
