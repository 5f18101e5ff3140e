"""Similarity self-join of texts on their word n-gram sets (operator 5).

MinHash banding finds candidates, full n-gram sets verify them:

1. every text gets ``bands`` hashes of ``rows`` minima each; texts that share
   a band hash are tied to the smallest text of that bucket (a star, so a
   bucket of m texts gives m edges, never its pairs);
2. components of those edges are the groups inside which links can lie;
3. each group is verified in blocks of ``BLOCK`` texts: a task holds two
   blocks of full n-gram sets, multiplies their incidence matrices and tests
   every pair exactly. It returns link counts and a local spanning star, so
   output stays linear in the texts of the block;
4. components over the verified stars are the near-duplicate classes.

Equal texts are one item with a multiplicity. With 36 bands of 8 rows a pair
of similarity 0.8 is missed with probability (1 - 0.8**8)**36 = 0.0013, one of
0.85 with 0.00001.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foehn.llm.components import connected_components
from foehn.llm.store import numbered, releasing, stored
from foehn.llm.textvec import ALNUM, mix, slices

N_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 36, 8

#: Items of one side of a verification task, and n-grams in one matrix product.
BLOCK = 1024
COLUMNS = 2048

_U = np.uint64


def band_hashes(shingles: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands) of texts whose n-gram hashes are
    shingles[first[i]:first[i + 1]], none empty."""
    rng = np.random.default_rng(20)
    a = rng.integers(1, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    low = (shingles >> _U(32)).astype(np.uint32)
    work = np.empty_like(low)
    out = np.empty((len(first) - 1, bands), _U)
    for band in range(bands):
        key = np.full(len(first) - 1, band + 1, _U)
        for row in range(band * rows, band * rows + rows):
            np.multiply(low, a[row], out=work)
            np.add(work, b[row], out=work)
            np.bitwise_xor(work, work >> np.uint32(15), out=work)
            np.multiply(work, np.uint32(0x2C1B3C6D), out=work)
            key = mix(key * _U(0x9E3779B97F4A7C15) + np.minimum.reduceat(work, first[:-1]))
        out[:, band] = key
    return out


def signatures(docs: DataFrame, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """(class, bands): for each text with at least one n-gram its hash and its
    band hashes, once per task. Texts count as equal if they are the same
    string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(0)))
            new = [i for i, c in enumerate(batch.column(0).to_pylist()) if not (c in seen or seen.add(c))]
            batch = batch.take(pa.array(new, pa.int64()))
            for row, to, texts in slices(batch.column(1)):
                shingles, first = texts.words(ALNUM).shingles(n)
                some = np.flatnonzero(np.diff(first))
                if not len(some):
                    continue
                keys = band_hashes(shingles, np.append(first[:-1][some], first[-1]), bands, rows).view(np.int64)
                offsets = np.arange(0, len(some) * bands + 1, bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, to - row).take(pa.array(some)), pa.ListArray.from_arrays(offsets, keys.ravel())],
                    names=["class", "bands"],
                )

    return docs.select(class_of(text), F.lower(F.col(text)).alias("text")).mapInArrow(releasing(run), "class long, bands array<long>")


def class_of(text: str):
    """Equal for equal texts only (64 bits); null for null texts."""
    return F.when(F.col(text).isNotNull(), F.xxhash64(text)).alias("class")


def shingle_sets(items: DataFrame, n: int, keep: list[str]) -> DataFrame:
    """Adds ``grams``: the sorted distinct n-gram hashes of ``text``, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for row, to, texts in slices(batch.column(at)):
                shingles, first = texts.words(ALNUM).shingles(n)
                sets = [np.unique(shingles[a:b]).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                part = batch.slice(row, to - row)
                yield pa.RecordBatch.from_arrays([part.column(k) for k in keep] + [pa.array(sets, pa.binary())], names=[*keep, "grams"])

    kinds = dict(items.dtypes)
    return items.withColumn("text", F.lower("text")).mapInArrow(releasing(run), ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", grams binary")


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix: Jaccard similarity of the two sets at least threshold."""
    sizes_l, sizes_r = (np.array([len(x) for x in side], np.int64) for side in (left, right))
    flat = np.concatenate([*left, *right])
    _, number, often = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(often > 1)  # n-grams of a single set meet nothing
    place = np.full(len(often), -1)
    place[shared] = np.arange(len(shared))
    column = place[number]
    row_l, row_r = np.repeat(np.arange(len(left)), sizes_l), np.repeat(np.arange(len(right)), sizes_r)
    column_l, column_r = column[: len(row_l)], column[len(row_l) :]
    common = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(shared), COLUMNS):
        parts = []
        for rows, columns, height in ((row_l, column_l, len(left)), (row_r, column_r, len(right))):
            here = (columns >= at) & (columns < at + COLUMNS)
            matrix = np.zeros((height, min(COLUMNS, len(shared) - at)), np.float32)
            matrix[rows[here], columns[here] - at] = 1
            parts.append(matrix)
        common += parts[0] @ parts[1].T
    either = sizes_l[:, None] + sizes_r[None, :] - common
    return common >= threshold * either - 1e-9


def local_roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each row's component in a symmetric boolean matrix."""
    roots = ids.copy()
    while True:
        lower = np.minimum(roots, np.where(linked, roots[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
        if (lower == roots).all():
            return roots
        roots = lower


def _verify(ids, blocks, weights, sets, pair, threshold):
    """Links of one group within a task: (id, links, root) of each text."""
    order = np.argsort(blocks, kind="stable")
    ids, blocks, weights, sets = ids[order], blocks[order], weights[order], [sets[i] for i in order]
    cut = np.searchsorted(blocks, pair[0], side="right") if pair[0] != pair[1] else 0
    linked = np.zeros((len(ids), len(ids)), bool)
    if cut:
        linked[:cut, cut:] = similar_pairs(sets[:cut], sets[cut:], threshold)
        linked |= linked.T
    else:
        linked = similar_pairs(sets, sets, threshold)
        np.fill_diagonal(linked, False)
    return ids, linked @ weights, local_roots(linked, ids)


def verified_links(spark: SparkSession, sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Exact links inside groups. sets: (class, grp, weight, grams).

    Returns (class, n_links) with the weights of the linked classes summed,
    and the star edges (u, v) of the verified links."""
    sizes = sets.groupBy("grp").agg(F.count("*").alias("members"))
    tasks = 1 + sets.count() // BLOCK
    sets = sets.join(sizes, "grp").withColumn("n_blocks", F.ceil(F.col("members") / BLOCK))
    sets = sets.withColumn("block", F.when(F.col("n_blocks") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("class", F.lit(7)), F.col("n_blocks"))))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    sets = sets.withColumn("other", other).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    task = F.when(F.col("n_blocks") == 1, F.pmod(F.xxhash64("grp"), F.lit(tasks))).otherwise(-1 - F.pmod(F.xxhash64("grp", "low", "high"), F.lit(1 << 40)))

    def run(table: pa.Table) -> pa.Table:
        ids, groups, blocks, low, high, weights = (table[k].to_numpy() for k in ("class", "grp", "block", "low", "high", "weight"))
        grams = table["grams"].to_pylist()
        order = np.lexsort((ids, high, low, groups))
        keys = np.stack([groups, low, high, ids])[:, order]
        order = order[np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))]  # a repeated row once
        keys = np.stack([groups, low, high])[:, order]
        ends = np.append(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, len(order))
        found, begin = [], 0
        for end in ends:
            at = order[begin:end]
            begin = end
            if len(at) > 1:
                found.append(_verify(ids[at], blocks[at], weights[at], [np.frombuffer(grams[i], _U) for i in at], (low[at[0]], high[at[0]]), threshold))
        columns = [np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in range(3)]
        return pa.table(dict(zip(("class", "links", "root"), (pa.array(c.astype(np.int64)) for c in columns), strict=True)))

    links = sets.select("class", "grp", "block", "low", "high", "weight", "grams", task.alias("task")).groupBy("task").applyInArrow(run, "class long, links long, root long")
    links = stored(spark, links, "links")
    return (
        links.groupBy("class").agg(F.sum("links").alias("n_links")),
        links.where("root != class").select(F.col("class").alias("u"), F.col("root").alias("v")).distinct(),
    )


def candidate_groups(spark: SparkSession, bands: DataFrame) -> DataFrame:
    """(class, grp) of the classes that share a band hash with another one,
    directly or through others."""
    rows = bands.select("class", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low != high").select("key", "low")
    buckets = stored(spark, buckets, "buckets")  # a table of its own, so that a hot bucket's side of the join can be split
    stars = rows.join(buckets, "key").where("class != low").select(F.col("class").alias("u"), F.col("low").alias("v"))
    return connected_components(spark, stars).select(F.col("node").alias("class"), F.col("component").alias("grp"))


def ngram_jaccard_join(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text",
    n: int = N_WORDS, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row per input row: id_col, ``class_id`` (smallest id reachable by
    links), ``n_links`` (other rows linked directly), ``text_class`` (equal for
    equal texts) and ``grp`` (equal within a class).

    Words are lower-cased runs of ASCII letters, digits, ``_`` and non-ASCII
    characters; a text of fewer than n words has its whole word list as its
    only n-gram. Null texts and texts without words link with nothing and are
    their own class. Equal texts always link. Null ids are no class id unless
    all ids of a class are null. Other columns are ignored."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    signed = stored(spark, signatures(docs, "text", n, bands, rows), "signatures")
    groups = stored(spark, candidate_groups(spark, signed), "groups")

    heads = docs.select(class_of("text"), "id").where("class is not null").groupBy("class").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    heads = stored(spark, heads, "heads")
    wanted = heads.join(groups, "class")
    # one text per class: the join keys hold the id, which spreads copies of one text
    texts = docs.select(class_of("text"), F.col("id").alias("own"), "text")
    texts = texts.join(wanted, (texts["class"] == wanted["class"]) & texts["own"].eqNullSafe(wanted["id"])).select(wanted["class"], "grp", "weight", "text")
    sets = stored(spark, shingle_sets(texts, n, ["class", "grp", "weight"]), "sets").dropDuplicates(["class"])
    links, stars = verified_links(spark, sets, threshold)

    parts = connected_components(spark, stars).withColumnsRenamed({"node": "class"})
    named = heads.join(parts, "class", "left").withColumn("component", F.coalesce("component", "class"))
    lowest = named.groupBy("component").agg(F.min("id").alias("class_id"))
    signed = signed.select("class").distinct().withColumn("words", F.lit(True))
    named = named.join(lowest, "component").join(links, "class", "left").join(signed, "class", "left")
    named = stored(spark, named.select("class", "component", "class_id", "weight", "words", F.coalesce("n_links", F.lit(0)).alias("n_links")), "classes")

    rows_ = docs.select("id", class_of("text")).join(named, "class", "left")
    return rows_.select(
        F.col("id").alias(id_col),
        F.when(F.col("words"), F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
        F.when(F.col("words"), F.col("n_links") + F.col("weight") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.col("class").alias("text_class"),
        F.col("component").alias("grp"),
    )


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs without all but one row of each near-duplicate class:
    the row with the class's smallest id stays (of repeated rows, one). Rows
    whose text is null or has no words all stay."""
    rows, name = numbered(docs)
    found = ngram_jaccard_join(spark, rows, name[id_col], name[text], **options).where("n_links > 0")
    heads = found.groupBy("text_class").agg(F.min("class_id").alias("class_id"), F.min("grp").alias("grp"))
    joined = rows.withColumn("text_class", class_of(name[text])).join(heads, "text_class", "left")
    alone = joined.where("grp is null")
    once = joined.where(F.col("grp").isNotNull() & F.col(name[id_col]).eqNullSafe(F.col("class_id"))).dropDuplicates(["grp"])
    return alone.select(*rows.columns).unionByName(once.select(*rows.columns)).toDF(*docs.columns)
