"""Toxicity scores from FTRL-proximal logistic regression (operator 6).

Features are the distinct word unigrams, bigrams and one-word skip-grams of a
text, hashed to 2**BITS indices. FTRL with per-coordinate rates and L1
regularisation learns from a sample of at most SAMPLE labelled rows, in SHARDS
tasks whose weights are averaged. What L1 leaves, at most 2**BITS numbers,
goes to every worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foehn.llm.store import numbered, releasing, stored
from foehn.llm.textvec import ALNUM, Texts, mix, slices

BITS = 20
#: Most labelled rows to learn from, chosen by hash of their id.
SAMPLE = 24_000
SHARDS, EPOCHS = 1, 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 20.0, 0.1
#: Rows of label 1 count as if they were this share of a shard's rows.
BALANCE = 0.5
THRESHOLD = 0.7

_U = np.uint64
#: Index of the intercept, beyond the hashed ones.
INTERCEPT = 1 << BITS


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature index) of every n-gram occurrence."""
    words = texts.words(ALNUM)
    h, text = words.hashes, words.text_of()
    found, owner = [mix(h ^ _U(0x5851F42D4C957F2D))], [text]
    for gap, salt in ((1, _U(0x14057B7EF767814F)), (2, _U(0x2545F4914F6CDD1D))):
        same = text[gap:] == text[:-gap]
        found.append(mix(h[:-gap][same] * salt + h[gap:][same]))
        owner.append(text[gap:][same])
    index = (np.concatenate(found) >> _U(64 - BITS)).astype(np.int64)
    return np.concatenate(owner), index


def ftrl(rows: list[np.ndarray], labels: list[int], epochs: int) -> dict[int, float]:
    """Weights of one shard; each row is its distinct feature indices. Labels
    of one kind only tell nothing apart and give no weights."""
    z, n = np.zeros(INTERCEPT + 1), np.zeros(INTERCEPT + 1)

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - np.where(at == INTERCEPT, 0.0, L1), 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    positive = sum(labels)
    if positive in (0, len(labels)):
        return {}
    balance = max(1.0, BALANCE / (1 - BALANCE) * (len(labels) - positive) / positive)
    for _ in range(epochs):
        for at, label in zip(rows, labels, strict=True):
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            gradient *= balance if label else 1.0
            root = np.sqrt(n[at])
            n[at] += gradient * gradient
            z[at] += gradient - (np.sqrt(n[at]) - root) / ALPHA * w
    every = np.arange(INTERCEPT + 1)
    w = weights(every)
    return {int(i): float(w[i]) for i in np.flatnonzero(w)}


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, shards: int = SHARDS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(indices, weights) learned from docs (doc_id, text) with labels (doc_id,
    label 0 or 1). Of repeated labels of an id the highest holds; null ids and
    labels are left out. Without labels of both kinds there are no weights: all
    scores are 0.5."""
    marked = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    marked = stored(spark, marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labels")
    rows = marked.join(docs.select("doc_id", "text"), "doc_id")
    rows = rows.select(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(shards)).alias("shard"), F.xxhash64("doc_id", F.lit(4)).alias("at"), "label", F.lower("text").alias("text"))
    rows = rows.repartition(shards, "shard").sortWithinPartitions("shard", "at", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_rows: dict[int, tuple[list, list]] = {}
        for batch in batches:
            shard, label = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for row, _, texts in slices(batch.column(3)):
                text, index = features(texts)
                pairs = np.unique((text << (BITS + 1)) | index)
                ends = np.searchsorted(pairs >> (BITS + 1), np.arange(len(texts) + 1))
                for i in range(len(texts)):
                    own = shard_rows.setdefault(shard[row + i], ([], []))
                    own[0].append(np.append(pairs[ends[i] : ends[i + 1]] & ((1 << (BITS + 1)) - 1), INTERCEPT).astype(np.int32))
                    own[1].append(int(label[row + i]))
        for own in shard_rows.values():
            w = ftrl(*own, epochs)
            yield pa.RecordBatch.from_arrays([pa.array(list(w), pa.int64()), pa.array(list(w.values()), pa.float64()), pa.array([len(own[1])] * len(w), pa.int64())], names=["index", "weight", "n"])

    learned = stored(spark, rows.mapInArrow(releasing(run), "index long, weight double, n long"), "ftrl")
    total = learned.where(F.col("index") == INTERCEPT).agg(F.sum("n")).first()[0] or 0
    if not total:
        return np.zeros(0, np.int64), np.zeros(0)
    mean = learned.groupBy("index").agg((F.sum(F.col("weight") * F.col("n")) / total).alias("weight")).toPandas().sort_values("index")
    return mean["index"].to_numpy(), mean["weight"].to_numpy()


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id_col (and ``keep``) with ``score``: the probability of label 1 for the
    whole text. Null texts score as empty ones."""
    keep = [id_col] if keep is None else keep
    indices, weights = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(INTERCEPT + 1, np.float32)
        table[indices] = weights
        for batch in batches:
            out = []
            for _, _, texts in slices(batch.column(batch.num_columns - 1)):
                owner, index = features(texts)
                some = np.flatnonzero(table[index])
                pairs = np.unique((owner[some] << (BITS + 1)) | index[some])
                total = np.bincount(pairs >> (BITS + 1), weights=table[pairs & ((1 << (BITS + 1)) - 1)], minlength=len(texts))
                out.append(1 / (1 + np.exp(-np.clip(total + table[INTERCEPT], -35, 35))))
            scores = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*batch.schema.names[:-1], "_score"])

    kinds = dict(docs.dtypes)
    rows = docs.select(*keep, F.lower(F.col(text)).alias("_text"))
    scored = rows.mapInArrow(releasing(run), ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", _score double")
    return scored.withColumnRenamed("_score", "score")


def held_out(column: str, parts: int):
    """Whether crc32 of the id as text leaves 1 modulo parts; null ids don't."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts == 1, F.lit(False))


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted): learned from the labels (doc_id,
    toxic) of ids that are not held out, for all docs. Only texts are scored;
    ids, labels, sources and languages are never inputs. Rows with null ids
    are scored and not learned from; repeated rows score alike."""
    known = labels.where(~held_out("doc_id", 3)).select("doc_id", F.col("toxic").alias("label"))
    model = train(spark, docs.where(~held_out("doc_id", 3)), known, **options)
    scored = score(docs, model)
    return scored.select("doc_id", held_out("doc_id", 3).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of docs that score below threshold. Null texts score like
    empty ones; null and repeated ids are ordinary, each row is judged by its
    text. Without labels of both kinds all rows stay; no rows give none. Extra
    columns are carried."""
    known = labels.where(~held_out("doc_id", 3)).select("doc_id", F.col("toxic").alias("label"))
    model = train(spark, docs.where(~held_out("doc_id", 3)), known, **options)
    rows, name = numbered(docs)
    return score(rows, model, text=name["text"], keep=rows.columns).where(F.col("score") < threshold).drop("score").toDF(*docs.columns)
