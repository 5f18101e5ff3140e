"""Quality scores from Naive Bayes support vectors (operator 11).

Features are indicators of a text's n-grams, hashed to 2**BITS indices: words
and punctuation runs, pairs of them, and two n-grams that hold whatever word
is said twice or three times in a row. Each indicator is scaled by its class
log-count ratio and a text's vector is brought to length 1; a linear model
with hinge loss is fitted by dual coordinate descent. Margins become
probabilities by a logistic curve fitted on margins of rows that their model
has not seen.

The model is learned from a sample of at most SAMPLE labelled rows: features
in parallel, the fit in one task. It is 2**BITS ratios and weights, which go
to every worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foehn.llm.longtext import pieces
from foehn.llm.store import numbered, stored
from foehn.llm.textvec import ALNUM, SLICE_BYTES, SPACE, Texts, Words, mix, slices

BITS = 20
#: Most labelled rows to learn from, chosen by hash of their id.
SAMPLE = 24_000
#: Added to each count of an n-gram in a class; most passes over the rows;
#: weight of a row's hinge loss, and the change of a row's weight at which the
#: passes end.
SMOOTHING, EPOCHS, COST, SETTLED = 1.0, 12, 1.0, 1e-3
THRESHOLD = 0.3

_U = np.uint64
PUNCTUATION = np.array([0x21 <= b < 0x7F and not chr(b).isalnum() and b != 0x5F for b in range(256)])
#: Fixed indices of a word said twice and three times in a row.
TWICE, THRICE = 0, 1


def _ngrams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature index) of every n-gram occurrence."""
    words, marks = texts.words(ALNUM, fold=False), texts.words(PUNCTUATION, fold=False)
    order = np.argsort(np.concatenate((words.start, marks.start)), kind="stable")
    h = np.concatenate((words.hashes, marks.hashes))[order]
    text = np.concatenate((words.text_of(), marks.text_of()))[order]
    same = text[1:] == text[:-1]
    hashes = np.concatenate((mix(h ^ _U(0x5851F42D4C957F2D)), mix(h[:-1][same] * _U(0x14057B7EF767814F) + h[1:][same])))
    index = (hashes >> _U(64 - BITS)).astype(np.int64)
    spoken: Words = texts.words(SPACE, fold=False)
    h, of = spoken.hashes, spoken.text_of()
    twice = (of[1:] == of[:-1]) & (h[1:] == h[:-1])
    thrice = twice[1:] & twice[:-1]
    repeats = np.repeat((TWICE, THRICE), (twice.sum(), thrice.sum()))
    return np.concatenate((text, text[1:][same], of[1:][twice], of[2:][thrice])), np.concatenate((index, repeats))


def features(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per slice of the column (feature indices of its texts in order, where
    each text's begin); every feature once a text. A text beyond
    ``slice_bytes`` is read in pieces that overlap by three words, so memory
    grows with its features only."""
    for _, _, texts in slices(column, slice_bytes):
        if len(texts) == 1:
            found = np.zeros(0, np.int64)
            for lo, hi in pieces(texts.buf, slice_bytes, back=3):
                found = np.union1d(found, _ngrams(Texts(texts.buf[lo:hi], np.array([0, hi - lo])))[1])
            yield found, np.array([0, len(found)])
        else:
            owner, index = _ngrams(texts)
            pairs = np.unique((owner << BITS) | index)
            yield pairs & ((1 << BITS) - 1), np.searchsorted(pairs >> BITS, np.arange(len(texts) + 1))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Per feature the log of its share of the class 1 counts over its share
    of the class 0 counts."""
    share = []
    for label in (1, 0):
        own = [r for r, y in zip(rows, labels, strict=True) if y == label]
        count = smoothing + np.bincount(np.concatenate(own), minlength=1 << BITS)
        share.append(count / count.sum())
    return np.log(share[0] / share[1])


def scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Values of a text's features: ratios, brought to length 1."""
    values = ratios[row]
    length = np.sqrt(values @ values)
    return values / length if length else values


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """(weights, intercept) of the linear model of least hinge loss, by dual
    coordinate descent: one row's dual weight at a time takes its best value
    in [0, its cost]. Rows of the rarer class cost more, so that both classes
    weigh alike. Row order is fixed by seed."""
    w, bias, dual = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    positive = int(labels.sum())
    costs = np.where(labels == 1, max(1.0, (len(rows) - positive) / positive), max(1.0, positive / (len(rows) - positive))) * cost
    order = np.random.default_rng(0)
    for _ in range(epochs):
        most = 0.0
        for i in order.permutation(len(rows)):
            row, sign = rows[i], 1.0 if labels[i] else -1.0
            x = scaled(row, ratios)
            gradient = sign * (w[row] @ x + bias) - 1
            curvature = float(x @ x) + 1.0  # the intercept is a feature of value 1
            to = min(max(dual[i] - gradient / curvature, 0.0), costs[i])
            step = to - dual[i]
            if step:
                w[row] += step * sign * x
                bias += step * sign
                dual[i] = to
                most = max(most, abs(step))
        if most < SETTLED:
            break
    return w, bias


def logistic_curve(margins: np.ndarray, labels: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """(slope, offset) of the probability 1 / (1 + exp(-slope * margin - offset))
    of label 1, by Newton steps with halving, towards targets that leave room
    for classes that margins tell apart without error."""
    n1 = int(labels.sum())
    n0 = len(labels) - n1
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))

    def loss(a, b):
        z = a * margins + b
        return float(np.sum(np.logaddexp(0, z) - target * z))

    a, b, now = 0.0, float(np.log((n1 + 1) / (n0 + 1))), None
    now = loss(a, b)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        d, h = p - target, np.maximum(p * (1 - p), 1e-12)
        g = np.array([d @ margins, d.sum()])
        hess = np.array([[h @ (margins * margins) + 1e-9, h @ margins], [h @ margins, h.sum() + 1e-9]])
        move, size = np.linalg.solve(hess, g), 1.0
        while size > 1e-8 and loss(a - size * move[0], b - size * move[1]) > now:
            size /= 2
        if size <= 1e-8 or np.abs(move).max() * size < 1e-10:
            break
        a, b = a - size * move[0], b - size * move[1]
        now = loss(a, b)
    return a, b


@dataclass
class Model:
    """Ratios and weights of all features, the intercept and the curve."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, index: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 of texts given as ``features`` gives them."""
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        value = self.ratios[index].astype(np.float64)
        length = np.sqrt(np.bincount(text, weights=value * value, minlength=len(first) - 1))
        total = np.bincount(text, weights=value * self.weights[index], minlength=len(first) - 1)
        margin = np.divide(total, length, out=np.zeros_like(total), where=length > 0) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -35, 35)))


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> Model | None:
    """The model of rows (each its distinct features) with labels 0 and 1;
    None where all labels are alike. The curve is fitted on two halves of the
    rows, each with the margins of a model of the other half."""
    if labels.min(initial=1) == labels.max(initial=0) or not len(rows):
        return None
    half, margins = np.arange(len(rows)) % 2, np.zeros(len(rows))
    whole = log_count_ratios(rows, labels)
    ready = True
    for h in (0, 1):
        own, other = np.flatnonzero(half == h), np.flatnonzero(half != h)
        if len(set(labels[own].tolist())) < 2:
            ready = False
            break
        learned = [rows[i] for i in own]
        ratios = log_count_ratios(learned, labels[own])
        w, bias = dual_descent(learned, labels[own], ratios, cost, epochs)
        margins[other] = [w[rows[i]] @ scaled(rows[i], ratios) + bias for i in other]
    w, bias = dual_descent(rows, labels, whole, cost, epochs)
    if not ready:  # too few rows to hold some out
        margins = np.array([w[r] @ scaled(r, whole) + bias for r in rows])
    return Model(whole.astype(np.float32), w.astype(np.float32), bias, *logistic_curve(margins, labels))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cost: float = COST, epochs: int = EPOCHS) -> Model | None:
    """The model learned from docs (doc_id, text) with labels (doc_id, label
    0 or 1). Of repeated labels of an id the highest holds, of repeated docs
    the smallest text; null ids and labels are left out. None without labels
    of both kinds."""
    marked = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    marked = stored(spark, marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "quality-labels")
    # at most ``sample`` rows of an id and a label are broadcast
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(marked), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [index[first[i] : first[i + 1]].astype(np.int32) for index, first in features(batch.column(2)) for i in range(len(first) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int32()), pa.array([x.tobytes() for x in lists], pa.binary())], names=["doc_id", "label", "features"])

    kind = dict(rows.dtypes)["doc_id"]
    found = stored(spark, rows.mapInArrow(extract, f"doc_id {kind}, label int, features binary"), "quality-features")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, label = [], []
        for batch in batches:
            own += [np.frombuffer(x, np.int32) for x in batch.column(0).to_pylist()]
            label += batch.column(1).to_pylist()
        model = fit(own, np.array(label, np.int64), cost, epochs)
        if model:
            parts = [[model.ratios.tobytes()], [model.weights.tobytes()], [model.bias], [model.slope], [model.offset]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts], names=["ratios", "weights", "bias", "slope", "offset"])

    by_hash = found.select("features", "label", F.xxhash64("doc_id", F.lit(5)).alias("at")).repartition(1).sortWithinPartitions("at", "label", "features")
    learned = stored(spark, by_hash.select("features", "label").mapInArrow(learn, "ratios binary, weights binary, bias double, slope double, offset double"), "quality-model").first()
    if learned is None:
        return None
    return Model(np.frombuffer(learned["ratios"], np.float32), np.frombuffer(learned["weights"], np.float32), learned["bias"], learned["slope"], learned["offset"])


def score(spark: SparkSession, docs: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id_col (or ``keep``) with ``score``: the probability of label 1 for the
    whole text, 0.5 without a model. Null texts score as empty ones."""
    keep = [id_col] if keep is None else keep
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            if own is None:
                scores = np.full(batch.num_rows, 0.5)
            else:
                scores = np.concatenate([own.score(*part) for part in features(batch.column(batch.num_columns - 1))] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*batch.schema.names[:-1], "_score"])

    kinds = dict(docs.dtypes)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    return rows.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", _score double").withColumnRenamed("_score", "score")


def held_out(column: str = "doc_id", parts: int = 5) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo parts; null ids don't."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts == 0, F.lit(False))


def _learned(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> Model | None:
    known = labels.where(~held_out()).select("doc_id", F.col("quality").alias("label"))
    return train(spark, docs.where(~held_out()), known, **options)


def quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of all docs, learned from the
    labels (doc_id, quality) of ids that are not held out. Only texts are
    scored; ids, labels, sources and languages are never inputs. Rows of null
    id are scored and not learned from; repeated rows score alike; no docs, no
    rows. Without labels of both kinds all scores are 0.5."""
    scored = score(spark, docs, _learned(spark, docs, labels, **options))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_junk(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of docs, with all their columns, that score at least threshold."""
    model = _learned(spark, docs, labels, **options)
    rows, name = numbered(docs)
    return score(spark, rows, model, text=name["text"], keep=rows.columns).where(F.col("score") >= threshold).drop("score").toDF(*docs.columns)
