"""Interpolated modified Kneser-Ney models of any order (operator 1).

The longest n-grams are counted as they stand; a shorter one counts the
different words before it, except at the start of a text, where nothing can
stand before it and its own count holds. Counting goes from the longest
n-grams down: the shard that merges the n-grams of a level sends each, once,
to the level below. Files and look-ups are those of the bigram model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foehn.llm import kneser_ney as kn
from foehn.llm.kneser_ney import START, Reader, discounts, narrowed, pair_keys
from foehn.llm.store import stored
from foehn.llm.textvec import Texts, mix, slices
from foehn.session import scratch_path

_U = np.uint64


def grams(texts: Texts, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Columns of words (a token, the one before it, the one before that, ...),
    each token's place in its text, and its text's number. The k-th column
    before a token is meaningful from place k - 1 on, where START stands."""
    tokens, before, text = kn.sequence(texts)
    columns = [tokens, before]
    for _ in range(order - 2):
        columns.append(np.append(_U(0), columns[-1][:-1]))
    starts = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
    place = np.arange(len(text)) - starts[text] if len(text) else text
    return columns, place, text


def context(words: list[np.ndarray]) -> np.ndarray:
    """Hash of the words before a token, the nearest first."""
    out = words[0]
    for w in words[1:]:
        out = mix(out * _U(0x9E3779B97F4A7C15) + w)
    return out


def _member(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    return among[np.minimum(np.searchsorted(among, keys), len(among) - 1)] == keys if len(among) else np.zeros(len(keys), bool)


def _portions(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    held, n = [], 0
    joined = lambda: ([np.concatenate(c) for c in zip(*(h[0] for h in held), strict=True)], np.concatenate([h[1] for h in held]))
    for batch in batches:
        for _, _, texts in slices(batch.column(0)):
            held.append(grams(texts, order)[:2])
            n += len(held[-1][1])
            if n >= kn.HELD_TOKENS:
                yield joined()
                held, n = [], 0
    if held:
        yield joined()


def _sent(words: list[np.ndarray], counts: np.ndarray, hot: np.ndarray, shards: int) -> pa.RecordBatch:
    """Rows of bytes per shard of n-grams that are added up where equal: b1 the
    token, b2 and on the words before it, then the counts."""
    keys = pair_keys(context(words[1:]), words[0], hot) if len(words) > 1 else words[0]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    total = np.add.reduceat(counts[order], first) if len(first) else counts[:0]
    return kn._blobs(keys[first], [*(w[order[first]] for w in words), total.astype(np.int64)], shards).drop_columns("b0")


class Model:
    """What the scoring tasks get: the folder and a few totals of each level."""

    def __init__(self, folder: str, order: int, shards: int, tokens: int, distinct: int):
        self.folder, self.order, self.shards, self.tokens, self.distinct = folder, order, shards, tokens, distinct
        self.hot: list[np.ndarray] = [np.zeros(0, _U)]
        self.hot_stats: list[np.ndarray] = [np.zeros((0, 4), np.int64)] * order
        self.discounts: list[list[float]] = [[0.0] * 4] * order
        self.after, self.rest = 1, 1.0


def train(spark: SparkSession, docs: DataFrame, text: str = "text", order: int = 3) -> Model:
    """Count all texts of docs (null ones are empty) and leave a model of
    ``order`` (2 or more) in the shared folder. Other columns are ignored; no
    rows give a model that knows no word."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    folder = scratch_path(spark, "kneser-ney")
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    n_bytes, n_texts = (int(x or 0) for x in texts.agg(F.sum(F.octet_length("text")), F.count("*")).first())
    most = min(max(1, -(-n_bytes // kn.SHARD_BYTES)), kn.MOST_SHARDS)

    def count_words(batches):
        for columns, _ in _portions(batches, 2):
            yield _sent(columns[:1], np.ones(len(columns[0]), np.int64), np.zeros(0, _U), most)

    def merge_words(table: pa.Table) -> pa.Table:
        keys, counts = kn._summed(kn._joined(table, "b1", _U), kn._joined(table, "b2", np.int64))
        return pa.table({"keys": [keys.tobytes()], "counts": [counts.tobytes()], "tokens": [int(counts.sum())], "n": [len(keys)]})

    words = texts.mapInArrow(count_words, "shard int, b1 binary, b2 binary").groupBy("shard").applyInArrow(merge_words, "keys binary, counts binary, tokens long, n long")
    words = stored(spark, words, "lm-words")
    tokens, distinct = (int(x or 0) for x in words.agg(F.sum("tokens"), F.sum("n")).first())
    shards = int(min(max(1, -(-tokens // kn.SHARD_TOKENS)), kn.MOST_SHARDS))
    often = tokens * min(kn.HOT_SHARE, 1 / shards)
    model = Model(folder, order, shards, tokens, distinct)

    def frequent(batches):
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64)[np.frombuffer(counts, np.int64) > often])], names=["key"])

    hot = np.array([r[0] for r in words.select("keys", "counts").mapInArrow(frequent, "key long").collect()], np.int64).view(_U)
    model.hot.append(np.sort(np.append(hot, START) if n_texts > often else hot))
    for k in range(2, order):  # contexts of k words are frequent only if both their parts of k - 1 words are
        shorter = model.hot[-1]

        def count_contexts(batches):
            for columns, place in _portions(batches, k + 1):
                own = [c[place >= k - 1] for c in columns[1:]]
                both = _member(context(own[:-1]), shorter) & _member(context(own[1:]), shorter)
                keys, n = np.unique(context([c[both] for c in own]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

        counted = texts.mapInArrow(count_contexts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")) if len(shorter) else None
        found = counted.where(F.col("n") > often).collect() if counted is not None else []  # fewer than shards, or than 1 / HOT_SHARE
        model.hot.append(np.sort(np.array([r["key"] for r in found], np.int64).view(_U)))
    hots = list(model.hot)

    def schema(k: int) -> str:
        return "shard int, " + ", ".join(f"b{i} binary" for i in range(1, k + 3))

    below = None  # what the level above sent; a level is stored before the next one is planned
    for k in range(order - 1, 0, -1):

        def count(batches):
            for columns, place in _portions(batches, k + 1):
                own = place >= k - 1 if k == order - 1 else place == k - 1
                yield _sent([c[own] for c in columns], np.ones(int(own.sum()), np.int64), hots[k], shards)

        def merge(table: pa.Table) -> pa.Table:
            shard, hot = table["shard"][0].as_py(), hots[k]
            held, counts = [kn._joined(table, f"b{i}", _U) for i in range(1, k + 2)], kn._joined(table, f"b{k + 2}", np.int64)
            before = context(held[1:])
            keys = pair_keys(before, held[0], hot)
            by = np.argsort(keys, kind="stable")
            keys = keys[by]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            keys, counts, by = keys[first], np.add.reduceat(counts[by], first), by[first]
            held, before = [w[by] for w in held], before[by]
            contexts, number = np.unique(before, return_inverse=True)
            stats = np.stack([np.bincount(number, weights=w, minlength=len(contexts)).astype(np.int64) for w in (counts, counts == 1, counts == 2, counts > 2)], axis=1)
            is_hot = _member(contexts, hot)
            kn._save(folder, f"gram{k}", shard, keys=keys, counts=narrowed(counts))
            kn._save(folder, f"context{k}", shard, keys=contexts[~is_hot], stats=stats[~is_hot])
            sent = _sent(held[:-1], np.ones(len(keys), np.int64), hots[k - 1], shards)
            one = {"hot_keys": contexts[is_hot].view(np.int64), "hot_stats": stats[is_hot].ravel(), "grams": np.array(kn._count_of_counts(counts), np.int64)}
            out = {c: sent.column(c) for c in sent.schema.names}
            # the shard's totals stand on its first row
            return pa.table(out | {c: pa.array([v if i == 0 else [] for i in range(sent.num_rows)], pa.list_(pa.int64())) for c, v in one.items()})

        rows = texts.mapInArrow(count, schema(k))
        rows = rows if below is None else rows.unionByName(below)
        merged = rows.groupBy("shard").applyInArrow(merge, f"{schema(k - 1)}, hot_keys array<long>, hot_stats array<long>, grams array<long>")
        merged = stored(spark, merged, f"lm-level-{k}")
        totals = merged.where(F.size("grams") > 0)
        model.discounts[k] = discounts(*(int(x or 0) for x in totals.agg(*(F.sum(F.col("grams")[i]) for i in range(4))).first()))
        stats = totals.select(F.posexplode("hot_keys").alias("at", "key"), "hot_stats")
        stats = stats.groupBy("key").agg(*(F.sum(F.element_at("hot_stats", F.col("at") * 4 + i)).alias(f"s{i}") for i in range(1, 5)))
        found = {r[0]: list(r[1:]) for r in stats.collect()}  # of the frequent contexts
        model.hot_stats[k] = np.array([found.get(int(x), [0, 0, 0, 0]) for x in hots[k].view(np.int64)], np.int64).reshape(-1, 4)
        below = merged.select(*(c.split()[0] for c in schema(k - 1).split(", ")))

    def spread(batches):
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out = _sent([np.frombuffer(keys, _U)], np.frombuffer(counts, np.int64), np.zeros(0, _U), shards)
                yield out.append_column("kind", pa.array(np.zeros(out.num_rows, np.int32)))

    def merge_model(table: pa.Table) -> pa.Table:
        kind = table["kind"].to_numpy()
        (keys, counts), (followers, seen) = (kn._summed(kn._joined(table.filter(kind == i), "b1", _U), kn._joined(table.filter(kind == i), "b2", np.int64)) for i in (0, 1))
        after = np.zeros(len(keys), np.int64)
        after[np.searchsorted(keys, followers)] = seen
        kn._save(folder, "word", table["shard"][0].as_py(), keys=keys, counts=counts, after=after)
        return pa.table({"totals": [[*kn._count_of_counts(after), int((after > 2).sum()), int(after.sum())]]})

    own = words.select("keys", "counts").mapInArrow(spread, "shard int, b1 binary, b2 binary, kind int")
    both = own.unionByName(below.withColumn("kind", F.lit(1)))
    ends = stored(spark, both.groupBy("shard").applyInArrow(merge_model, "totals array<long>"), "lm-model")
    lower = [int(x or 0) for x in ends.agg(*(F.sum(F.col("totals")[i]) for i in range(6))).first()]
    d = model.discounts[0] = discounts(*lower[:4])
    model.after = max(1, lower[5])
    model.rest = (d[1] * lower[0] + d[2] * lower[1] + d[3] * lower[4]) / model.after if lower[5] else 1.0
    return model


class OrderReader(Reader):
    """Look-ups in the memory-mapped arrays of a model of any order."""

    def log10_probabilities(self, texts: Texts) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, add-one-half unigram score, model score."""
        m = self.model
        columns, place, text = grams(texts, m.order)
        words, number = np.unique(columns[0], return_inverse=True)
        counts, after = self.find("word", words, ["counts", "after"])
        known, base = counts > 0, np.log10((counts + 0.5) / (m.tokens + 0.5 * (m.distinct + 1)))
        d = np.array(m.discounts[0])
        p = (np.maximum(after - d[np.minimum(after, 3)], 0) / m.after + m.rest / (m.distinct + 1))[number]
        for k in range(1, m.order):
            at = np.flatnonzero(place >= k - 1)
            before, hot = context([c[at] for c in columns[1 : k + 1]]), m.hot[k]
            contexts, which = np.unique(before, return_inverse=True)
            (stats,) = self.find(f"context{k}", contexts, ["stats"])
            hit = _member(contexts, hot)
            stats[hit] = m.hot_stats[k][np.searchsorted(hot, contexts[hit])]
            keys, gram = np.unique(pair_keys(before, columns[0][at], hot), return_inverse=True)
            (seen,) = self.find(f"gram{k}", keys, ["counts"])
            d, total = np.array(m.discounts[k]), np.maximum(stats[:, 0], 1)
            share, seen = (stats[:, 1:] @ d[1:] / total)[which], seen[gram]
            here = np.maximum(seen - d[np.minimum(seen, 3)], 0) / total[which] + share * p[at]
            p[at] = np.where(stats[which, 0] > 0, here, p[at])
        n = len(texts)
        sums = lambda w: np.bincount(text, weights=w, minlength=n)
        return np.bincount(text, minlength=n), sums(known[number]).astype(np.int64), sums(base[number]), sums(np.log10(p))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id_col with n_tokens, n_known, train_tokens, base_score, score and
    perplexity of every whole text; null texts are empty, ids may be null or
    repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = OrderReader(model)
        for batch in batches:
            out = [reader.log10_probabilities(texts) for _, _, texts in slices(batch.column(1))]
            if out:
                columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n_tokens", "n_known", "base_score", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    scored = rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")
    )
