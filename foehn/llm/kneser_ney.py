"""Interpolated modified Kneser-Ney bigram model (operator 1).

Words and word pairs are 64-bit hashes. Map tasks count them in sorted arrays;
the arrays are shuffled in shards by the leading bits of the key (for pairs:
of the first word's hash, or, after a word so frequent that its pairs would
fill a shard, of the pair's) and merged there. Every shard leaves sorted hash
arrays in the shared folder; scoring tasks map them into memory and look up
the sorted distinct hashes of a slice of text at a time.

The folder named in spark.checkpoint.dir must be mounted where tasks run, as
memory-mapped files have to be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foehn.llm.store import NewFile, filesystem, stored
from foehn.llm.textvec import SPACE, Texts, mix, slices
from foehn.session import scratch_path

_U = np.uint64
#: Hashes that stand for the start and the end of a text.
START, END = _U(0x243F6A8885A308D3), _U(0x13198A2E03707344)

#: Tokens counted together before their counts are sent off, tokens per shard
#: of pairs and bytes of text per shard of words.
HELD_TOKENS, SHARD_TOKENS, SHARD_BYTES = 2_000_000, 1_500_000, 8 << 20
#: Shards are told apart by 16 bits.
MOST_SHARDS = 1 << 16

#: A word with more than this share of all tokens, or with a shard's worth of
#: them, has its pairs spread over all shards; there are fewer such words than
#: shards, or than 1 / HOT_SHARE. START, once in every text, is such a word too.
HOT_SHARE = 0.001


def sequence(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, token before it, text number) of all tokens: a text's words and
    one end; START stands before the first."""
    words = texts.words(SPACE)
    counts = words.counts()
    ends = np.cumsum(counts + 1) - 1
    tokens = np.empty(len(words) + len(texts), _U)
    tokens[ends] = END
    is_word = np.ones(len(tokens), bool)
    is_word[ends] = False
    tokens[is_word] = words.hashes
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[ends - counts] = START
    return tokens, before, np.repeat(np.arange(len(texts)), counts + 1)


def pair_keys(before: np.ndarray, tokens: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Keys of word pairs: 48 bits of the pair's hash below 16 that place it in
    a shard, those of the first word unless that is hot."""
    pair = mix(before * _U(0x9E3779B97F4A7C15) + tokens)
    top = before
    if len(hot):
        top = np.where(hot[np.minimum(np.searchsorted(hot, before), len(hot) - 1)] == before, pair, before)
    return (top & _U(0xFFFF000000000000)) | (pair & _U(0x0000FFFFFFFFFFFF))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> _U(48)) * _U(shards)) >> _U(16)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts added up."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _blobs(keys: np.ndarray, columns: list[np.ndarray], shards: int) -> pa.RecordBatch:
    """Sorted keys with their columns as one row of bytes per shard."""
    shard = shard_of(keys, shards)
    cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=_U))
    some = np.flatnonzero(np.diff(cuts))
    data = [[c[cuts[s] : cuts[s + 1]].tobytes() for s in some] for c in (keys, *columns)]
    return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(d, pa.binary()) for d in data)], names=["shard", *(f"b{i}" for i in range(len(data)))])


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in table[name].to_pylist()] or [np.zeros(0, kind)])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and the ones before them, in portions of about HELD_TOKENS."""
    held, n = [], 0
    for batch in batches:
        for _, _, texts in slices(batch.column(0)):
            tokens, before, _ = sequence(texts)
            held.append((tokens, before))
            n += len(tokens)
            if n >= HELD_TOKENS:
                yield np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
                held, n = [], 0
    if held:
        yield np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])


def _save(folder: str, name: str, shard: int, **arrays: np.ndarray) -> None:
    for part, array in arrays.items():
        with NewFile(f"{folder}/{name}-{part}-{shard:05d}.npy") as out:
            np.lib.format.write_array(out, np.ascontiguousarray(array), allow_pickle=False)


def narrowed(counts: np.ndarray) -> np.ndarray:
    """Counts in 32 bits where all of them fit, else in 64."""
    return counts.astype(np.uint32) if not len(counts) or counts.max() < 1 << 32 else counts


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What is taken from counts of 0, 1, 2 and more: modified Kneser-Ney, or
    halves of the counts where counts of counts are missing."""
    if not (n1 and n2 and n3 and n4):
        return [0.0, 0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    return [0.0, *(min(max(k - (k + 1) * y * b / a, 0.0), k) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))]


class Model:
    """What the scoring tasks get: the folder and a few totals."""

    def __init__(self, folder: str, shards: int, tokens: int, distinct: int, hot: np.ndarray, hot_stats: np.ndarray, pairs: list[int], lower: list[int]):
        self.folder, self.shards, self.tokens, self.distinct = folder, shards, tokens, distinct
        self.hot, self.hot_stats = hot, hot_stats
        self.d_pair, self.d_word = discounts(*pairs[:4]), discounts(*lower[:4])
        # lower: words seen after 1, 2, 3, 4 different words, after 3 or more, and the sum of all
        self.after = max(1, lower[5])
        self.rest = (self.d_word[1] * lower[0] + self.d_word[2] * lower[1] + self.d_word[3] * lower[4]) / self.after if lower[5] else 1.0


def train(spark: SparkSession, docs: DataFrame, text: str = "text") -> Model:
    """Count all texts of docs and leave the model in the shared folder."""
    folder = scratch_path(spark, "kneser-ney")
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    n_bytes, n_texts = (int(x or 0) for x in texts.agg(F.sum(F.octet_length("text")), F.count("*")).first())
    most = min(max(1, -(-n_bytes // SHARD_BYTES)), MOST_SHARDS)

    def count_words(batches):
        for tokens, _ in _tokens(batches):
            keys, counts = np.unique(tokens, return_counts=True)
            yield _blobs(keys, [counts.astype(np.uint32)], most)

    def merge_words(table: pa.Table) -> pa.Table:
        keys, counts = _summed(_joined(table, "b0", _U), _joined(table, "b1", np.uint32).astype(np.int64))
        return pa.table({"keys": [keys.tobytes()], "counts": [counts.tobytes()], "tokens": [int(counts.sum())], "n": [len(keys)]})

    words = texts.mapInArrow(count_words, "shard int, b0 binary, b1 binary").groupBy("shard").applyInArrow(merge_words, "keys binary, counts binary, tokens long, n long")
    words = stored(spark, words, "lm-words")
    tokens, distinct = (int(x or 0) for x in words.agg(F.sum("tokens"), F.sum("n")).first())
    shards = int(min(max(1, -(-tokens // SHARD_TOKENS)), MOST_SHARDS))
    often = tokens * min(HOT_SHARE, 1 / shards)

    def frequent(batches):
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64)[np.frombuffer(counts, np.int64) > often])], names=["key"])

    hot = words.select("keys", "counts").mapInArrow(frequent, "key long").collect()  # fewer than shards, or than 1 / HOT_SHARE
    hot = np.array([r[0] for r in hot], np.int64).view(_U)
    hot = np.sort(np.append(hot, START) if n_texts > often else hot)

    def count_pairs(batches):
        for tokens_, before in _tokens(batches):
            _, first, counts = np.unique(mix(before * _U(0x9E3779B97F4A7C15) + tokens_), return_index=True, return_counts=True)
            before, tokens_ = before[first], tokens_[first]
            keys = pair_keys(before, tokens_, hot)
            order = np.argsort(keys)
            sent = _blobs(keys[order], [before[order], tokens_[order], counts[order].astype(np.uint32)], shards)
            yield sent.drop_columns("b0")  # the keys follow from the words

    def merge_pairs(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        before, after, counts = _joined(table, "b1", _U), _joined(table, "b2", _U), _joined(table, "b3", np.uint32).astype(np.int64)
        keys = pair_keys(before, after, hot)
        order = np.argsort(keys, kind="stable")
        keys, before, after, counts = keys[order], before[order], after[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, before, after, counts = keys[first], before[first], after[first], np.add.reduceat(counts, first)
        del order
        context, number = np.unique(before, return_inverse=True)
        stats = np.stack([np.bincount(number, weights=w, minlength=len(context)).astype(np.int64) for w in (counts, counts == 1, counts == 2, counts > 2)], axis=1)
        is_hot = np.isin(context, hot)
        _save(folder, "pair", shard, keys=keys, counts=narrowed(counts))
        _save(folder, "context", shard, keys=context[~is_hot], stats=stats[~is_hot])
        words_, seen = np.unique(after, return_counts=True)
        blobs = _blobs(words_, [seen.astype(np.uint32)], shards)
        one = {"hot_keys": context[is_hot].view(np.int64), "hot_stats": stats[is_hot].ravel(), "pairs": np.array(_count_of_counts(counts), np.int64)}
        out = {c: blobs.column(c) for c in blobs.schema.names}
        # the shard's totals stand on its first row
        return pa.table(out | {c: pa.array([v if i == 0 else [] for i in range(blobs.num_rows)], pa.list_(pa.int64())) for c, v in one.items()})

    pairs = texts.mapInArrow(count_pairs, "shard int, b1 binary, b2 binary, b3 binary").groupBy("shard").applyInArrow(
        merge_pairs, "shard int, b0 binary, b1 binary, hot_keys array<long>, hot_stats array<long>, pairs array<long>"
    )
    pairs = stored(spark, pairs, "lm-after")
    totals = pairs.where(F.size("pairs") > 0)
    n_pairs = [int(x or 0) for x in totals.agg(*(F.sum(F.col("pairs")[i]) for i in range(4))).first()]
    stats = totals.select(F.posexplode("hot_keys").alias("at", "key"), "hot_stats")
    stats = stats.groupBy("key").agg(*(F.sum(F.element_at("hot_stats", F.col("at") * 4 + i)).alias(f"s{i}") for i in range(1, 5)))
    hot_stats = {r[0]: list(r[1:]) for r in stats.collect()}
    hot_table = np.array([hot_stats.get(int(k), [0, 0, 0, 0]) for k in hot.view(np.int64)], np.int64).reshape(-1, 4)

    # per word: its own count and how many different words it follows
    def spread(batches):
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out = _blobs(np.frombuffer(keys, _U), [np.frombuffer(counts, np.int64)], shards)
                yield out.append_column("kind", pa.array(np.zeros(out.num_rows, np.int32)))

    own = words.select("keys", "counts").mapInArrow(spread, "shard int, b0 binary, b1 binary, kind int")

    def merge_model(table: pa.Table) -> pa.Table:
        kind = table["kind"].to_numpy()
        keys, counts = _summed(_joined(table.filter(kind == 0), "b0", _U), _joined(table.filter(kind == 0), "b1", np.int64))
        followers, seen = _summed(_joined(table.filter(kind == 1), "b0", _U), _joined(table.filter(kind == 1), "b1", np.uint32).astype(np.int64))
        after = np.zeros(len(keys), np.int64)
        after[np.searchsorted(keys, followers)] = seen
        _save(folder, "word", table["shard"][0].as_py(), keys=keys, counts=counts, after=after)
        return pa.table({"totals": [[*_count_of_counts(after), int((after > 2).sum()), int(after.sum())]]})

    both = own.unionByName(pairs.select("shard", "b0", "b1", F.lit(1).alias("kind")))
    merged = stored(spark, both.groupBy("shard").applyInArrow(merge_model, "totals array<long>"), "lm-model")
    lower = [int(x or 0) for x in merged.agg(*(F.sum(F.col("totals")[i]) for i in range(6))).first()]
    return Model(folder, shards, tokens, distinct, hot, hot_table, n_pairs, lower)


class Reader:
    """Look-ups in the memory-mapped arrays of a model."""

    def __init__(self, model: Model):
        self.model, self.arrays = model, {}

    def _array(self, name: str, shard: int) -> np.ndarray | None:
        if (name, shard) not in self.arrays:
            fs, path = filesystem(f"{self.model.folder}/{name}-{shard:05d}.npy")
            if fs.type_name != "local":
                raise ValueError("memory-mapped model files need a shared folder that is mounted on the workers")
            there = fs.get_file_info(path)
            # an empty array can't be mapped; a shard without keys leaves no file
            self.arrays[name, shard] = np.load(path, mmap_mode="r" if there.size > 128 else None) if there.is_file else None
        return self.arrays[name, shard]

    def find(self, name: str, keys: np.ndarray, parts: list[str]) -> list[np.ndarray]:
        """Values of sorted distinct keys; 0 where there is none."""
        shard = shard_of(keys, self.model.shards)
        cuts = np.searchsorted(shard, np.arange(self.model.shards + 1, dtype=_U))
        out = [None] * len(parts)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            there = self._array(f"{name}-keys", s)
            if there is None or not len(there):
                continue
            own = keys[cuts[s] : cuts[s + 1]]
            at = np.minimum(np.searchsorted(there, own), len(there) - 1)
            hit = np.flatnonzero(there[at] == own)
            for i, part in enumerate(parts):
                values = self._array(f"{name}-{part}", s)
                if out[i] is None:
                    out[i] = np.zeros((len(keys), *values.shape[1:]), np.int64)
                out[i][cuts[s] + hit] = values[at[hit]]
        shapes = {"stats": (len(keys), 4)}
        return [np.zeros(shapes.get(p, (len(keys),)), np.int64) if o is None else o for o, p in zip(out, parts, strict=True)]

    def log10_probabilities(self, texts: Texts) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, add-one-half unigram score, model score."""
        m = self.model
        tokens, before, text = sequence(texts)
        words, number = np.unique(np.append(tokens, START), return_inverse=True)
        counts, after = self.find("word", words, ["counts", "after"])
        (stats,) = self.find("context", words, ["stats"])
        if len(m.hot):
            at = np.minimum(np.searchsorted(m.hot, words), len(m.hot) - 1)
            hit = m.hot[at] == words
            stats[hit] = m.hot_stats[at[hit]]
        known, base = counts > 0, np.log10((counts + 0.5) / (m.tokens + 0.5 * (m.distinct + 1)))
        d = np.array(m.d_word)
        lower = np.maximum(after - d[np.minimum(after, 3)], 0) / m.after + m.rest / (m.distinct + 1)

        keys = pair_keys(before, tokens, m.hot)
        pairs, first, pair = np.unique(keys, return_index=True, return_inverse=True)
        (seen,) = self.find("pair", pairs, ["counts"])
        token_no = number[:-1]
        before_no = np.append(number[-1], token_no[:-1])
        before_no[np.flatnonzero(before == START)] = number[-1]
        context, low = stats[before_no[first]], lower[token_no[first]]
        total = np.maximum(context[:, 0], 1)
        d = np.array(m.d_pair)
        share = context[:, 1:] @ d[1:] / total
        p = np.where(context[:, 0] > 0, np.maximum(seen - d[np.minimum(seen, 3)], 0) / total + share * low, low)
        n = len(texts)
        sums = lambda w: np.bincount(text, weights=w, minlength=n)
        return np.bincount(text, minlength=n), sums(known[token_no]).astype(np.int64), sums(base[token_no]), sums(np.log10(p)[pair])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id_col (and ``keep``) with n_tokens, n_known, train_tokens, base_score,
    score and perplexity of every whole text; null texts are empty."""
    keep = [id_col] if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            out = [reader.log10_probabilities(texts) for _, _, texts in slices(batch.column(batch.num_columns - 1))]
            if out:
                columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], "n_tokens", "n_known", "base_score", "score"])

    kinds = dict(docs.dtypes)
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    scored = rows.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        *keep, "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")
    )
