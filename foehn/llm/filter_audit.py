"""Audit of how quality filters interact (operator 12).

A table-driven transducer reads the bytes of each text once: a byte's class
and the state before it give the next state and the events it emits (a word
begins, a word ends, a capital, a code point, a symbol). Every class of this
machine leads to one state from wherever it came, so the states of a whole
slice are one table lookup, shifted by a byte. Word spans go into a hash table
whose hits are verified byte by byte, which counts distinct words exactly.

What each text fails becomes a set of letters; counts of texts by part and
set, at most 128 rows a part, hold all that every order of the filters does.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foehn.llm.longtext import pieces
from foehn.llm.store import stored
from foehn.llm.textvec import SLICE_BYTES, mix, slices

_U = np.uint64

# The machine. Classes of bytes; NEXT[class] is the state after a byte of the
# class, whatever the state before; EVENTS[state][class] is what it emits.
GAP, CAPITAL, SYMBOL, PLAIN, LEAD, CONTINUATION = range(6)
BETWEEN, INSIDE = range(2)
BEGINS, ENDS, IS_CAPITAL, IS_POINT, IS_SYMBOL = (1 << i for i in range(5))


def _class_of(byte: int) -> int:
    if byte == 0x20 or 0x09 <= byte <= 0x0D:
        return GAP
    if 0x41 <= byte <= 0x5A:
        return CAPITAL
    if chr(byte) in "#$%&*|":
        return SYMBOL
    return PLAIN if byte < 0x80 else CONTINUATION if byte < 0xC0 else LEAD


CLASS = np.array([_class_of(b) for b in range(256)], np.uint8)
NEXT = np.array([BETWEEN if c == GAP else INSIDE for c in range(6)], np.uint8)


def _events(state: int, kind: int) -> int:
    word = (BEGINS if state == BETWEEN and kind != GAP else 0) | (ENDS if state == INSIDE and kind == GAP else 0)
    of_kind = {CAPITAL: IS_CAPITAL, SYMBOL: IS_SYMBOL}.get(kind, 0)
    return word | of_kind | (0 if kind == CONTINUATION else IS_POINT)


EVENTS = np.array([[_events(s, c) for c in range(6)] for s in (BETWEEN, INSIDE)], np.uint8)

#: A span up to this long is hashed and compared by 8 bytes at once for all
#: words together, a longer one by itself.
SHORT = 64
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], _U)


class WordTable:
    """Open-addressing hash table of the distinct words of the texts of one
    slice. It holds spans; a hit counts only if text and bytes are equal."""

    def __init__(self, buf: np.ndarray):
        self.buf = buf
        padded = np.concatenate((buf, np.zeros(8, np.uint8)))
        self.eight = np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,))  # the 8 bytes from each place on
        self.start, self.length, self.text = (np.zeros(0, np.int64) for _ in range(3))
        self.hash = np.zeros(0, _U)

    def insert(self, start: np.ndarray, end: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Whether each span is the first of its word in its text."""
        heads = len(self.start)
        length = end - start
        hashes = self._hash(start, length, text)
        self.start, self.length, self.text, self.hash = (np.concatenate(x) for x in ((self.start, start), (self.length, length), (self.text, text), (self.hash, hashes)))
        size = 1 << max(4, int(2 * len(self.start)).bit_length())
        slots, wrap = np.full(size, -1, np.int64), _U(size - 1)
        new = np.zeros(len(self.start), bool)
        # earlier words first, so that they keep their places as heads
        for pending in (np.arange(heads), np.arange(heads, len(self.start))):
            slot = (self.hash[pending] & wrap).astype(np.int64)
            while len(pending):
                free = slots[slot] < 0
                slots[slot[free]] = pending[free]
                holder = slots[slot]
                won = holder == pending
                new[pending[won]] = True
                on = np.flatnonzero(~won)
                on = on[~self._equal(pending[on], holder[on])]
                pending, slot = pending[on], (slot[on] + 1) & int(wrap)
        kept = np.flatnonzero(new)
        found = new[heads:]
        self.start, self.length, self.text, self.hash = self.start[kept], self.length[kept], self.text[kept], self.hash[kept]
        return found

    def _hash(self, start, length, text):
        h = mix(text.astype(_U) * _U(0x9E3779B97F4A7C13) + length.astype(_U))
        short = np.flatnonzero(length <= SHORT)
        for k in range(0, SHORT, 8):
            short = short[length[short] > k]
            if not len(short):
                break
            h[short] = mix(h[short] ^ (self.eight[start[short] + k] & _MASK[np.minimum(length[short] - k, 8)]))
        for i in np.flatnonzero(length > SHORT):
            digest = blake2b(self.buf[start[i] : start[i] + length[i]].tobytes(), digest_size=8).digest()
            h[i] ^= _U(int.from_bytes(digest, "little"))
        return h

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        equal = (self.hash[a] == self.hash[b]) & (self.text[a] == self.text[b]) & (self.length[a] == self.length[b])
        open_ = np.flatnonzero(equal)
        long = open_[self.length[a[open_]] > SHORT]
        for i in long:
            n = self.length[a[i]]
            equal[i] = np.array_equal(self.buf[self.start[a[i]] : self.start[a[i]] + n], self.buf[self.start[b[i]] : self.start[b[i]] + n])
        open_ = np.setdiff1d(open_, long, assume_unique=True)
        for k in range(0, SHORT, 8):
            open_ = open_[self.length[a[open_]] > k]
            if not len(open_):
                break
            mask = _MASK[np.minimum(self.length[a[open_]] - k, 8)]
            same = (self.eight[self.start[a[open_]] + k] & mask) == (self.eight[self.start[b[open_]] + k] & mask)
            equal[open_[~same]] = False
            open_ = open_[same]
        return equal


def count_texts(column: pa.Array | pa.ChunkedArray, slice_bytes: int = SLICE_BYTES) -> np.ndarray:
    """Per text (words, distinct words, capitals, code points, symbols). Nulls
    count as empty. A text beyond ``slice_bytes`` is read in pieces; besides
    its bytes, memory then grows only with its distinct words."""
    out = []
    for _, _, texts in slices(column, slice_bytes):
        table, counts = WordTable(texts.buf), np.zeros((len(texts), 5), np.int64)
        for lo, hi in pieces(texts.buf, max(slice_bytes, 1)) if len(texts) == 1 else [(0, len(texts.buf))]:
            limits = np.clip(texts.limits, lo, hi) - lo
            kinds = CLASS[texts.buf[lo:hi]]
            before = np.empty(len(kinds), np.uint8)
            before[1:] = NEXT[kinds[:-1]]
            edge = limits[limits < len(kinds)]  # a text, and a piece, starts between words
            before[edge] = BETWEEN
            events = EVENTS.ravel()[before * np.uint8(6) + kinds]
            begin = np.flatnonzero(events & BEGINS)
            text = np.searchsorted(limits, begin, side="right") - 1
            # a word ends at the next separator or with its text
            stop = np.append(np.flatnonzero(events & ENDS), hi - lo)
            end = np.minimum(stop[np.searchsorted(stop, begin)], limits[text + 1])
            first = table.insert(begin + lo, end + lo, text)
            counts[:, 0] += np.bincount(text, minlength=len(texts))
            counts[:, 1] += np.bincount(text[first], minlength=len(texts))
            for place, event in ((2, IS_CAPITAL), (3, IS_POINT), (4, IS_SYMBOL)):
                counts[:, place] += np.diff(np.searchsorted(np.flatnonzero(events & event), limits))
        out.append(counts)
    return np.concatenate(out) if out else np.zeros((0, 5), np.int64)


def text_counts(rows: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of rows with ``n_words``, ``n_distinct``,
    ``n_capitals``, ``n_points`` and ``n_symbols`` of the text column, which
    must not clash with theirs."""
    others = [c for c in rows.columns if c != text]
    names = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = count_texts(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(c) for c in counts.T)], names=[*others, *names])

    kinds = dict(rows.dtypes)
    schema = [*(f"`{c}` {kinds[c]}" for c in others), *(f"{n} long" for n in names)]
    return rows.select(*others, text).mapInArrow(run, ", ".join(schema))


def failures(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, part, fails) of each row of docs (doc_id, text, lang): the part
    is the lang, '' for null; fails is the set of filters that the text fails,
    as the sum of bits A 1, B 2, C 4, D 8, E 16:

    * A: under 100 words; B: distinct words under 80 % of all; C: capitals over
      10 % of the code points; D: any of ``#$%&*|``;
    * E: the same text as a row of smaller doc_id. A null id is not smaller
      than any and no id is smaller than it; rows repeated with one id don't
      fail each other.

    Null texts are empty. Equal texts are found by SHA-256 of all bytes."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.alias("text"))
    n = {k: F.col(f"n_{k}") for k in ("words", "distinct", "capitals", "points", "symbols")}
    tests = [n["words"] < 100, 100 * n["distinct"] < 80 * n["words"], 100 * n["capitals"] > 10 * n["points"], n["symbols"] > 0]
    fails = sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))
    counted = text_counts(rows).select("doc_id", "part", "digest", fails.alias("fails"))
    counted = stored(spark, counted, "text-failures")
    # copies meet as (digest, smallest id), aggregated before the shuffle; only texts held by several ids join back
    copied = counted.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("digest", "first")
    late = F.when(F.col("doc_id") > F.col("first"), 16).otherwise(0)
    return counted.join(copied, "digest", "left").select("doc_id", "part", (F.col("fails") + late).alias("fails"))


def profile(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, documents, good, toxic): texts by part and set of failed
    filters, and how many of them labels (doc_id, quality, toxic) mark as good
    and as toxic. Any row of an id marks it; null ids have no labels."""
    marks = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id")
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return failed.join(marks, "doc_id", "left").groupBy("part", "fails").agg(F.count("*").alias("documents"), total("good"), total("toxic"))


def audit(profiles: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step (see the contract of
    ``interaction_audit``), from a profile whose sets hold bit i for the i-th
    of ``filters``."""
    orders = F.explode(F.array(*(F.lit("".join(p)) for p in permutations(filters))))
    steps = profiles.withColumn("filter_order", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
    bit = F.create_map(*(x for i, f in enumerate(filters) for x in (F.lit(f), F.lit(1 << i))))
    own = bit[F.expr("substring(filter_order, step, 1)")]
    earlier = F.aggregate(F.split(F.expr("substring(filter_order, 1, step - 1)"), ""), F.lit(0), lambda mask, f: mask + F.coalesce(F.try_element_at(bit, f), F.lit(0)))
    steps = steps.select("part", "filter_order", "step", "fails", "documents", "good", "toxic", own.alias("own"), earlier.alias("earlier"))
    hit, gone = F.col("fails").bitwiseAND(F.col("own")) != 0, F.col("fails").bitwiseAND(F.col("earlier")) != 0
    # a text that fails k filters is removed by each of them in 1/k of all orders
    share = F.col("documents") * F.element_at(F.array(*(F.lit(_orders(len(filters)) // k) for k in range(1, len(filters) + 1))), F.bit_count("fails"))

    def total(rows: Column, value: str | Column, name: str) -> Column:
        return F.sum(F.when(rows, value if isinstance(value, Column) else F.col(value)).otherwise(0)).cast("long").alias(name)

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~hit & ~gone, "documents", "kept"),
        total(hit & ~gone, "documents", "removed"),
        total(hit & gone, "documents", "redundant"),
        total(F.col("fails") == F.col("own"), "documents", "unique_fails"),
        total(hit & ~gone, "good", "good_lost"),
        total(hit & ~gone, "toxic", "toxic_lost"),
        total(hit, share, "shapley"),
    )


def _orders(n: int) -> int:
    return n * _orders(n - 1) if n > 1 else 1


def interaction_audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Five filters in all 120 orders over docs (doc_id, text, lang, ...):
    (part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley), zeros included, for each part that has
    documents. No documents, no rows. Repeated rows count each time; columns
    besides those named are ignored. Nulls: see ``failures`` and ``profile``."""
    return audit(profile(failures(spark, docs), labels))
