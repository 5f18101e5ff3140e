"""Packing documents into fixed-length sequences (operator 9).

Documents are tokenised, cut only if longer than a sequence, and packed by the
counts of their piece lengths, of which there are at most ``CAPACITY``:
Martello-Toth dominance fixes small sets of lengths that provably dominate
every other way to complete a sequence, what is left goes best-fit in
decreasing order. The plan assigns ranks of each length to places; every piece
finds its own by its rank.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foehn.llm.store import releasing, stored
from foehn.llm.textvec import SPACE, Texts, slices

CAPACITY = 4096
END_ID = 1

#: Words whose ids a worker remembers; beyond it keeps the half used most.
REMEMBERED = 1_500_000


class WordEncoder:
    """Token ids of whole slices of text; only words not met before go through
    the tokenizer, together.

    The tokenizer splits at white space before anything else, so a text's ids
    are those of its words in order."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keys = np.zeros(0, np.uint64)
        self.at, self.length, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        if len(self.keys) + len(keys) > REMEMBERED:
            keep = np.sort(np.argsort(-self.used, kind="stable")[: REMEMBERED // 2])
            at = np.repeat(self.at[keep] - np.cumsum(self.length[keep]) + self.length[keep], self.length[keep])
            self.pool = self.pool[at + np.arange(len(at))]
            self.keys, self.length, self.used = self.keys[keep], self.length[keep], self.used[keep] // 2
            self.at = np.cumsum(self.length) - self.length
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        limits = np.cumsum([0, *(len(w) + 1 for w in words)])
        token_at = np.fromiter((a for a, _ in found.offsets), np.int64, len(found))
        lengths = np.diff(np.searchsorted(token_at, limits))
        at = len(self.pool) + np.cumsum(lengths) - lengths
        self.pool = np.concatenate((self.pool, np.array(found.ids, np.uint32)))
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at, self.length, self.used = (np.insert(a, where, b) for a, b in ((self.at, at), (self.length, lengths), (self.used, np.zeros(len(keys), np.int64))))

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin."""
        words = texts.words(SPACE)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        keys, first, number = np.unique(words.hashes, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = self.keys[place] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            raw = texts.buf.tobytes()
            self._learn(keys[new], [raw[words.start[i] : words.end[i]].decode() for i in first[new]])
            place = np.searchsorted(self.keys, keys)
            if not (len(self.keys) > place.max() and (self.keys[place] == keys).all()):  # forgotten to make room
                gone = self.keys[np.minimum(place, len(self.keys) - 1)] != keys
                self._learn(keys[gone], [raw[words.start[i] : words.end[i]].decode() for i in first[gone]])
                place = np.searchsorted(self.keys, keys)
        self.used[place] += 1
        place = place[number]
        lengths = self.length[place]
        ends = np.cumsum(lengths)
        ids = self.pool[np.repeat(self.at[place] - ends + lengths, lengths) + np.arange(ends[-1])]
        return ids, np.concatenate(([0], ends))[words.first]


_encoders: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """The worker's encoder, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, id_col: str, text: str, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, nth): every document's
    tokens and an end id, cut into pieces of capacity. nth counts the pieces
    of one length within the partition ``part``."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for row, _, texts in slices(batch.column(1)):
                ids, first = encoder.encode(texts)
                found = []
                for i in range(len(texts)):
                    own = np.append(ids[first[i] : first[i + 1]], np.uint32(end_id))
                    for number, start in enumerate(range(0, len(own), capacity)):
                        cut = own[start : start + capacity]
                        found.append((row + i, number, start, len(cut), zlib.crc32(cut.astype("<u4").tobytes()), seen[len(cut)]))
                        seen[len(cut)] += 1
                rows, *columns = (np.array(c, np.int64) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(columns[0].astype(np.int32)), *map(pa.array, columns[1:4]), pa.array(np.full(len(rows), part)), pa.array(columns[4])],
                    names=["id", "piece", "start", "length", "ids_crc32", "part", "nth"],
                )

    return docs.select(id_col, text).mapInArrow(releasing(run), f"id {kind}, piece int, start long, length long, ids_crc32 long, part long, nth long")


class _Lengths:
    """Counts of lengths with ordered lookup."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: n for k, n in counts.items() if n > 0}
        self.order = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            del self.order[bisect.bisect_left(self.order, length)]

    def up_to(self, most: int) -> int:
        """Largest length not above most, or 0."""
        at = bisect.bisect_right(self.order, most)
        return self.order[at - 1] if at else 0

    def two_smallest(self) -> int:
        """Sum of the two smallest items, or more than anything."""
        if not self.order:
            return 1 << 62
        low = self.order[0]
        return 2 * low if self.counts[low] > 1 else low + self.order[1] if len(self.order) > 1 else 1 << 62


def _dominant(left: _Lengths, length: int, capacity: int) -> list[int] | None:
    """Lengths that complete a sequence holding ``length`` at least as well as
    any other choice would, or None. ``length`` itself is already taken out.

    A set dominates another if the other's items can be parted into groups that
    fit into the set's items one by one: an item that fills the rest exactly
    dominates all; the largest that fits dominates if no two fit together; a
    pair does if no three fit and no other pair has a larger second item."""
    room = capacity - length
    best = left.up_to(room)
    if not best:
        return []
    if best == room or left.two_smallest() > room:
        return [best]
    low = left.order[0]
    if left.two_smallest() + low <= room:  # three might fit
        return None
    left.take(best, 1)
    second = left.up_to(room - best)
    left.counts[best] = left.counts.get(best, 0) + 1
    if left.order[bisect.bisect_left(left.order, best) : bisect.bisect_left(left.order, best) + 1] != [best]:
        bisect.insort(left.order, best)
    # the largest second item of any pair: it or a larger one stands beside it
    half = left.up_to(room // 2)
    if half and half * 2 <= room and left.counts[half] < 2:
        above = bisect.bisect_right(left.order, half)
        if not (above < len(left.order) and half + left.order[above] <= room):
            half = left.up_to(half - 1)
    if not second:
        return [best] if not half else None
    return [best, second] if second >= half else None


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Sequences for counts[length] pieces of each length, as (pattern, times):
    a pattern lists (length, how many). The work grows with the number of
    different lengths, not of pieces."""
    left = _Lengths(dict(counts))
    found: list[tuple[list[tuple[int, int]], int]] = []
    changed = True
    while changed:
        changed = False
        for length in reversed(list(left.order)):
            while left.counts.get(length):
                left.take(length, 1)
                others = _dominant(left, length, capacity)
                left.counts[length] = left.counts.get(length, 0) + 1
                if bisect.bisect_left(left.order, length) == len(left.order) or left.order[bisect.bisect_left(left.order, length)] != length:
                    bisect.insort(left.order, length)
                if others is None:
                    break
                need = {x: [length, *others].count(x) for x in (length, *others)}
                times = min(left.counts[x] // n for x, n in need.items())
                for x, n in need.items():
                    left.take(x, n * times)
                found.append((list(need.items()), times))
                changed = True
    return found + _best_fit(left, capacity)


def _best_fit(left: _Lengths, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing over counts: sequences that look alike are one entry."""
    rooms: list[int] = []
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}

    def put(room: int, pattern, times: int) -> None:
        if room not in open_:
            bisect.insort(rooms, room)
            open_[room] = []
        open_[room].append((pattern, times))

    def pull(room: int):
        entry = open_[room].pop()
        if not open_[room]:
            del open_[room], rooms[bisect.bisect_left(rooms, room)]
        return entry

    for length in reversed(list(left.order)):
        n = left.counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            pattern, times = pull(room) if at < len(rooms) else ([], 1 << 62)
            each = min(room // length, n)
            full = min(times, n // each)
            put(room - each * length, [*pattern, (length, each)], full)
            n -= each * full
            if times > full and at < len(rooms) + 1 and times < 1 << 61:
                put(room, pattern, times - full)
    return [entry for entries in open_.values() for entry in entries]


def _places(plan: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """The plan as runs of ranks: the pieces of a length from rank ``first`` on
    go to sequences from ``sequence`` on, ``each`` per sequence from ``offset``."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for length, each in pattern:
            rows.append((length, used.get(length, 0), sequence, each, offset))
            used[length] = used.get(length, 0) + each * times
            offset += each * length
        sequence += times
    rows.sort()
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    return dict(zip(("length", "first", "sequence", "each", "offset"), (np.array(c, np.int64) for c in columns), strict=True))


def place(plan: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces of those lengths and ranks."""
    order = np.lexsort((rank, length))
    lengths = np.unique(plan["length"])
    begin = np.searchsorted(plan["length"], lengths)
    sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
    cuts = np.append(np.flatnonzero(np.diff(length[order])) + 1, len(order))
    at = 0
    for cut in cuts:
        rows = order[at:cut]
        at = cut
        if not len(rows):
            continue
        own = int(length[rows[0]])
        number = int(np.searchsorted(lengths, own))
        low = begin[number]
        high = begin[number + 1] if number + 1 < len(begin) else len(plan["length"])
        run = low + np.searchsorted(plan["first"][low:high], rank[rows], side="right") - 1
        nth = rank[rows] - plan["first"][run]
        sequence[rows] = plan["sequence"][run] + nth // plan["each"][run]
        offset[rows] = plan["offset"][run] + nth % plan["each"][run] * own
    return sequence, offset


def pack_documents(
    spark: SparkSession, docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: id_col, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset``.

    A null or empty text is its end id alone. Ids may be null or repeat; each
    row is a document. Other columns are ignored. No rows, no pieces."""
    cut = stored(spark, pieces(docs, id_col, text, tokenizer, capacity, end_id), "pieces")
    counts = stored(spark, cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    plan = _places(pack_lengths(totals, capacity))
    ranked = cut.join(counts.select("part", "length", "before"), ["part", "length"]).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sequence, offset = place(plan, batch.column("length").to_numpy(), batch.column("rank").to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(releasing(run), f"`{id_col}` {dict(docs.dtypes)[id_col]}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
