"""Personal data by fixed formats and bootstrapped contexts (operator 8).

Formats find emails, IP addresses, card and phone numbers. These seeds induce
lexical patterns: the one and two words before them, the one and two words
after. A pattern is as sure as the share of all its occurrences in the corpus
that stand at known identifiers. What stands at a sure pattern is a candidate,
whatever its shape: a word less the punctuation around it, or a run of digits
with blanks, brackets and joiners between. A candidate scores its patterns
together, times the share of its own occurrences in the corpus that stand at
sure patterns, so that words of the language stay what they are. Sure strings
induce patterns in turn, until a round finds no new one. They are reported as
kind ``id``, wherever they stand at a sure pattern.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foehn.llm.store import numbered, releasing, stored
from foehn.llm.textvec import SPACE, Texts, Words, mix, slices

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a digit run that fails from its first digit fails from every other one
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Digits with the separators that the formats above allow between them.
_DIGITS = re.compile(r"(?<!\w)[+(]{0,2}[0-9](?:[\x20().-]{0,2}[0-9])*+(?!\w)")
_INNER = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]")
_AROUND = re.compile(r"^[^A-Za-z0-9\x80-\U0010ffff]+|[^A-Za-z0-9\x80-\U0010ffff]+$")

#: Patterns count from this many different strings on; strings and patterns
#: are sure from this score on.
SUPPORT, SURE = 3, 0.5

#: Occurrences a counting task holds before it sends off their counts.
HELD = 8_000_000
#: Bits of the slots by which the passes over the texts leave out other words.
SLOT_BITS = 22

_U = np.uint64


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping emails: the run before each @, and a domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: list[int]) -> bool:
    doubled = [d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans (code points, end exclusive) of each kind in KINDS."""
    found = [list(emails(text)), [], [], []]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found[1].append(m.span())
    for m in _CARD.finditer(text):
        digits = [ord(c) - 48 for c in m[0] if c.isdigit()]
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found[2].append(m.span())
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found[3].append(m.span())
    return found


def joined_spans(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans, strict=True) for a, b in own)


def _pairs(words: Words, factor: int) -> np.ndarray:
    """For each word the hash of it and the next one of its text; 0 at the last."""
    two = np.zeros_like(words.hashes)
    two[:-1] = mix(words.hashes[:-1] * _U(factor) + words.hashes[1:])
    two[words.first[1:][words.counts() > 0] - 1] = 0
    return two


def _before(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word the patterns that end with it: itself, and with the word before."""
    two = np.zeros_like(words.hashes)
    two[1:] = _pairs(words, 0x9E3779B97F4A7C15)[:-1]
    return words.hashes, two


def _after(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word the patterns that begin with it: itself, and with the next word."""
    return mix(words.hashes ^ _U(0xA4093822299F31D0)), _pairs(words, 0x082EFA98EC4E6C89)


class Contexts:
    """Patterns of a slice by word, 0 where nothing stands at them, in four
    kinds: one and two words before, one and two words after."""

    def __init__(self, texts: Texts):
        self.texts, self.words = texts, texts.words(SPACE)
        some = self.words.counts() > 0
        self.before = [x.copy() for x in _before(self.words)]
        self.after = list(_after(self.words))
        for x in self.before:
            x[self.words.first[1:][some] - 1] = 0
        for x in self.after:
            x[self.words.first[:-1][some]] = 0

    @cached_property
    def forms(self) -> tuple[np.ndarray, np.ndarray]:
        """For each word what instances at it are counted by: the word less
        the punctuation around it, or with the next one."""
        inner = self.texts.inner(self.words)
        return inner, _pairs(Words(inner, self.words.start, self.words.end, self.words.first), 0x9E3779B97F4A7C15)

    def of(self, text: int, i: int, e: int) -> list[int]:
        """Patterns at words i to e of the text, by kind."""
        first, end = self.words.first[text], self.words.first[text + 1]
        left = [int(x[i - 1].view(np.int64)) if i > first else 0 for x in self.before]
        return left + [int(x[e + 1].view(np.int64)) if e + 1 < end else 0 for x in self.after]


class Places:
    """Instances of one text: what stands at a word, by code points."""

    def __init__(self, contexts: Contexts, text: int):
        texts, words = contexts.texts, contexts.words
        self.low, self.first = int(texts.limits[text]), int(words.first[text])
        own = texts.buf[self.low : texts.limits[text + 1]]
        self.string = own.tobytes().decode()
        self.points = np.flatnonzero((own & 0xC0) != 0x80)
        self.start = words.start[self.first : words.first[text + 1]] - self.low
        self.end = words.end[self.first : words.first[text + 1]] - self.low
        self.starts, self.ends, self.covered = {}, {}, set()
        for m in _DIGITS.finditer(self.string):
            i, e = self.word_at(m.start()), self.word_at(m.end() - 1)
            around = self.string[self.limits(i)[0] : m.start()] + self.string[m.end() : self.limits(e)[1]]
            if e > i and not _INNER.search(around):
                self.starts.setdefault(i, (m.span(), e))
                self.ends[e] = (m.span(), i)
                self.covered.update(range(i, e + 1))

    def word_at(self, point: int) -> int:
        return int(np.searchsorted(self.start, self.points[point], side="right")) - 1 + self.first

    def limits(self, i: int) -> tuple[int, int]:
        return tuple(np.searchsorted(self.points, (self.start[i - self.first], self.end[i - self.first])).tolist())

    def word(self, i: int) -> tuple[int, int] | None:
        """Limits of the word less the punctuation around it, unless it is
        part of a run of digits."""
        if i in self.covered:
            return None
        a, b = self.limits(i)
        inner = _AROUND.sub("", self.string[a:b])
        if not inner:
            return None
        a += self.string[a:b].index(inner)
        return a, a + len(inner)

    def from_word(self, i: int) -> tuple[tuple[int, int] | None, int, int]:
        """The instance that begins at word i, and its first and last word."""
        span, e = self.starts.get(i, (None, i))
        return span or self.word(i), i, e

    def to_word(self, e: int) -> tuple[tuple[int, int] | None, int, int]:
        """The instance that ends at word e, and its first and last word."""
        span, i = self.ends.get(e, (None, e))
        return span or self.word(e), i, e


def _string(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode().lower(), digest_size=8).digest(), "little", signed=True)


def _key(text: bytes) -> bytes:
    """128 bits that stand for a text: rows of equal text have equal spans."""
    return hashlib.blake2b(text, digest_size=16).digest()


_SEED = pa.struct([("string", pa.int64()), ("patterns", pa.list_(pa.int64()))])
_FOUND = "text_key binary, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, seeds array<struct<string long, patterns array<long>>>"


def find(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """keep with the base spans of each row, which are seeds, and the patterns
    they stand at."""
    kinds = dict(docs.dtypes)
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_mark = np.array([48 <= b <= 57 or b == 64 for b in range(256)])
        for batch in batches:
            for row, to, texts in slices(batch.column(at)):
                marks = np.concatenate(([0], np.cumsum(is_mark[texts.buf])))[texts.limits]
                marked = np.flatnonzero(np.diff(marks))
                n = len(texts)
                rows = {c: [0] * n for c in ("n_email", "n_ip", "n_card", "n_phone")} | {"base_sha256": [empty] * n, "base": [""] * n, "seeds": [[] for _ in range(n)]}
                contexts = Contexts(texts) if len(marked) else None
                for i in marked.tolist():
                    string = texts.buf[texts.limits[i] : texts.limits[i + 1]].tobytes().decode()
                    spans = base_spans(string)
                    for kind, own in zip(KINDS, spans, strict=True):
                        rows[f"n_{kind}"][i] = len(own)
                    rows["base"][i] = joined_spans(spans)
                    rows["base_sha256"][i] = hashlib.sha256(rows["base"][i].encode()).hexdigest()
                    if rows["base"][i]:
                        place = Places(contexts, i)
                        for a, b in (x for own in spans for x in own):
                            rows["seeds"][i].append({"string": _string(string[a:b]), "patterns": contexts.of(i, place.word_at(a), place.word_at(b - 1))})
                keys = [_key(texts.buf[a:b].tobytes()) for a, b in zip(texts.limits[:-1], texts.limits[1:], strict=True)]
                part = batch.slice(row, to - row)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], pa.array(keys, pa.binary()), *(pa.array(rows[f"n_{k}"], pa.int64()) for k in KINDS), pa.array(rows["base_sha256"]), pa.array(rows["base"]), pa.array(rows["seeds"], pa.list_(_SEED))],
                    names=[*keep, "text_key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "seeds"],
                )

    at = keep.index(text) if text in keep else len(keep)
    rows = docs.select(*keep, *([] if text in keep else [text]))
    return rows.mapInArrow(releasing(run), ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), _FOUND]))


def _slots(df: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the column's leading bits, 2 ** SLOT_BITS of them at most."""
    found = df.select(F.shiftrightunsigned(column, 64 - SLOT_BITS).alias("slot")).distinct()
    marked = np.zeros(1 << SLOT_BITS, bool)
    for r in found.toLocalIterator():
        marked[r[0]] = True
    return np.packbits(marked)


def _hit(hashes: np.ndarray, marked: np.ndarray) -> np.ndarray:
    return marked[(hashes >> _U(64 - SLOT_BITS)).astype(np.int64)] & (hashes != 0)


def _counted(hashes: np.ndarray) -> pa.RecordBatch:
    keys, n = np.unique(hashes, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["hash", "n"])


def _over(docs: DataFrame, text: str, slots: np.ndarray, each: Callable, schema: str) -> DataFrame:
    """each(contexts, marked) over the contexts of all slices a task reads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = (Contexts(texts) for batch in batches for _, _, texts in slices(batch.column(0)))
        yield from each(read, np.unpackbits(slots).astype(bool))

    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(releasing(run), schema)


def each_of(one: Callable) -> Callable:
    return lambda read, marked: (batch for contexts in read for batch in one(contexts, marked))


def corpus_counts(docs: DataFrame, text: str, slots: np.ndarray, of_patterns: bool) -> DataFrame:
    """(hash, n): occurrences in all texts of the patterns, or else of the
    forms, whose slot is marked; others may be among them."""
    def count(read: Iterator[Contexts], marked: np.ndarray):
        held = [np.zeros(0, _U)]
        for contexts in read:
            hashes = np.concatenate([*contexts.before, *contexts.after] if of_patterns else contexts.forms)
            held.append(hashes[_hit(hashes, marked)])
            if sum(map(len, held)) > HELD:
                yield _counted(np.concatenate(held))
                held = [np.zeros(0, _U)]
        yield _counted(np.concatenate(held))

    return _over(docs, text, slots, count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def instances(docs: DataFrame, text: str, slots: np.ndarray) -> DataFrame:
    """What stands at the patterns whose slot is marked, base spans aside."""
    def one(contexts: Contexts, marked: np.ndarray):
        found = {c: [] for c in ("text_key", "start", "end", "string", "form", "kind", "pattern")}
        at = [np.flatnonzero(_hit(x, marked)) for x in (*contexts.before, *contexts.after)]
        hits = np.concatenate(at)
        kinds = np.repeat(np.arange(4), [len(x) for x in at])
        order = np.argsort(hits, kind="stable")
        text_of = np.searchsorted(contexts.words.first, hits, side="right") - 1
        now, place, taken, key = -1, None, [], b""
        for k in order.tolist():
            j, kind = int(hits[k]), int(kinds[k])
            if text_of[k] != now:
                now = int(text_of[k])
                place = Places(contexts, now)
                taken = _merged(base_spans(place.string))
                key = _key(place.string.encode())
            span, i, e = place.from_word(j + 1) if kind < 2 else place.to_word(j - 1)
            if span and not _overlaps(taken, *span):
                pattern = ((*contexts.before, *contexts.after)[kind])[j].view(np.int64)
                for c, v in zip(found, (key, *span, _string(place.string[slice(*span)]), int(contexts.forms[e > i][i].view(np.int64)), kind, int(pattern)), strict=True):
                    found[c].append(v)
        types = [pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(found.values(), types, strict=True)], names=list(found))

    return _over(docs, text, slots, each_of(one), "text_key binary, start int, end int, string long, form long, kind int, pattern long")


def _merged(spans: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """All spans in order, overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(x for own in spans for x in own):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _overlaps(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    at = bisect.bisect_left(taken, (b, 0))
    return at > 0 and taken[at - 1][1] > a


def contexts_of(docs: DataFrame, text: str, slots: np.ndarray) -> DataFrame:
    """(string, pattern) of all instances whose form's slot is marked."""
    def one(contexts: Contexts, marked: np.ndarray):
        words = contexts.words
        hits = np.flatnonzero(_hit(contexts.forms[0], marked) | _hit(contexts.forms[1], marked))
        text_of = np.searchsorted(words.first, hits, side="right") - 1
        strings, patterns, now, place = [], [], -1, None
        for j, t in zip(hits.tolist(), text_of.tolist(), strict=True):
            if t != now:
                now, place = t, Places(contexts, t)
            span, i, e = place.from_word(j)
            if span:
                own = [p for p in contexts.of(t, i, e) if p]
                strings += [_string(place.string[slice(*span)])] * len(own)
                patterns += own
        yield pa.RecordBatch.from_arrays([pa.array(strings, pa.int64()), pa.array(patterns, pa.int64())], names=["string", "pattern"])

    return _over(docs, text, slots, each_of(one), "string long, pattern long")


def sure_instances(spark: SparkSession, docs: DataFrame, text: str, found: DataFrame) -> DataFrame | None:
    """(text_key, start, end) of the strings that the patterns make sure, None
    without any. Each round needs a new sure pattern, so the rounds end; they
    read only what the patterns and strings that are new in them stand at."""
    union = lambda tables: reduce(DataFrame.unionByName, tables)
    edges = found.select(F.explode("seeds").alias("s")).select("s.string", F.explode("s.patterns").alias("pattern")).where("pattern != 0")
    contexts = [stored(spark, edges.groupBy("pattern", "string").agg(F.count("*").alias("times")), "pattern-edges")]
    known = [contexts[0].select("string").distinct()]
    counted, patterns, seen, forms, sure = [], [], [], [], None
    while True:
        wide = union(contexts).groupBy("pattern").agg(F.count("*").alias("strings"), F.sum("times").alias("hits")).where(F.col("strings") >= SUPPORT)
        new = wide.join(union(counted), "pattern", "left_anti") if counted else wide
        new = stored(spark, new.select("pattern"), "wide-patterns")
        if not new.isEmpty():
            n = corpus_counts(docs, text, _slots(new, "pattern"), True).withColumnRenamed("hash", "pattern")
            counted.append(stored(spark, n.join(new, "pattern"), "pattern-counts"))
        if not counted:
            return None
        scores = wide.join(union(counted), "pattern").select("pattern", F.least(F.lit(1.0), F.col("hits") / F.col("n")).alias("sure")).where(F.col("sure") >= SURE)
        fresh = stored(spark, scores.join(union(patterns), "pattern", "left_anti") if patterns else scores, "sure-patterns")
        if fresh.isEmpty():
            break
        patterns.append(fresh)
        seen.append(stored(spark, instances(docs, text, _slots(fresh, "pattern")).join(fresh, "pattern"), "instances"))
        at = union(seen)
        new = at.select("form").distinct()
        new = stored(spark, new.join(union(forms), "form", "left_anti") if forms else new, "forms")
        n = corpus_counts(docs, text, _slots(new, "form"), False).withColumnRenamed("hash", "form")
        forms.append(stored(spark, n.join(new, "form"), "form-counts"))
        joint = at.groupBy("string", "pattern").agg(F.first("sure").alias("sure")).groupBy("string").agg((1 - F.exp(F.sum(F.log(1 - F.least("sure", F.lit(0.999)))))).alias("joint"))
        hits = at.groupBy("string", "kind").agg(F.count("*").alias("hits")).groupBy("string").agg(F.max("hits").alias("hits"))
        own = at.select("string", "form").distinct().join(union(forms), "form").groupBy("string").agg(F.sum("n").alias("n"))
        score = F.col("joint") * F.least(F.lit(1.0), F.col("hits") / F.col("n"))
        sure = stored(spark, joint.join(hits, "string").join(own, "string").where(score >= SURE).select("string"), "sure-strings")
        new = stored(spark, sure.join(union(known).distinct(), "string", "left_anti"), "new-strings")
        if new.isEmpty():
            break
        known.append(new)
        slots = _slots(at.join(new, "string", "left_semi").select("form"), "form")
        more = contexts_of(docs, text, slots).join(new, "string").groupBy("pattern", "string").agg(F.count("*").alias("times"))
        contexts.append(stored(spark, more, "pattern-edges"))
    if sure is None:
        return None
    return stored(spark, union(seen).join(union(known).distinct(), "string", "left_semi").select("text_key", "start", "end").distinct(), "sure-spans")


def _opened(found: DataFrame, sure: DataFrame) -> DataFrame:
    """found with ``is_open``: whether the slot of a row's text is that of a
    text with sure spans. Slots are bits of at most 2 ** (SLOT_BITS - 6) long
    words, which are broadcast, so no Python worker is needed beside the one
    that a task has for its texts."""
    slot = F.shiftrightunsigned(F.xxhash64("text_key"), 64 - SLOT_BITS)
    word, bit = F.shiftright(slot, 6), F.pmod(slot, F.lit(64)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = sure.select(word.alias("slot_word"), one.alias("one")).groupBy("slot_word").agg(F.bit_or("one").alias("slot_bits"))
    rows = found.withColumn("slot_word", word).join(F.broadcast(words), "slot_word", "left")
    return rows.withColumn("is_open", F.coalesce(F.getbit("slot_bits", bit) == 1, F.lit(False)))


def find_personal_data(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """id_col (and ``keep``) with n_email, n_ip, n_card, n_phone, base_sha256
    (of the base spans), ``spans`` (base spans, then those of kind ``id``, as
    kind:start:end) and ``n_id``.

    Null texts are empty and hold nothing. Ids may be null or repeat; each row
    is searched, and rows of equal text get equal spans. Without seeds no
    pattern is sure. An empty table gives an empty one."""
    keep = [id_col] if keep is None else keep
    found = stored(spark, find(docs, text, keep), "base-spans")
    columns = [*keep, "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    plain = [F.col("base").alias("spans"), F.lit(0).cast("long").alias("n_id")]
    sure = sure_instances(spark, docs, text, found)
    if sure is None:
        return found.select(*columns, *plain)
    ids = sure.groupBy("text_key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("ids"))  # of one text
    ids = ids.select(F.col("text_key").alias("of"), F.size("ids").cast("long").alias("more"), F.array_join(F.transform("ids", lambda x: F.concat_ws(":", F.lit("id"), x["start"], x["end"])), ",").alias("id_spans"))
    # rows pass by the join unless their text's slot is one of a text with such spans
    found = _opened(found, sure)
    joined = found.where("is_open").join(ids, F.col("text_key") == F.col("of"), "left")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.col("id_spans"))
    joined = joined.select(*columns, spans.alias("spans"), F.coalesce("more", F.lit(0).cast("long")).alias("n_id"))
    return joined.unionByName(found.where("not is_open").select(*columns, *plain))


def redact(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in angle brackets; where spans
    overlap, the first that starts, or else the longest, names all of it. A
    column n_chars gets the new length; texts without spans stay as they are,
    null ones null. Every row stays, repeated ones too."""
    rows, name = numbered(docs)
    found = find_personal_data(spark, rows, text=name[text], keep=rows.columns)
    clean = found.where("spans = ''").select(*rows.columns)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            out = []
            for string, spans in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                parts, done = [], 0
                for start, _, end, kind in sorted((int(a), -int(b), int(b), k) for k, a, b in (s.split(":") for s in spans.split(","))):
                    if start >= done:
                        parts += [string[done:start], f"<{kind.upper()}>"]
                    done = max(done, end)
                out.append("".join([*parts, string[done:]]))
            columns = batch.columns[:-1]
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    hidden = found.where("spans != ''").select(*rows.columns, "spans").mapInArrow(releasing(run), rows.schema)
    if "n_chars" in docs.columns:
        hidden = hidden.withColumn(name["n_chars"], F.char_length(name[text]).cast(docs.schema["n_chars"].dataType))
    return clean.unionByName(hidden).toDF(*docs.columns)
