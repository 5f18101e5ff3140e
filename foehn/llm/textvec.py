"""Vectorised tokens and word n-grams over an Arrow string column.

A batch of texts is one byte buffer with offsets; words, their 64-bit hashes
and n-gram hashes are computed for all texts of a slice with numpy, so no
Python code runs per word. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C13)  # odd, so it has an inverse modulo 2**64
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))

#: Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

#: Byte classes. SPACE: runs of anything but \x20 and \x09-\x0D are words.
#: ALNUM: runs of ASCII letters, digits, underscore and all non-ASCII bytes.
SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
ALNUM = np.array([b >= 0x80 or chr(b).isalnum() or b == 0x5F for b in range(256)])
#: Letters, digits and all non-ASCII bytes.
_INNER = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (multiply and xor-shift rounds)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
_fold = np.arange(256)
_fold[65:91] += 32
#: Value of a byte in a word's hash, A-Z taken as a-z.
_BYTE_FOLDED = _BYTE[_fold]


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), _BASE if kind == "up" else _BASE_INV, dtype=_U)
        steps[0] = 1
        have = _powers[kind] = np.cumprod(steps, dtype=_U)
    return have


class Texts:
    """Bytes of one slice of a string column with the limits of each text."""

    def __init__(self, buf: np.ndarray, limits: np.ndarray):
        self.buf, self.limits = buf, limits

    def __len__(self) -> int:
        return len(self.limits) - 1

    def words(self, kind: np.ndarray = SPACE, fold: bool = True) -> Words:
        """Words are maximal runs of bytes of the class within one text."""
        buf, limits, n = self.buf, self.limits, len(self.buf)
        if n == 0:
            none = np.zeros(0, np.int64)
            return Words(none.astype(_U), none, none, np.zeros(len(limits), np.int64))
        is_word = kind[buf]
        edge = limits[(limits > 0) & (limits < n)]
        before = np.empty(n, bool)
        before[0], before[1:] = False, is_word[:-1]
        before[edge] = False
        start = np.flatnonzero(is_word & ~before)
        after = np.empty(n, bool)
        after[-1], after[:-1] = False, is_word[1:]
        after[edge - 1] = False
        end = np.flatnonzero(is_word & ~after) + 1
        total = np.zeros(n + 1, _U)
        np.cumsum((_BYTE_FOLDED if fold else _BYTE)[buf] * _power("up", n)[:n], out=total[1:], dtype=_U)
        hashes = (total[end] - total[start]) * _power("down", n)[start]
        hashes += (end - start).astype(_U)
        return Words(mix(hashes), start, end, np.searchsorted(start, limits))

    def inner(self, words: Words) -> np.ndarray:
        """Hashes of the words less the ASCII punctuation around them, 0 for
        words of nothing else."""
        buf, n = self.buf, len(self.buf)
        if n == 0:
            return words.hashes
        good, at = _INNER[buf], np.arange(n)
        start = np.minimum.accumulate(np.where(good, at, n)[::-1])[::-1][words.start]
        end = np.maximum.accumulate(np.where(good, at, -1))[words.end - 1] + 1
        some = start < words.end
        start, end = start[some], end[some]
        total = np.zeros(n + 1, _U)
        np.cumsum(_BYTE_FOLDED[buf] * _power("up", n)[:n], out=total[1:], dtype=_U)
        out = np.zeros(len(words), _U)
        out[some] = mix((total[end] - total[start]) * _power("down", n)[start] + (end - start).astype(_U))
        return out


class Words:
    """Hashes and byte limits of all words of a slice; words of text i are
    those from first[i] up to first[i + 1]."""

    def __init__(self, hashes, start, end, first):
        self.hashes, self.start, self.end, self.first = hashes, start, end, first

    def __len__(self) -> int:
        return len(self.hashes)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """For each word the number of its text in the slice."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words of each text in order, and where each
        text's begin. A text of fewer words, but not none, has one run: all."""
        counts = self.counts()
        short = (counts > 0) & (counts < n)
        per_text = np.where(short, 1, np.maximum(counts - n + 1, 0))
        first = np.concatenate(([0], np.cumsum(per_text)))
        at = np.repeat(self.first[:-1] - first[:-1], per_text) + np.arange(first[-1])
        padded = np.concatenate((self.hashes, np.zeros(n, _U)))
        left = np.repeat(self.first[1:], per_text) - at
        out = np.zeros(len(at), _U)
        for k in range(n):
            out = out * _BASE + np.where(left > k, padded[at + k], _U(0))
        return mix(out), first


def buffer_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    if column.null_count:
        column = column.fill_null(b"" if wide == pa.large_binary() else "")
    column = column.cast(wide)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    limits = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, limits


def slices(column, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(from row, to row, texts) over the column, each at most max_bytes long
    unless it is a single text."""
    buf, limits = buffer_of(column)
    row, rows = 0, len(limits) - 1
    while row < rows:
        to = int(np.searchsorted(limits, limits[row] + max_bytes, side="right")) - 1
        to = min(max(to, row + 1), rows)
        yield row, to, Texts(buf[limits[row] : limits[to]], limits[row : to + 1] - limits[row])
        row = to
