"""Pieces of very long texts, so that work on one text takes bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from foehn.llm.textvec import SLICE_BYTES, SPACE


def pieces(buf: np.ndarray, max_bytes: int = SLICE_BYTES, back: int = 0) -> Iterator[tuple[int, int]]:
    """(from, to) limits that cover a text's bytes in order. A piece ends
    before a separator, so no word is cut; a word longer than ``max_bytes``
    makes its piece longer. Each piece but the first starts ``back`` words
    before the end of the one before it, or with it if that has fewer."""
    at = start = 0
    while True:
        to = _end(buf, at, max_bytes)
        yield start, to
        if to == len(buf):
            return
        word = SPACE[buf[start:to]]
        first = np.flatnonzero(word & ~np.concatenate(([False], word[:-1])))
        start = to if not back else start + int(first[-back]) if len(first) >= back else start
        at = to


def _end(buf: np.ndarray, at: int, max_bytes: int) -> int:
    """Where a piece that starts at ``at`` ends: its last separator, or the
    first one after it if it has none."""
    to = at + max_bytes
    if to >= len(buf):
        return len(buf)
    gaps = np.flatnonzero(~SPACE[buf[at + 1 : to + 1]])
    if len(gaps):
        return at + 1 + int(gaps[-1])
    while to < len(buf):
        gaps = np.flatnonzero(~SPACE[buf[to : to + max_bytes]])
        if len(gaps):
            return to + int(gaps[0])
        to += max_bytes
    return len(buf)
