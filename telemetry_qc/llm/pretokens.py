"""Encoding many texts when a word's ids don't depend on its neighbours.

A pattern that takes one leading space into a pretoken (`` ?``) begins a new
one at every single blank between two words.  Text whose blanks are single
spaces and newlines between words is therefore a row of units - a word with
the blank before it, a point after it - that can be encoded each for itself.  Units are found
and told apart by 64-bit hashes in numpy; only those not met before are
handed to the encoder, and their ids are put together again by indexing.
Any other text (blanks side by side, at the ends, or other than these) is
handed over whole.
"""

from __future__ import annotations

import re
from typing import Callable

import numpy as np

from . import words

_KINDS = words.mix(np.arange(7, 11, dtype=np.uint64))
_BLANK = (b"", b" ", b"\n", b"")
_OTHER_SPACES = re.compile(
    b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_POINT = np.zeros(256, bool)
_POINT[list(b".,;:!?")] = True


class UnitCache:
    """Ids of texts; ``encode`` gives the ids of each of a list of strings.
    Keeps at most ``limit`` units, then begins anew."""

    def __init__(self, encode: Callable[[list[str]], list[np.ndarray]], spaced: bool, limit: int = 1_000_000):
        self.encode, self.spaced, self.limit = encode, spaced, limit
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted; with them the place of
        self.start = np.zeros(0, np.int64)  # their ids in ``ids``
        self.count = np.zeros(0, np.int64)
        self.ids = [np.zeros(0, np.uint32)]
        self.filled = 0

    def _learn(self, keys: np.ndarray, units: list[str]) -> None:
        found = self.encode(units)
        count = np.array([len(f) for f in found], np.int64)
        start = self.filled + np.cumsum(count) - count
        self.ids.append(np.concatenate([*found, np.zeros(0, np.uint32)]).astype(np.uint32))
        self.filled += int(count.sum())
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.start = np.insert(self.start, at, start)
        self.count = np.insert(self.count, at, count)

    def _regular(self, data: np.ndarray, offsets: np.ndarray, s, e, n) -> np.ndarray:
        """Which texts are rows of units."""
        length = np.diff(offsets)
        ok = (n > 0) | (length == 0)
        ends = np.cumsum(n)
        some = np.flatnonzero(n)
        ok[some] &= (s[ends[some] - n[some]] == offsets[some]) & (e[ends[some] - 1] == offsets[some + 1])
        odd = [np.flatnonzero((data < 32) & (data != 10))]
        # The gaps between words of one text are one byte long.
        if len(s) > 1:
            wide = s[1:] - e[:-1] > 1
            wide[ends[some[:-1]] - 1] = False
            odd.append(e[:-1][wide])
        odd.append(np.array([m.start() for m in _OTHER_SPACES.finditer(data)], np.int64))
        odd = np.concatenate(odd)
        if len(odd):
            ok[np.searchsorted(offsets, odd, "right") - 1] = False
        return ok

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts whose bytes are ``data``."""
        s, e, n = words.spans(data, offsets)
        ok = self._regular(data, offsets, s, e, n) if self.spaced else np.zeros(len(n), bool)
        out: list[np.ndarray | None] = [None] * len(n)
        if not ok.all():
            whole = np.flatnonzero(~ok)
            texts = [data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in whole]
            for i, ids in zip(whole.tolist(), self.encode(texts)):
                out[i] = ids
        kind = np.where(data[np.maximum(s - 1, 0)] == 10, 2, 1)
        ends = np.cumsum(n)
        kind[(ends - n)[n > 0]] = 0
        mine = np.repeat(ok, n)
        s, e, kind = s[mine], e[mine], kind[mine]
        # A point after a letter is a unit of its own.
        pointed = (e - s > 1) & _POINT[data[e - 1]] & _LETTER[data[np.maximum(e - 2, 0)]]
        at = np.flatnonzero(pointed)
        s, e, kind = np.insert(s, at + 1, e[at] - 1), np.insert(e, at, e[at] - 1), np.insert(kind, at + 1, 3)
        n = n + np.bincount(np.repeat(np.arange(len(n)), np.where(ok, n, 0))[at], minlength=len(n))
        keys, first, unit = np.unique(words.mix(words.span_hashes(data, s, e) + _KINDS[kind]), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        if new.any():
            f = first[new]
            spans = zip(kind[f].tolist(), s[f].tolist(), e[f].tolist())
            raw = data.tobytes()
            self._learn(keys[new], [(_BLANK[k] + raw[a:b]).decode() for k, a, b in spans])
            at = np.searchsorted(self.keys, keys)
        if len(self.ids) > 1:
            self.ids = [np.concatenate(self.ids)]
        held = self.ids[0]
        start, count = self.start[at][unit], self.count[at][unit]
        stop = np.cumsum(count)
        flat = held[np.repeat(start - (stop - count), count) + np.arange(int(stop[-1]) if len(stop) else 0)]
        # Where each text's units end.
        n = np.where(ok, n, 0)
        text_end = np.concatenate(([0], stop))[np.cumsum(n)]
        text_start = np.concatenate(([0], text_end[:-1]))
        for i in np.flatnonzero(ok).tolist():
            out[i] = flat[text_start[i] : text_end[i]]
        return out
