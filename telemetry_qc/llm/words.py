"""Words of a batch of texts as numbers: numpy over the UTF-8 bytes.

A word is a run of bytes other than space and 0x09-0x0D.  Its hash is a
polynomial over its bytes modulo 2**64, got from prefix sums, then mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time, so that the work arrays stay small.
PART_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BASE_2 = 0xD1342543DE82EF95
_INVERSE_2 = pow(_BASE_2, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash; wraps modulo 2**64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Numbers of the bytes in the second hash.
_OTHER = mix(np.arange(1, 257, dtype=np.uint64) << np.uint64(8))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PART_BYTES + 1)
        have = np.full(size, np.uint64(base))
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 16 * PART_BYTES:
            _powers[base] = have
    return have[:n]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of an Arrow string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(offsets: np.ndarray, limit: int = PART_BYTES):
    """Runs of documents of at most ``limit`` bytes (or one longer document)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end


def spans(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the words, and how many words each document has."""
    word = ~_SPACE[data]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    starts[first] = word[first]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    last = first[1:] - 1
    ends[last] = word[last]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.diff(np.searchsorted(s, offsets))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[data]


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    return _span_hashes(data.astype(np.uint64) + np.uint64(1), s, e, _BASE, _INVERSE)


def second_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the spans that have nothing to do with ``span_hashes``: both
    together are 128 bits."""
    return _span_hashes(_OTHER[data], s, e, _BASE_2, _INVERSE_2)


def _span_hashes(values: np.ndarray, s: np.ndarray, e: np.ndarray, base: int, inverse: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, len(values)), out=sums[1:])
    back = _power(inverse, len(values) + 1)
    return mix((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(hash of every word, words per document)."""
    s, e, n = spans(data, offsets)
    return span_hashes(data, s, e), n
