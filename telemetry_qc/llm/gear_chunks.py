"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes: every step doubles the hash and adds a
number of the byte, so that after 16 steps a byte has left it.  A chunk ends
where the hash falls below ``65536 / mean``: the cuts depend on the bytes
around them only, so an insertion changes the chunks it touches and no
others.  Chunks are deduplicated by digest: one that occurred before - in a
document before (by doc_id), or earlier in the same - is a repeat.  Repeats
are removed where adjacent ones add up to ``least`` bytes or more; shorter
ones are chance and stay.  Digests are of 64 bits; as a run holds several
chunks, two that agree by chance alone remove nothing.

Cuts lie between code points.  Null text is empty text and has no chunks; a
text without a cut is one chunk, however long.  Rows equal in doc_id and text
are one document and get one result each; documents of one doc_id with
different texts come in the order of a hash, documents without doc_id first.
An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words
from .common import documents
from .repeats import attach, digests, held, held_before

MEAN = 20
LEAST = 80
REACH = 16
_GEAR = (words.mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)


def gear(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hash at every byte.  Bytes before a text's first count as nothing."""
    # Texts are set apart by REACH - 1 places of value 0.
    n = len(offsets) - 1
    shift = np.repeat(np.arange(1, n + 1) * (REACH - 1), np.diff(offsets))
    at = np.arange(len(data)) + shift
    h = np.zeros(len(data) + (n + 1) * (REACH - 1), np.uint16)
    h[at] = _GEAR[data]
    step = 1
    while step < REACH:
        h[step:] += h[:-step] << np.uint16(step)
        step *= 2
    return h[at]


def chunks(data: np.ndarray, offsets: np.ndarray, mean: int = MEAN):
    """Starts and ends of the chunks, and chunks per text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    cut = gear(data, offsets) < 65536 // mean
    cut[:-1] &= (data[1:] & 0xC0) != 0x80
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    cut[last] = True
    ends = np.flatnonzero(cut) + 1
    starts = np.concatenate(([0], ends[:-1]))
    return starts, ends, np.diff(np.searchsorted(ends, offsets, "right"))


def chunk_digests(data: np.ndarray, offsets: np.ndarray):
    starts, ends, per = chunks(data, offsets)
    return words.span_hashes(data, starts, ends), None, per


def runs(again: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Byte spans of adjacent repeats of at least ``least`` bytes."""
    edge = np.diff(np.concatenate(([0], again.astype(np.int8), [0])))
    spans = zip(starts[np.flatnonzero(edge == 1)].tolist(), ends[np.flatnonzero(edge == -1) - 1].tolist())
    return [(a, b) for a, b in spans if b - a >= least]


def dedup_substrings(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, text (what is kept), n_chunks, n_repeated (chunks met before),
    removed (array of code point spans of the original text), n_removed (code
    points)."""
    docs = documents(docs, "doc_id", "text")
    found = attach(docs, held_before(digests(docs, chunk_digests)))

    def remove(batches):
        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            before = batch.column("digests")
            for a, b in words.parts(offsets):
                body, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                starts, ends, count = chunks(body, at)
                again = held(words.span_hashes(body, starts, ends), count, before.slice(a, b - a))
                text, repeated, removed, n_removed = [], [], [], []
                first = 0
                for i, n in enumerate(count.tolist()):
                    mine = slice(first, first + n)
                    first += n
                    raw = body[at[i] : at[i + 1]].tobytes()
                    repeated.append(int(again[mine].sum()))
                    spans = runs(again[mine], starts[mine] - at[i], ends[mine] - at[i], least) if repeated[-1] else []
                    kept, points, done, gone = [], [], 0, 0
                    seen = 0  # code points before ``done``
                    for s, e in spans:
                        head, body_ = raw[done:s].decode(), raw[s:e].decode()
                        kept.append(head)
                        points.append({"start": seen + len(head), "end": seen + len(head) + len(body_)})
                        seen = points[-1]["end"]
                        gone += len(body_)
                        done = e
                    kept.append(raw[done:].decode())
                    text.append("".join(kept))
                    removed.append(points)
                    n_removed.append(gone)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(text, pa.string()),
                        pa.array(count, pa.int64()),
                        pa.array(repeated, pa.int64()),
                        pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array(n_removed, pa.int64()),
                    ],
                    ["doc_id", "text", "n_chunks", "n_repeated", "removed", "n_removed"],
                )

    schema = "doc_id long, text string, n_chunks long, n_repeated long, removed array<struct<start: long, end: long>>, n_removed long"
    return found.mapInArrow(remove, schema)
