"""Line dedup by overlapping windows of three consecutive lines.

A window that occurred before - in a document before (by doc_id), or further
up in the same one - is a repeat; the lines that repeats cover are removed,
overlapping ones merged.  Lines end at a newline and are compared as they
stand, empty ones too.  A text of fewer than three lines has no window and
stays.  Null text is empty text; one whose lines all go becomes empty.  Rows
equal in doc_id and text are one document and get one result each; documents
of one doc_id with different texts come in the order of a hash.  Documents
without doc_id come first.  An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words
from .common import DOC_COLUMNS, documents
from .repeats import attach, digests, held, held_before

WINDOW = 3
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def lines(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the lines of all texts, and lines per text."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    per = 1 + np.diff(np.searchsorted(breaks, offsets))
    ends = np.sort(np.concatenate((breaks, offsets[1:])), kind="stable")
    return starts, ends, per


def windows(data: np.ndarray, offsets: np.ndarray, both: bool = True):
    """(the two numbers of every window, or the first only, windows per
    text)."""
    starts, ends, per = lines(data, offsets)
    hashes = (words.span_hashes, words.second_hashes) if both else (words.span_hashes,)
    if len(starts) < WINDOW:
        return *(np.zeros(0, np.uint64) for _ in hashes), np.zeros(len(per), np.int64)
    n = len(starts) - WINDOW + 1
    owner = np.repeat(np.arange(len(per)), per)
    inside = owner[:n] == owner[WINDOW - 1 :]
    out = []
    for hash_ in hashes:
        line = hash_(data, starts, ends)
        out.append(words.mix(sum(line[k : n + k] * _FACTORS[k] for k in range(WINDOW)))[inside])
    return *out, np.maximum(per - WINDOW + 1, 0)


def cut_lines(text: str, repeated: np.ndarray) -> tuple[str, int, int]:
    """Text without the covered lines; lines; removed lines."""
    split = text.split("\n")
    if not repeated.any():
        return text, len(split), 0
    covered = np.zeros(len(split), bool)
    for k in range(WINDOW):
        covered[k : k + len(repeated)] |= repeated
    kept = [line for line, c in zip(split, covered.tolist()) if not c]
    return "\n".join(kept), len(split), len(split) - len(kept)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The columns of documents, text without repeated lines, n_chars after
    it; n_lines and n_removed."""
    docs = documents(docs)
    found = attach(docs, held_before(digests(docs, windows)))

    def remove(batches):
        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            before = batch.column("digests")
            for a, b in words.parts(offsets):
                digest, count = windows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], both=False)
                again = held(digest, count, before.slice(a, b - a))
                ends = np.cumsum(count)
                texts = batch.column("text").slice(a, b - a).to_pylist()
                out = [cut_lines(t or "", again[e - c : e]) for t, e, c in zip(texts, ends, count)]
                text, n_lines, n_removed = zip(*out)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(text, pa.string()),
                        part.column("lang"),
                        part.column("source"),
                        pa.array([len(t) for t in text], pa.int64()),
                        pa.array(n_lines, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                    ],
                    [*DOC_COLUMNS, "n_lines", "n_removed"],
                )

    schema = ", ".join(f"{n} {t}" for n, t in DOC_COLUMNS.items()) + ", n_lines long, n_removed long"
    return found.mapInArrow(remove, schema)
