"""Packing documents into token sequences by the sum of squares.

A piece goes where the sum, over all residual gaps, of the squared number of
open sequences with that gap becomes smallest: into an open sequence of some
gap, or into a new one.  That keeps the gaps varied, so that later pieces find
one that fits.

Pieces are dealt evenly over tasks of about ``items`` documents each, whatever
their keys, and every task packs its own; the number of tasks grows with the
table, and what a task leaves open does not.

Null text is empty text; an empty text is the separator alone, one token.  A
document longer than a sequence is cut into full pieces, the first of which
may be shorter.  Repeated rows are packed each for itself; a null doc_id stays
null.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import words
from .common import documents, ship
from .pretokens import UnitCache


def sum_of_squares(sizes, capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of every piece, in the order given.  Equal sums go
    to the smallest gap, then to a new sequence."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    none = np.int64(1) << 40
    where, offsets, made = [], [], 0
    for size in sizes:
        # Change of the sum, halved: from gap g to gap g - size.
        best, gap = count[capacity - size] + 0.5 if size < capacity else 0.0, 0
        if size < capacity:
            if count[size]:
                change = 0.5 - count[size]
                if change <= best:
                    best, gap = change, size
            if size + 1 < capacity:
                held = count[size + 1 : capacity]
                change = np.where(held > 0, count[1 : capacity - size] - held, none)
                at = int(change.argmin())
                if change[at] + 1 < best or (not gap and change[at] + 1 <= best):
                    best, gap = change[at] + 1, size + 1 + at
        if gap:
            sequence = waiting[gap].pop()
            count[gap] -= 1
        else:
            sequence, gap = made, capacity
            made += 1
        where.append(sequence)
        offsets.append(capacity - gap)
        if gap > size:
            waiting[gap - size].append(sequence)
            count[gap - size] += 1
    return where, offsets


_encoders: dict[tuple[str, bool], UnitCache] = {}


def encoder(content: str, spaced: bool) -> UnitCache:
    """Ids by the ``tokenizers`` library.  One a worker process, as it keeps
    the ids of words it has met."""
    key = (hashlib.sha256(content.encode()).hexdigest(), spaced)
    if key not in _encoders:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content)
        tokenizer.encode_special_tokens = True

        def encode(texts: list[str]) -> list[np.ndarray]:
            out = []
            for first in range(0, len(texts), 2_000):
                some = texts[first : first + 2_000]
                got = tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
                ids = np.array(got.ids, np.uint32)
                ends = np.searchsorted(np.array(got.word_ids, np.int64), np.arange(len(some) + 1))
                out += [ids[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]
            return out

        _encoders.clear()
        _encoders[key] = UnitCache(encode, spaced)
    return _encoders[key]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` ids."""
    first = (total - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_file: str, spaced: bool, capacity: int = 2048, separator: int = 0) -> DataFrame:
    """Tokenised pieces.  ``spaced``: the tokenizer begins a pretoken at every
    single blank between words, so that words may be encoded one by one."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())

    def tokenise(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encode = encoder(content.value, spaced)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            doc_ids = batch.column("doc_id").to_pylist()
            for a, b in words.parts(offsets, 2 * words.PART_BYTES):
                rows = []
                found = encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for doc_id, ids in zip(doc_ids[a:b], found):
                    raw = np.append(ids, np.uint32(separator)).astype("<u4").tobytes()
                    for k, (start, n) in enumerate(cut(len(ids) + 1, capacity)):
                        rows.append((doc_id, k, start, n, zlib.crc32(raw[4 * start : 4 * (start + n)])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return documents(docs, "doc_id", "text").mapInArrow(tokenise, PIECES)


def pack(found: DataFrame, tasks: int, capacity: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to pieces; ``tasks`` pack independently.
    The longest pieces go first, ties by doc_id and piece."""

    def place(batches):
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches).combine_chunks()
        order = np.lexsort(
            [
                rows["piece"].to_numpy(),
                rows["doc_id"].fill_null(-(2**63)).to_numpy(),
                -rows["length"].to_numpy(),
            ]
        )
        rows = rows.take(pa.array(order))
        where, offsets = sum_of_squares(rows["length"].to_pylist(), capacity)
        first = TaskContext.get().partitionId() << 32
        rows = rows.append_column("sequence_id", pa.array([first + w for w in where], pa.int64()))
        rows = rows.append_column("offset", pa.array(offsets, pa.int64()))
        yield from rows.combine_chunks().to_batches()

    return found.repartition(tasks).mapInArrow(place, PIECES + ", sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer_file: str, spaced: bool, capacity: int = 2048, items: int = 16_384
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    tasks = max(1, round(docs.count() / items))
    return pack(pieces(docs, tokenizer_file, spaced, capacity), tasks, capacity)
