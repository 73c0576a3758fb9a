"""Token ids in files, compressed by Re-Pair grammars.

Documents are put in the order of their doc_id by ranges, encoded, and closed
by the separator's id; a task writes the ids of its range in shards of about
``SHARD_IDS``.  Within a shard, pairs of neighbouring ids that occur often are
replaced by nonterminals, round by round: a round counts all pairs, takes
those that occur ``LEAST`` times or more, the most frequent first where they
overlap, and replaces them all over the shard; rounds end when no pair is that
frequent or when one shortens the shard by less than a 64th.

A shard is a row of a Parquet table: ``part`` (range) and ``shard`` (place in
it), ``before`` (ids before it in its range), ``n_ids``, ``doc_ids`` and
``lengths`` (its documents and their ids), and ``body``, all numbers little
endian:

    4 bytes     RPG1
    6 x u8      ids, symbols, first nonterminal, rules, rounds, bytes of a symbol
    u4[rounds]  rules made in each round
    u4[rules]   left symbols of the rules
    u4[rules]   right symbols
    u8[rules]   expansion lengths
    u8[...]     ids before every 256th symbol
    symbols

A reader finds the symbols of a range of ids by the marks and the expansion
lengths, and expands only those.  Shards are rows, so a lost executor costs
its tasks only; memory holds one shard and one batch of documents.

Null text is empty text; an empty text is the separator alone.  Documents
without doc_id come first.  Rows of one doc_id are ordered by a hash of their
text; rows that are equal in both are written each for itself, and may be in
different ranges, as may be the many rows of one doc_id.  A document is never
cut: one longer than a shard makes a longer shard.  An empty table gives no
shards and an empty result.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..paths import fresh_path
from . import words
from .common import documents, saved, ship, small
from .sos_packing import encoder

SHARD_IDS = 1 << 20
LEAST = 8
#: A round has to shorten a shard by this share.
GAIN = 1 / 64
#: Symbols between two marks.
MARK = 256
#: Bytes of text in a range, and the most ranges of a table.
PART_BYTES = 32 << 20
MOST_PARTS = 100_000

MAGIC = b"RPG1"
FILES = "part int, shard int, before long, n_ids long, doc_ids array<long>, lengths array<long>, body binary"


def repair(ids: np.ndarray, least: int = LEAST, gain: float = GAIN):
    """(symbols, first nonterminal, left, right, rules of each round)."""
    s = ids.astype(np.uint32)
    first = int(s.max(initial=0)) + 1
    made, left, right, rounds = 0, [], [], []
    while len(s) > 1:
        keys = s[:-1].astype(np.uint64) << np.uint64(32) | s[1:]
        pairs, prior = ranked(keys, least)
        if not len(pairs):
            break
        at = places(prior)
        which = prior[at].astype(np.int64) - 1
        used = np.bincount(which, minlength=len(pairs)) >= least
        number = np.cumsum(used) - 1
        kept = used[which]
        at, which = at[kept], number[which[kept]]
        if not len(at) or len(at) < gain * len(s):
            break
        pairs = pairs[used]
        s[at] = first + made + which
        rest = np.ones(len(s), bool)
        rest[at + 1] = False
        s = s[rest]
        left.append((pairs >> np.uint64(32)).astype(np.uint32))
        right.append(pairs.astype(np.uint32))
        rounds.append(len(pairs))
        made += len(pairs)
    none = np.zeros(0, np.uint32)
    return s, first, np.concatenate([none, *left]), np.concatenate([none, *right]), rounds


def places(prior: np.ndarray) -> np.ndarray:
    """Where pairs are replaced: where they come before their neighbours, and
    at every second place of a run of one id."""
    beside = np.zeros(len(prior) + 2, prior.dtype)
    beside[1:-1] = prior
    found = (prior > beside[:-2]) & (prior >= beside[2:])
    inner = np.flatnonzero((prior > 0) & (prior == beside[:-2]))
    if len(inner):
        at = np.arange(len(inner))
        new = np.concatenate(([True], np.diff(inner) > 1))
        offset = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
        found[inner] = (offset % 2 == 0) & (prior[inner] >= beside[inner + 2])
    return np.flatnonzero(found)


def ranked(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, prior): the pairs that occur ``least`` times, rarest first, and
    for every place the number of its pair among them, from 1, or 0.  Of pairs
    that share a slot of the table the most frequent one is taken; others wait
    for the next round."""
    ordered = np.sort(keys)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    count = np.diff(np.append(starts, len(ordered)))
    often = count >= least
    pairs, count = ordered[starts[often]], count[often]
    pairs = pairs[np.argsort(count, kind="stable")]
    bits = max(10, int(len(pairs)).bit_length() + 2)
    factor, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits)
    slots = np.zeros(1 << bits, np.uint32)
    slots[(pairs * factor) >> shift] = np.arange(1, len(pairs) + 1, dtype=np.uint32)
    prior = slots[(keys * factor) >> shift]
    prior[np.concatenate((np.zeros(1, np.uint64), pairs))[prior] != keys] = 0
    return pairs, prior


class Expansions:
    """Terminals and rules, each with its ids written out one after the other."""

    def __init__(self, first: int, left: np.ndarray, right: np.ndarray, rounds, lengths: np.ndarray | None = None):
        self.count = np.ones(first + len(left), np.int64)
        sides = np.stack([left, right], 1).astype(np.int64)
        if lengths is not None:
            self.count[first:] = lengths
        a = 0
        for n in rounds if lengths is None else ():
            self.count[first + a : first + a + n] = self.count[sides[a : a + n]].sum(1)
            a += n
        self.start = np.cumsum(self.count) - self.count
        self.flat = np.empty(int(self.count.sum()), np.uint32)
        self.flat[:first] = np.arange(first)
        a = 0
        for n in rounds:
            at = self.start[first + a]
            found = self.of(sides[a : a + n].ravel())
            self.flat[at : at + len(found)] = found
            a += n

    def of(self, symbols: np.ndarray) -> np.ndarray:
        count = self.count[symbols]
        end = np.cumsum(count)
        total = int(end[-1]) if len(end) else 0
        return self.flat[np.repeat(self.start[symbols] - (end - count), count) + np.arange(total)]


def packed(ids: np.ndarray) -> bytes:
    """The body of a shard."""
    s, first, left, right, rounds = repair(ids)
    count = np.ones(first + len(left), np.uint64)
    a = 0
    for n in rounds:
        count[first + a : first + a + n] = count[left[a : a + n]] + count[right[a : a + n]]
        a += n
    width = -(-max(1, (first + len(left) - 1).bit_length()) // 8)
    before = np.cumsum(count[s]) - count[s] if len(s) else np.zeros(0, np.uint64)
    return b"".join(
        [
            MAGIC,
            struct.pack("<6Q", len(ids), len(s), first, len(left), len(rounds), width),
            np.array(rounds, "<u4").tobytes(),
            left.astype("<u4").tobytes(),
            right.astype("<u4").tobytes(),
            count[first:].astype("<u8").tobytes(),
            before[::MARK].astype("<u8").tobytes(),
            s.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes(),
        ]
    )


class Shard:
    """Reader of a shard's body, from any place."""

    def __init__(self, body: bytes):
        if body[:4] != MAGIC:
            raise ValueError("not a shard of token ids")
        self.n_ids, symbols, first, rules, rounds, self.width = struct.unpack_from("<6Q", body, 4)
        at = 52

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, kind, n, at)
            at += out.nbytes
            return out

        made = take("<u4", rounds).tolist()
        left, right, lengths = take("<u4", rules), take("<u4", rules), take("<u8", rules)
        self.expansions = Expansions(first, left, right, made, lengths.astype(np.int64))
        self.marks = take("<u8", -(-symbols // MARK)).astype(np.int64)
        self.body = take("u1", symbols * self.width).reshape(symbols, self.width)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` up to ``end``."""
        if start >= end:
            return np.zeros(0, np.uint32)
        a = int(np.searchsorted(self.marks, start, "right")) - 1
        b = int(np.searchsorted(self.marks, end, "left"))
        part = self.body[a * MARK : b * MARK]
        symbols = np.zeros((len(part), 4), np.uint8)
        symbols[:, : self.width] = part
        symbols = symbols.view("<u4").ravel()
        stop = self.marks[a] + np.cumsum(self.expansions.count[symbols])
        first = int(np.searchsorted(stop, start, "right"))
        last = int(np.searchsorted(stop, end, "left")) + 1
        skipped = int(stop[first - 1]) if first else int(self.marks[a])
        return self.expansions.of(symbols[first:last])[start - skipped : end - skipped]


def write(docs: DataFrame, path: str, tokenizer_file: str, spaced: bool, separator: int = 0) -> None:
    """Write the ids of ``docs`` to ``path``, in ascending order of doc_id.
    ``spaced`` as for packing."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())
    docs = documents(docs, "doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(size // PART_BYTES, min(size >> 20, spark.sparkContext.defaultParallelism)) + 1

    def shards(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encode = encoder(content.value, spaced)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        waiting, named, held = [], [], 0

        def row():
            lengths = [len(w) for w in waiting]
            columns = [[part], [number], [before], [held], [named], [lengths], [packed(np.concatenate(waiting))]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in FILES.split(", ")]
            )

        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            doc_ids = batch.column("doc_id").to_pylist()
            for a, b in words.parts(offsets, 2 * words.PART_BYTES):
                found = encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for doc_id, ids in zip(doc_ids[a:b], found):
                    waiting.append(np.append(ids, np.uint32(separator)))
                    named.append(doc_id)
                    held += len(ids) + 1
                    if held >= SHARD_IDS:
                        yield row()
                        number, before = number + 1, before + held
                        waiting, named, held = [], [], 0
        if waiting:
            yield row()

    # Equal rows are told apart by their place, so that they can be split.
    rows = docs.withColumns({"body": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(min(parts, MOST_PARTS), "doc_id", "body", "place")
    rows = rows.sortWithinPartitions("doc_id", "body").select("doc_id", "text")
    rows.mapInArrow(shards, FILES).write.parquet(path)


def starts(files: DataFrame) -> DataFrame:
    """(part, start): the ids before each range.  Sums run within groups of
    1,024 ranges, then over the groups."""
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.withColumn("slice", F.floor(F.col("part") / 1024))
    ahead = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = parts.groupBy("slice").agg(F.sum("n").alias("n"))
    groups = groups.select("slice", ahead(Window.orderBy("slice")).alias("base"))
    parts = parts.select("part", "slice", ahead(Window.partitionBy("slice").orderBy("part")).alias("inner"))
    return parts.join(groups, "slice").select("part", (F.col("base") + F.col("inner")).alias("start"))


def runs(lengths: np.ndarray, limit: int = SHARD_IDS) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``limit`` ids."""
    end = np.cumsum(lengths)
    a = 0
    while a < len(lengths):
        b = max(a + 1, int(np.searchsorted(end, (end[a - 1] if a else 0) + limit, "right")))
        yield a, b
        a = b


def read(spark, path: str, wanted: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and (``with_ids``) ids of the
    documents in the files; with ``wanted`` only of these doc_ids, decoded
    from their places alone."""
    files = spark.read.schema(FILES).parquet(path)
    before = starts(files)
    chosen = None if wanted is None else np.unique(np.array(wanted, np.int64))
    if chosen is not None:
        files = files.where(F.exists("doc_ids", lambda i: i.isin([int(c) for c in chosen])))
    result = "doc_id long, part int, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def decode(batches):
        for batch in batches:
            for n in range(len(batch)):
                row = batch.slice(n, 1).to_pylist()[0]
                shard, lengths = Shard(row["body"]), np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                doc_ids = np.array([np.iinfo(np.int64).min if i is None else i for i in row["doc_ids"]], np.int64)
                if chosen is None:
                    pieces = runs(lengths)
                else:
                    named = np.isin(doc_ids, chosen) & np.array([i is not None for i in row["doc_ids"]])
                    pieces = ((i, i + 1) for i in np.flatnonzero(named).tolist())
                for a, b in pieces:
                    first = int(ends[a] - lengths[a])
                    ids = shard.ids(first, int(ends[b - 1])).astype("<u4")
                    cuts = ends[a:b] - first
                    columns = [
                        pa.array(row["doc_ids"][a:b], pa.int64()),
                        pa.array(np.full(b - a, row["part"], np.int32)),
                        pa.array(row["before"] + ends[a:b] - lengths[a:b]),
                        pa.array(lengths[a:b]),
                        pa.array([zlib.crc32(ids[e - n : e]) for e, n in zip(cuts.tolist(), lengths[a:b].tolist())], pa.int64()),
                    ]
                    if with_ids:
                        cuts = pa.array(np.concatenate(([0], cuts)).astype(np.int32))
                        columns.append(pa.ListArray.from_arrays(cuts, pa.array(ids.view(np.int32))))
                    yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in result.split(", ")])

    found = files.mapInArrow(decode, result).join(small(saved(before, "starts")), "part")
    names = ["n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return found.select("doc_id", (F.col("start") + F.col("at")).alias("start"), *names)


def round_trip(docs: DataFrame, tokenizer_file: str, spaced: bool, separator: int = 0) -> DataFrame:
    """Writes the files and reads them back: doc_id, start, n_tokens,
    ids_crc32."""
    path = fresh_path(docs.sparkSession, "repair")
    write(docs, path, tokenizer_file, spaced, separator)
    return read(docs.sparkSession, path, with_ids=False)
