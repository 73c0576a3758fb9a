"""Language-model scoring with a log-bilinear neural model.

The model predicts a vector from those of the last words, each weighted by
its position, and scores every output by its product with that vector plus a
bias.  Outputs are the most frequent words, the end, and classes of all other
words by their last bytes; within a class a word has its share of the counts
(plus one each, and one more for all words not seen in training).  Training
is by noise-contrastive estimation with noise drawn from the unigram counts,
in numpy, in every task over its own documents; the parameters are averaged
between rounds, weighted by tokens; so the model depends, a little, on how the
table is dealt over tasks.  Scoring normalises over all outputs, by matrix
products over batches of tokens.

Documents become blocks of token numbers with the block's own list of
different words.  Words are counted over all blocks; a block gets the counts
of its words back by a join, once for each word.  The frequent words, the
class sums and the parameters are of fixed size and go to all tasks.

Words are told apart by a 64-bit hash of their bytes, A-Z lowered.  Null text
is empty text, its only token the end.  A null doc_id counts as empty text in
the split.  Repeated rows are documents of their own, in training too.
Without training documents every count is 0.  An empty table gives an empty
table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import documents, saved, ship

CLASSES = 128
FREQUENT = 383
OUTPUTS = CLASSES + FREQUENT + 1
START = OUTPUTS  # only ever read
CONTEXT = 3
WIDTH = 24
NOISE = 64
NOISE_WEIGHT = 10.0
BATCH = 1024
RATE = 0.1
#: Rounds over all training tokens, at every size of the table.
ROUNDS = 2
#: Tokens in a block.
BLOCK = 1_000_000

_END = int(words.mix(np.array([0xE0D], np.uint64))[0])


def class_of(data: np.ndarray, e: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Class of a word by its last two bytes."""
    last = data[e - 1].astype(np.uint64)
    before = np.where(e - s > 1, data[np.maximum(e - 2, 0)], 0).astype(np.uint64)
    return (words.mix(last * np.uint64(257) + before + np.uint64(1)) % np.uint64(CLASSES)).astype(np.uint8)


_CODEC = pa.Codec("zstd")


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers byte by byte, compressed: the high bytes of token
    numbers are nearly all alike."""
    raw = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + _CODEC.compress(raw.tobytes(), asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(_CODEC.decompress(blob[8:], 4 * n), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


BLOCKS = "block long, doc_ids array<long>, held binary, ends binary, tokens binary, types binary, classes binary, trained binary"


def token_blocks(docs: DataFrame) -> DataFrame:
    """Documents as rows of many: tokens are places in the block's types (its
    different words, most frequent first), trained their counts in training
    text."""

    def find(batches):
        number = TaskContext.get().partitionId() << 32
        ids, held, counts, hashes, classes, total = [], [], [], [], [], 0

        def row():
            nonlocal number, ids, held, counts, hashes, classes, total
            every, kind = np.concatenate(hashes), np.concatenate(classes)
            types, first, tokens, times = np.unique(every, return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            types, first, tokens = types[order], first[order], place[tokens]
            n = np.concatenate(counts)
            out_ = np.array(held, np.uint8)
            mine = np.repeat(out_ == 0, n)
            trained = np.bincount(tokens[mine], minlength=len(types))
            blobs = [
                out_.tobytes(),
                np.cumsum(n).astype("<i4").tobytes(),
                packed(tokens),
                types.astype("<u8").tobytes(),
                kind[first].tobytes(),
                trained.astype("<i4").tobytes(),
            ]
            arrays = [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64()))]
            arrays += [pa.array([b], pa.binary()) for b in blobs]
            number += 1
            ids, held, counts, hashes, classes, total = [], [], [], [], [], 0
            return pa.RecordBatch.from_arrays(
                arrays, ["block", "doc_ids", "held", "ends", "tokens", "types", "classes", "trained"]
            )

        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            doc_ids, held_ = batch.column("doc_id").to_pylist(), batch.column("held").to_pylist()
            for a, b in words.parts(offsets):
                part = words.lowered(data[offsets[a] : offsets[b]])
                s, e, n = words.spans(part, offsets[a : b + 1] - offsets[a])
                # An end after each document's words.
                at = np.cumsum(n)
                if ids and total + int(at[-1]) + b - a > BLOCK:
                    yield row()
                hashes.append(np.insert(words.span_hashes(part, s, e), at, np.uint64(_END)))
                classes.append(np.insert(class_of(part, e, s), at, 0))
                counts.append(n + 1)
                ids += doc_ids[a:b]
                held += held_[a:b]
                total += int(at[-1]) + b - a
        if ids:
            yield row()

    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2
    return docs.select("doc_id", held.alias("held"), "text").mapInArrow(find, BLOCKS)


def types(blocks: DataFrame) -> DataFrame:
    """(block, place, hash, class, n): the different words of each block."""

    def find(batches):
        for batch in batches:
            for row in batch.to_pylist():
                hashes = np.frombuffer(row["types"], "<u8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(hashes), row["block"])),
                        pa.array(np.arange(len(hashes), dtype=np.int32)),
                        pa.array(hashes.view(np.int64)),
                        pa.array(np.frombuffer(row["classes"], np.uint8).astype(np.int32)),
                        pa.array(np.frombuffer(row["trained"], "<i4").astype(np.int64)),
                    ],
                    ["block", "place", "hash", "class", "n"],
                )

    return blocks.mapInArrow(find, "block long, place int, hash long, class int, n long")


class Model:
    """Vectors of read words and outputs, position weights; the last column
    of the outputs is their bias."""

    def __init__(self, unigram: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.unigram = unigram  # share of every output, all positive
        self.read = rng.normal(0, 0.1, (OUTPUTS + 1, WIDTH)).astype(np.float32)
        self.out = rng.normal(0, 0.1, (OUTPUTS, WIDTH + 1)).astype(np.float32)
        self.out[:, WIDTH] = np.log(unigram)
        self.weight = np.full((CONTEXT, WIDTH), 1.0 / CONTEXT, np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.read, self.out, self.weight)]).astype(np.float64)

    def fill(self, flat: np.ndarray) -> None:
        at = 0
        for name in ("read", "out", "weight"):
            x = getattr(self, name)
            setattr(self, name, flat[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size

    def predicted(self, context: np.ndarray) -> np.ndarray:
        """Predicted vectors, with a 1 for the bias, for contexts (n,
        CONTEXT)."""
        weighted = np.zeros((CONTEXT, OUTPUTS + 1, WIDTH + 1), np.float32)
        np.multiply(self.read, self.weight[:, None, :], out=weighted[:, :, :WIDTH])
        weighted[0, :, WIDTH] = 1
        out = weighted[0].take(context[:, 0], 0)
        for j in range(1, CONTEXT):
            out += weighted[j].take(context[:, j], 0)
        return out

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithms, normalised over all outputs, once for each
        different context."""
        at = np.zeros(len(target), np.int64)
        for j in range(CONTEXT):
            at = at * (OUTPUTS + 1) + context[:, j]
        order = np.argsort(at, kind="stable")
        new = np.ones(len(at), bool)
        new[1:] = at[order[1:]] != at[order[:-1]]
        which = np.empty(len(at), np.int64)
        which[order] = np.cumsum(new) - 1
        q = self.predicted(context[order[new]])
        total = np.empty(len(q))
        for a in range(0, len(q), BATCH):
            x = q[a : a + BATCH] @ self.out.T
            # Products of trained vectors are small; exp is safe up to 80.
            top = max(0.0, float(x.max()) - 80)
            if top:
                x -= top
            np.exp(x, out=x)
            total[a : a + BATCH] = top + np.log(x.sum(1))
        out = np.empty(len(target))
        for a in range(0, len(target), BATCH):
            own = self.out.take(target[a : a + BATCH], 0)
            out[a : a + BATCH] = np.einsum("ij,ij->i", q.take(which[a : a + BATCH], 0), own)
        return out - total[which]

    def train(self, context: np.ndarray, target: np.ndarray, seed: int, state: dict, rate: float) -> None:
        """One pass, by noise-contrastive estimation; all tokens of a batch
        share their noise."""
        rng = np.random.default_rng(seed)
        log_noise = np.log(NOISE_WEIGHT * self.unigram).astype(np.float32)
        squares = state.setdefault("squares", {n: np.full_like(getattr(self, n), 1e-6) for n in ("read", "out", "weight")})
        order = rng.permutation((len(target) + BATCH - 1) // BATCH)
        noises = rng.choice(OUTPUTS, size=(len(order), NOISE), p=self.unigram).astype(target.dtype)
        share, rate = np.float32(NOISE_WEIGHT / NOISE), np.float32(rate)
        place = (np.arange(CONTEXT) * (OUTPUTS + 1)).astype(np.int16)[:, None]
        sums = np.empty((CONTEXT * (OUTPUTS + 1), WIDTH), np.float32)
        for k in order:
            c = context[k * BATCH : (k + 1) * BATCH]
            w, noise = target[k * BATCH : (k + 1) * BATCH], noises[k]
            n = np.float32(len(w))
            q = self.predicted(c)
            own, fake = self.out.take(w, 0), self.out.take(noise, 0)
            # Chance that a token, or a noise word, was taken for noise.
            miss = np.einsum("ij,ij->i", q, own)
            miss -= log_noise[w]
            np.exp(miss, out=miss)
            miss += 1
            np.reciprocal(miss, out=miss)
            hit = q @ fake.T
            hit -= log_noise[noise]
            np.negative(hit, out=hit)
            np.exp(hit, out=hit)
            hit += 1
            np.divide(-share, hit, out=hit)
            dq = hit @ fake[:, :WIDTH]
            dq += miss[:, None] * own[:, :WIDTH]
            # Only the outputs met are changed.
            at, d = _sums(np.concatenate((w, noise)), np.concatenate((miss[:, None] * q, hit.T @ q)))
            _step(self.out, squares["out"], at, d / n, rate)
            # Sums by position and word read; all else follows from these.
            at, d = _sums((c.T + place).ravel(), dq)
            sums.fill(0)
            sums[at] = d / n
            by_word = sums.reshape(CONTEXT, OUTPUTS + 1, WIDTH)
            d_read = np.einsum("jrw,jw->rw", by_word, self.weight)
            d_weight = np.einsum("jrw,rw->jw", by_word, self.read)
            _step(self.read, squares["read"], slice(None), d_read, rate)
            _step(self.weight, squares["weight"], slice(None), d_weight, rate)


def _step(x: np.ndarray, squares: np.ndarray, at, d: np.ndarray, rate: np.float32) -> None:
    squares[at] += d * d
    x[at] += rate * d / np.sqrt(squares[at])


def _sums(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of rows, and the sums of the rows of each.  Fewer rows than
    numbers are taken again and again."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    if len(at) > len(rows):
        order %= len(rows)
    return at[first], np.add.reduceat(rows.take(order, 0), first)


class Reader:
    """Blocks as outputs and contexts of the model."""

    def __init__(self, frequent: np.ndarray):
        self.order = np.argsort(frequent)
        self.frequent = frequent[self.order]

    def outputs(self, row) -> np.ndarray:
        """Output of each of the block's types."""
        hashes = np.frombuffer(row["types"], "<u8")
        kind = np.frombuffer(row["classes"], np.uint8).astype(np.int16)
        at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
        return np.where(self.frequent[at] == hashes, CLASSES + self.order[at], kind).astype(np.int16)

    def read(self, row):
        """(outputs of the tokens, contexts, first and last token of every
        document)."""
        ends = np.frombuffer(row["ends"], "<i4").astype(np.int64)
        begin = np.concatenate(([0], ends[:-1]))
        target = self.outputs(row)[unpacked(row["tokens"])]
        context = np.full((len(target), CONTEXT), START, np.int16)
        place = np.arange(len(target)) - np.repeat(begin, ends - begin)
        for j in range(CONTEXT):
            inside = place > j
            context[inside, j] = target[np.flatnonzero(inside) - j - 1]
        return target, context, begin, ends


def fit(blocks: DataFrame, reader: Reader, unigram: np.ndarray, total: int) -> Model:
    """Rounds of training in every task, averaged by tokens."""
    model = Model(unigram)
    for round_ in range(ROUNDS if total else 0):
        start = model.flat()

        def learn(batches, start=start, round_=round_):
            own, state, seen = Model(unigram), {}, 0
            own.fill(start)
            for batch in batches:
                for row in batch.to_pylist():
                    target, context, begin, ends = reader.read(row)
                    mine = np.repeat(np.frombuffer(row["held"], np.uint8) == 0, ends - begin)
                    target, context = target[mine], context[mine]
                    if len(target):
                        seed = [row["block"] >> 32, row["block"] & 0xFFFFFFFF, round_]
                        own.train(context, target, seed, state, RATE / np.sqrt(1 + round_))
                        seen += len(target)
            if seen:
                flat = own.flat()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), seen, np.float64))],
                    ["place", "total", "tokens"],
                )

        found = blocks.mapInArrow(learn, "place long, total double, tokens double")
        means = found.groupBy("place").agg((F.sum("total") / F.sum("tokens")).alias("mean")).toArrow()
        if len(means):
            start[means["place"].to_numpy()] = means["mean"].to_numpy()
            model.fill(start)
    return model


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score;
    learning from the documents that are not held out."""
    ship(docs.sparkSession)
    blocks = saved(token_blocks(documents(docs, "doc_id", "text")), "tokens")
    found = types(blocks)
    counts = saved(found.groupBy("hash").agg(F.sum("n").alias("n"), F.max("class").alias("class")).where("n > 0"), "counts")
    top = counts.where(F.col("hash") != _signed(_END)).orderBy(F.desc("n"), "hash").limit(FREQUENT).collect()
    frequent = np.array([_END, *(r["hash"] & (2**64 - 1) for r in top)], np.uint64)
    listed = [_signed(int(h)) for h in frequent]
    rare = counts.where(~F.col("hash").isin(listed))
    n_end = counts.where(F.col("hash") == _signed(_END)).select("n").first()
    frequent_n = np.array([n_end[0] if n_end else 0, *(r["n"] for r in top)], np.float64)
    sums = rare.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect()
    class_n, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sums:
        class_n[r["class"]], class_types[r["class"]] = r["n"], r["types"]
    total = int(class_n.sum() + frequent_n.sum())
    n_types = int(class_types.sum() + (frequent_n > 0).sum())
    share = np.zeros(OUTPUTS)
    share[:CLASSES] = class_n
    share[CLASSES : CLASSES + len(frequent)] = frequent_n
    share = np.maximum(share, 0.1)  # no output is impossible
    unigram = share / share.sum()
    reader = Reader(frequent)
    model = fit(blocks, reader, unigram, total)
    log_class = np.zeros(OUTPUTS)
    log_class[:CLASSES] = np.log10(class_n + class_types + 1)  # and 0 for a word that is an output
    # Counts of a block's rare words; the others' are known everywhere.
    replies = found.select("block", "place", "hash").join(rare.select("hash", "n"), "hash").select("block", "place", "n")

    def score(left, right):
        out = []
        place, n = right["place"].to_numpy(), right["n"].to_numpy()
        for row in left.to_pylist():
            target, context, begin, ends = reader.read(row)
            tokens = unpacked(row["tokens"])
            output = reader.outputs(row).astype(np.int64)
            count = np.zeros(len(output))
            count[place] = n
            whole = output >= CLASSES
            count[whole] = frequent_n[output[whole] - CLASSES]
            log_count = np.log10(count + 1)
            within = np.where(whole, 0.0, log_count - log_class[output])[tokens]
            p = model.log_probabilities(context, target) / np.log(10) + within
            size = ends - begin
            out.append(
                pa.table(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "held_out": pa.array(np.frombuffer(row["held"], np.uint8) == 1),
                        "n_tokens": pa.array(size),
                        "n_known": pa.array(np.add.reduceat((count > 0)[tokens].astype(np.int64), begin)),
                        "train_tokens": pa.array(np.full(len(size), total)),
                        "base_score": pa.array(
                            np.add.reduceat(log_count[tokens], begin) - size * np.log10(total + n_types + 1)
                        ),
                        "score": pa.array(np.add.reduceat(p, begin)),
                    }
                )
            )
        return pa.concat_tables(out)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    blocks = blocks.drop("trained")
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(score, schema)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h
