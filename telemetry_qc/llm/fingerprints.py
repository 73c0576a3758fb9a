"""Document fingerprints: MinHash over word shingles.

A shingle is five consecutive words; four marks stand before the first word,
so that the first words and short texts make shingles too.  128 universal
hash permutations (odd factor and summand modulo 2**32) over the 32-bit
shingle hashes, each keeping its minimum, make the signature; a fingerprint
is the low 16 bits of each, in hex.  The likeness of two fingerprints, the
share of equal places, estimates the Jaccard similarity of the shingles.

``edited_fingerprints`` compares every text with an edited one that ends like
the next document (by descending doc_id).  Documents are dealt by ranges of
doc_id, sorted within them, and the first of each range is also given to the
range before it; the texts are shuffled once and read as a stream.

``similar_documents`` finds near-duplicates: bands of four places each are
joined in Spark, the Jaccard similarity of the plain five-word shingles (all
words, if there are fewer) of the candidates is verified.

Null text is empty text, of no shingles; its fingerprint is all ``ffff``.
Words end at space and the characters 9 to 13.  Repeated rows give a row
each; those of one doc_id come in the order of a hash of the text, and a null
doc_id is last.  A single document is its own next.  An empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .classes import near_classes
from .common import documents, ship

SHINGLE = 5
PLACES = 128
BAND = 4
SIMILARITY = 0.8

_rng = np.random.default_rng(50_321)
_A = (_rng.integers(0, 1 << 31, PLACES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _rng.integers(0, 1 << 32, PLACES, dtype=np.uint32)[:, None]
_FACTORS = words.mix(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | np.uint64(1)
_NONE = np.full(PLACES, 0xFFFFFFFF, np.uint32)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """32-bit hashes of the shingles of a document's word hashes."""
    n = len(hashes)
    padded = np.concatenate((np.zeros(SHINGLE - 1, np.uint64), hashes))
    return (words.mix(sum(padded[i : n + i] * _FACTORS[i] for i in range(SHINGLE))) >> np.uint64(32)).astype(np.uint32)


def signature(found: np.ndarray) -> np.ndarray:
    """Minimum of every permutation."""
    out = _NONE
    for at in range(0, len(found), 1024):
        h = _A * found[at : at + 1024]
        h += _B
        out = np.minimum(out, h.min(1))
    return out


def places(found: np.ndarray) -> np.ndarray:
    return (found & np.uint32(0xFFFF)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _shingled(texts: list[str]) -> list[np.ndarray]:
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw], dtype=np.int64)))
    data = np.frombuffer(b"".join(raw), np.uint8)
    out = []
    for a, b in words.parts(offsets):
        hashes, count = words.word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        ends = np.cumsum(count)
        out += [shingles(hashes[e - n : e]) for e, n in zip(ends.tolist(), count.tolist())]
    return out


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the next text's beginning."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _rows(doc_ids: list, texts: list[str]):
    """Fingerprint rows of all but the last document, which only follows."""
    changed = [edited(t, f) for t, f in zip(texts, texts[1:])]
    own, other = _shingled(texts), _shingled(changed)
    prints, out = [], []
    edits = []
    for i, x in enumerate(own):
        if i == len(own) - 1:
            prints.append(places(signature(x)))
            break
        # Both begin alike: that part is hashed once.
        y = other[i]
        n = min(len(x), len(y))
        differ = x[:n] != y[:n]
        same = int(differ.argmax()) if n and differ.any() else n
        begin = signature(x[:same])
        prints.append(places(np.minimum(begin, signature(x[same:]))))
        edits.append(places(np.minimum(begin, signature(y[same:]))))
    for i, change in enumerate(changed):
        out.append(
            (
                doc_ids[i],
                len(texts[i]),
                hashlib.sha256(change.encode()).hexdigest(),
                prints[i].tobytes().hex(),
                edits[i].tobytes().hex(),
                likeness(prints[i], edits[i]),
                likeness(prints[i], prints[i + 1]),
            )
        )
    return out


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next."""
    spark = docs.sparkSession
    ship(spark)
    docs = documents(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges).alias("cuts"))
    cuts = sorted(set(ids.first()["cuts"] or []))
    # Range 0 has the largest ids; without an id: the last range.
    place = F.size(F.filter(F.array(*(F.lit(c).cast("long") for c in cuts)).cast("array<long>"), lambda c: F.col("doc_id") < c))
    docs = docs.withColumns(
        {
            "hash": F.xxhash64("text"),
            "range": F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(place).cast("int"),
        }
    )
    heads = docs.groupBy("range").agg(F.max(F.struct("doc_id", "hash")).alias("head")).orderBy("range").collect()
    before = [(heads[i - 1]["range"], *h["head"]) for i, h in enumerate(heads)]
    heads = F.broadcast(spark.createDataFrame(before, "before int, head_id long, head_hash long"))
    spread = docs.join(
        heads, docs["doc_id"].eqNullSafe(F.col("head_id")) & (docs["hash"] == F.col("head_hash")), "left"
    ).select("doc_id", "text", "hash", "range", "before")
    # The first of a range follows the last of the range before it.
    spread = spread.select(
        "doc_id",
        "text",
        "hash",
        F.inline(
            F.filter(
                F.array(
                    F.struct(F.col("range").alias("range"), F.lit(False).alias("extra")),
                    F.struct(F.col("before").alias("range"), F.lit(True).alias("extra")),
                ),
                lambda x: x["range"].isNotNull(),
            )
        ),
    )
    ordered = spread.repartition(ranges, "range").sortWithinPartitions(
        "range", "extra", F.col("doc_id").desc_nulls_last(), F.col("hash").desc()
    )

    def compare(batches):
        carry = None  # the last row of the batch before
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("range", "extra", "doc_id", "text"))))
            if carry:
                rows.insert(0, carry)
            first, total = 0, 0
            for i, row in enumerate(rows):
                total += len(row[3])
                last = i + 1 == len(rows)
                if not last and rows[i + 1][0] == row[0] and not row[1] and total < words.PART_BYTES:
                    continue
                # rows[first..i] follow one another; row i only follows.
                some = rows[first : i + 1]
                if len(some) > 1:
                    out = _rows([r[2] for r in some], [r[3] for r in some])
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                first, total = (i + 1 if row[1] else i), 0
            carry = rows[-1] if rows and not rows[-1][1] else None

    return ordered.select("range", "extra", "doc_id", "text").mapInArrow(
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def band_keys(hashes: np.ndarray) -> np.ndarray:
    found = signature(shingles(hashes)).astype(np.uint64).reshape(-1, BAND)
    return words.mix((found * _FACTORS[:BAND]).sum(1, dtype=np.uint64) + np.arange(PLACES // BAND, dtype=np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of the sets of five-word shingles, from word hashes; two texts without
    words are alike."""

    def of(w):
        n, k = len(w), min(SHINGLE, len(w))
        w = w.astype(np.uint64)
        return np.unique(words.mix(sum((w[i : n - k + 1 + i] * _FACTORS[i] for i in range(k)), np.full(max(n - k + 1, 0), k, np.uint64))))

    if not len(a) and not len(b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    x, y = of(a), of(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def near(a: np.ndarray, b: np.ndarray) -> bool:
    return jaccard(a, b) >= SIMILARITY


def near_many(texts: list[np.ndarray]):
    """A function of a place and earlier places that tells which are near."""
    return lambda x, ys: np.array([near(texts[x], texts[y]) for y in ys], bool)


def rare_shingles(w: np.ndarray) -> tuple[np.ndarray, int]:
    """The set of shingles, and how many of the rarest it takes that a
    similar text has one of its own rarest among them: similar texts share
    the part SIMILARITY of each."""
    n, k = len(w), min(SHINGLE, len(w))
    w = w.astype(np.uint64)
    found = np.unique(words.mix(sum((w[i : n - k + 1 + i] * _FACTORS[i] for i in range(k)), np.full(max(n - k + 1, 0), k, np.uint64))))
    return found, len(found) - max(1, int(np.ceil(SIMILARITY * len(found) - 1e-9))) + 1


def similar_documents(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, kept; one row per document."""
    return near_classes(docs, band_keys, near, near_many, rare_shingles).drop("key")
