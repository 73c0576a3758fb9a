"""Which parts of a document an earlier document holds already.

Parts are told apart by digests of one number (64 bits) or two (128 bits).  A
first pass over the texts writes every document's different digests.  They are then counted
with partial aggregation; those of two or more documents are written (few),
and joined back.  What comes back to a document is the first number of each:
among its own parts that is enough.  Both sides of that join are plain tables, so adaptive execution splits
a digest that very many documents share.  No group is ever gathered: what
comes back to a document is bounded by its own length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import KEY, order_key, saved, ship


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("key", order_key())


def digests(docs: DataFrame, parts_of) -> DataFrame:
    """(key, digest, other), each once a document.  ``parts_of(data,
    offsets)`` gives the two numbers of every part of a run of texts (or one,
    and None) and how many parts each text has."""
    ship(docs.sparkSession)

    def find(batches):
        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            key = batch.column("key")
            for a, b in words.parts(offsets):
                found, other, count = parts_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                owner = np.repeat(np.arange(a, b), count)
                order = np.lexsort((found, owner))
                found, owner = found[order], owner[order]
                other = None if other is None else other[order]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        key.take(pa.array(owner[new])),
                        pa.array(found[new].view(np.int64)),
                        pa.nulls(int(new.sum()), pa.int64()) if other is None else pa.array(other[new].view(np.int64)),
                    ],
                    ["key", "digest", "other"],
                )

    return keyed(docs).select("key", "text").mapInArrow(find, f"key {KEY}, digest long, other long")


def held_before(found: DataFrame) -> DataFrame:
    """(key, digests): for each document that has any, its digests that a
    document before it holds."""
    found = saved(found, "digests")
    first = found.groupBy("digest", "other").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
    first = saved(first.where("n > 1").select("digest", "other", "first"), "repeated")
    same = (found["digest"] == first["digest"]) & found["other"].eqNullSafe(first["other"])
    later = found.join(first, same).where("key > first").select("key", found["digest"])
    return later.groupBy("key").agg(F.collect_set("digest").alias("digests"))


def attach(docs: DataFrame, later: DataFrame) -> DataFrame:
    """``docs`` with the column ``digests``; both are shuffled by document."""
    return keyed(docs).join(later, "key", "left").drop("key")


def held(found: np.ndarray, count: np.ndarray, before) -> np.ndarray:
    """Marks what a document before holds (``before``: Arrow lists) or what
    came earlier in the same document."""
    owner = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((np.arange(len(found)), found, owner))
    f, o = found[order], owner[order]
    again = np.zeros(len(found), bool)
    again[order[1:]] = (f[1:] == f[:-1]) & (o[1:] == o[:-1])
    ends = np.concatenate(([0], np.cumsum(count)))
    for i, digests_ in enumerate(before):
        if digests_.is_valid and count[i]:
            a, b = ends[i], ends[i + 1]
            again[a:b] |= np.isin(found[a:b], digests_.values.to_numpy().view(np.uint64))
    return again
