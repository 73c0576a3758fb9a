"""Writing a batch without the records that a store refuses.

A write fails as a whole, whatever record it was.  The batch is then halved by
source partition and range of offsets, and each half is written by itself,
halved again where it fails, until a failing range is a single offset: that
is left out and reported, all else is written.  A batch of n records with one
bad one costs about 2 log2(n) smaller writes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class TooManyRefused(RuntimeError):
    """More offsets fail than records can be to blame for: the store is."""


@dataclass(frozen=True)
class Span:
    """Offsets ``first`` to ``last`` of a source partition."""

    partition: int | None
    first: int
    last: int

    def within(self) -> Column:
        # On the plain columns, so that files without such records are not read.
        offset = F.col("kafka_offset")
        inside = offset.between(self.first, self.last)
        if self.first <= -1 <= self.last:
            inside = inside | offset.isNull()
        return F.col("kafka_partition").eqNullSafe(F.lit(self.partition)) & inside


@dataclass(frozen=True)
class Refused:
    span: Span
    cause: BaseException

    def message(self) -> str:
        return f"partition {self.span.partition} offset {self.span.first}: {self.cause}"


def _offset() -> Column:
    # Kafka's offsets begin at 0; records without one stand before them.
    return F.coalesce(F.col("kafka_offset"), F.lit(-1))


def halves(spans: list[Span]) -> list[list[Span]]:
    """Two parts: of the spans, or of the offsets of a single one."""
    if len(spans) > 1:
        return [spans[: len(spans) // 2], spans[len(spans) // 2 :]]
    (s,) = spans
    middle = (s.first + s.last) // 2
    return [[Span(s.partition, s.first, middle)], [Span(s.partition, middle + 1, s.last)]]


def write_rest(sink, frame: DataFrame, batch_id: int, run_id: str, limit: int = 8) -> list[Refused]:
    """Write ``frame`` (a staged or persisted one) after a failed write of the
    whole, without the offsets that fail by themselves; returns those.  More
    than ``limit`` of them raise ``TooManyRefused``, and the batch is as if
    not written."""
    spark = frame.sparkSession
    ranges = frame.groupBy("kafka_partition").agg(F.min(_offset()).alias("a"), F.max(_offset()).alias("b")).collect()
    spans = sorted((Span(r["kafka_partition"], r["a"], r["b"]) for r in ranges), key=repr)
    sink.clear(spark, batch_id, run_id)
    waiting, refused = [spans] if spans else [], []
    while waiting:
        some = waiting.pop()
        try:
            sink.append(frame.where(reduce(or_, (s.within() for s in some))), batch_id, run_id)
        except Exception as e:  # noqa: BLE001 - whatever the store refuses
            if len(some) > 1 or some[0].first < some[0].last:
                waiting += reversed(halves(some))
                continue
            refused.append(Refused(some[0], e))
            if len(refused) > limit:
                sink.clear(spark, batch_id, run_id)
                raise TooManyRefused(f"more than {limit} offsets fail, the last: {refused[-1].message()}") from e
    return refused
