"""Fault injection for sinks: exercise the failure policies and replay."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame


class SinkUnavailable(RuntimeError):
    pass


@dataclass
class FailOnce:
    """Wraps a sink; the first write of each of ``batches`` raises, later
    writes (a replay after restart) go through."""

    inner: object
    batches: tuple[int, ...] = (1,)
    failed: set = field(default_factory=set)

    @property
    def name(self) -> str:
        return self.inner.name

    def write(self, df: DataFrame, batch_id: int, run_id: str) -> None:
        if batch_id in self.batches and batch_id not in self.failed:
            self.failed.add(batch_id)
            raise SinkUnavailable(f"sink {self.name} unavailable")
        self.inner.write(df, batch_id, run_id)

    def read(self, spark):
        return self.inner.read(spark)


class RecordRefused(RuntimeError):
    pass


@dataclass
class RefuseRecords:
    """Wraps a sink; a write with any record that ``bad`` holds for raises,
    as a whole, as a database does."""

    inner: object
    bad: Column
    writes: int = 0

    @property
    def name(self) -> str:
        return self.inner.name

    def _checked(self, df: DataFrame) -> DataFrame:
        self.writes += 1
        if df.where(self.bad).limit(1).count():
            raise RecordRefused(f"sink {self.name} refuses a record")
        return df

    def write(self, df: DataFrame, batch_id: int, run_id: str) -> None:
        self.inner.write(self._checked(df), batch_id, run_id)

    def append(self, df: DataFrame, batch_id: int, run_id: str) -> None:
        self.inner.append(self._checked(df), batch_id, run_id)

    def clear(self, spark, batch_id: int, run_id: str) -> None:
        self.inner.clear(spark, batch_id, run_id)

    def read(self, spark):
        return self.inner.read(spark)
