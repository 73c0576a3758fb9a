"""Writing one batch's routed outputs to their sinks."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Mapping, Sequence

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from ..schemas import SINK_SCHEMAS
from .tables import check_frame

# Output names, in the order a batch writes them: the clean table last, so a
# reader of the clean table never sees a batch whose side tables are missing.
SINK_ORDER = ("qc_audit_log_table", "qc_failed_table", "corrupt_records", "device_data")


class SinkWriteError(RuntimeError):
    """A sink failed; ``table`` names it, the message is the cause's."""

    def __init__(self, table: str, cause: BaseException):
        super().__init__(str(cause))
        self.table = table
        self.cause = cause


def write_routed(
    outputs: Mapping[str, DataFrame],
    sinks: Mapping[str, object],
    batch_id: int,
    run_id: str,
    order: Sequence[str] = SINK_ORDER,
    concurrent: bool = True,
    rescue: Callable[[str, DataFrame, BaseException], None] | None = None,
    manifest=None,
    counts: Mapping[str, int] | None = None,
    published: Sequence[str] = (),
) -> None:
    """Check each frame against its table definition and write it.

    The side tables (all but the last in ``order``) are written as
    concurrent Spark jobs from driver threads; the last (the clean table)
    only after they all succeeded.  Concurrent jobs overlap their fixed
    costs and fill each other's idle task slots.

    Raises ``SinkWriteError`` for the first failing table in ``order``;
    ``rescue`` (table, frame, error) may write a failed table otherwise, or
    raise.  With a ``manifest`` the batch is hidden before the first write and
    published, with its ``counts``, after the last; ``published`` names
    further tables that were written for it.
    """
    names = [n for n in order if n in sinks]
    if not names:
        return
    spark = outputs[names[0]].sparkSession
    if manifest is not None:
        manifest.withdraw(spark, batch_id, run_id)

    def one(name: str) -> None:
        try:
            frame = check_frame(outputs[name], SINK_SCHEMAS[name], name)
            try:
                sinks[name].write(frame, batch_id, run_id)
            except Exception as e:  # noqa: BLE001 - the rescue decides
                if rescue is None:
                    raise
                rescue(name, frame, e)
        except Exception as e:  # noqa: BLE001 - re-raised with the table name
            raise SinkWriteError(name, e) from e

    side, last = names[:-1], names[-1]
    if concurrent and len(side) > 1:
        # Worker threads inherit the caller's JVM local properties and job
        # tags (streaming query id, job group), so their jobs belong to, and
        # are cancelled with, the caller's query.
        inherit = inheritable_thread_target(spark)
        with ThreadPoolExecutor(max_workers=len(side), thread_name_prefix="sink") as pool:
            futures = [pool.submit(inherit(one), n) for n in side]
        for f in futures:
            if f.exception() is not None:
                raise f.exception()
    else:
        for n in side:
            one(n)
    one(last)
    if manifest is not None:
        manifest.publish(spark, batch_id, run_id, [*names, *published], counts)
