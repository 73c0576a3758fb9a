"""Connected components of a graph held as a table, by repeated joins.

Every vertex takes the least label among its own and its neighbours'; then
labels are followed one step further (the label's own label).  The rounds
end when no label falls any more.  Labels stay in tables of the shared
folder; the driver sees one sum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long; a saved table, as every round reads it) -> one
    row per vertex (id, label): label is the least id of its component.
    Vertices without an edge are not listed; an empty table gives an empty
    table."""
    a, b = F.col("a"), F.col("b")
    ways = F.array(*(F.struct(x.alias("a"), y.alias("b")) for x, y in ((a, b), (b, a))))
    both = edges.where("a <> b").select(F.inline(ways))
    first = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label"))
    labels = saved(first.select("id", F.least("id", "label").alias("label")), "labels")
    total = None
    while True:
        # Labels only fall: they have settled when their sum has.
        before, total = total, labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == before:
            return labels
        further = labels.select(F.col("id").alias("b"), F.col("label"))
        near = both.join(further, "b").select(F.col("a").alias("id"), "label").unionByName(labels)
        near = near.groupBy("id").agg(F.min("label").alias("label"))
        near = saved(near, "labels")
        jump = near.select(F.col("id").alias("label"), F.col("label").alias("next"))
        labels = saved(near.join(jump, "label").select("id", F.col("next").alias("label")), "labels")
