"""Hard negatives by Fagin's threshold algorithm over whole-number scores.

A component c of a vector becomes x = floor(256 * c); a row's score is its
inner product with an anchor.  An anchor's positives are its best other rows
of the same label; for each of them, the window of a positive's scores asks for
the best rows of other labels within it.

Rows are dealt by a hash into blocks of about ``BLOCK_ROWS`` (for positives,
the rows of each label by themselves, so that a label with a third of the rows
has as many blocks as it needs), anchors into groups of ``GROUP_ANCHORS``.
Every group meets every block in a task of bounded size.  There each
dimension has a list of the block's rows, sorted by their component.  An
anchor reads all lists step by step, from the end that the sign of its own
component favours (sorted access); rows met for the first time are scored from
their vectors (random access).  What the rows read last would score together,
the threshold, bounds all rows not met yet: reading ends as soon as it is
strictly below the k-th score of each window, or below the window itself.

The blocks are gone through in two rounds.  The first, of about the square
root of their number, gives k-th scores that the other blocks have to reach,
so that these return few rows and stop early.  Scores that reach the k-th stay, so that ties are
complete; they go to the smaller vec_id.

Rows with a null label, vec_id or vector, with null or non-finite components,
or with a component of 2**18 or more in size (whose scores would not fit a
long) take no part; nor do empty vectors and vectors of another length than
most (ties: the shorter).  Rows equal in vec_id, label and vector count once.
Other rows of one vec_id are anchors and candidates of their own, but never
each other's positives or negatives; ties between them go by a hash.  Fewer candidates than asked for are returned
all.  Without anchors, positives or negatives, and for an empty table, the
result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, saved, ship, small

SCALE = 256
#: Components of this size or more take no part.
LARGEST = float(2**18)
BLOCK_ROWS = 1_024
GROUP_ANCHORS = 2_048
#: Rows read from each list at first; four times as many in every next step.
STEP = 8

#: Scores below all that can occur, and above.
LOWEST, HIGHEST = -(2**62), 2**62


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, x of the rows that take part."""
    v = pick(vectors, {"vec_id": "long", "label": "long", "embedding": "array<double>"})
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    v = v.where("vec_id is not null and label is not null and embedding is not null and size(embedding) > 0").where(~bad)
    return v.select("vec_id", "label", F.transform("embedding", lambda c: F.floor(c * SCALE).cast("int")).alias("x"))


class Lists:
    """Vectors with a sorted list of places for every dimension."""

    def __init__(self, x: np.ndarray):
        self.x, self.floats = x, x.astype(float)
        self.order = np.argsort(x, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(x, self.order.T, 0).T
        self.largest = int(np.abs(x).max(initial=0))

    def within(self, a: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, k: int):
        """For every window [low, high] the places and scores of rows that are
        ``allowed``, in the window, and not below ``least`` or the k-th score:
        the k best, with all that equal the last."""
        n, d = self.x.shape
        up = a >= 0  # lists read from their largest component on
        low = np.maximum(low, least)
        exact = self.largest * int(np.abs(a).max(initial=0)) * d < 2**53
        # Doubles add whole numbers exactly up to 2**53.
        x, by = (self.floats, a.astype(float)) if exact else (self.x, a)
        met = np.zeros(n, bool)
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        read, step = 0, STEP
        while True:
            end = min(n, read + step)
            before = met.copy()
            met[self.order[up, n - end : n - read]] = True
            met[self.order[~up, read:end]] = True
            new = np.flatnonzero(met & ~before & allowed)
            places = np.concatenate([places, new])
            scores = np.concatenate([scores, (x[new] @ by).astype(np.int64)])
            inside = (scores >= low[:, None]) & (scores <= high[:, None])
            bound = low.copy()
            for w in np.flatnonzero(inside.sum(1) >= k):
                bound[w] = np.partition(scores[inside[w]], -k)[-k]
            bound[low > high] = HIGHEST
            last = np.where(up, self.sorted[:, n - end], self.sorted[:, end - 1])
            if end == n or int(last @ a) < bound.min(initial=HIGHEST):
                return [(places[keep], scores[keep]) for keep in inside & (scores >= bound[:, None])]
            read, step = end, 4 * step


def met(rows: DataFrame, asks: DataFrame, spaces: DataFrame, seeds: bool, same_label: bool, k: int) -> DataFrame:
    """(ask, window, row, vec_id, score) of the rows that may be among the k
    best of a window, from each block of the first round (``seeds``) or of the
    second; ``asks`` (space, ask, anchor_id, label, x, low, high, least), the
    last three lists with an entry for every window; ``rows`` (space, block,
    row, vec_id, label, x); ``spaces`` (space, blocks, groups)."""
    seed = F.col("block") % F.ceil(F.sqrt("blocks")) == 0
    chosen = seed if seeds else ~seed
    left = rows.join(spaces, "space").where(chosen)
    left = left.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    right = asks.join(spaces, "space").withColumn("group", F.pmod(F.xxhash64("ask"), "groups"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where(chosen)
    columns = ["space", "block", "group", *asks.columns[1:]]
    right = right.select(*columns).toDF(*columns)  # columns of its own, not those of rows
    names = ["ask", "window", "row", "vec_id", "score"]

    def compare(block, asked):
        found = {c: [np.zeros(0, np.int64)] for c in names}
        if len(block) and len(asked):
            d = len(block["x"][0])
            lists = Lists(vectors(block["x"], d))
            ids, label = block["vec_id"].to_numpy(), block["label"].to_numpy()
            row = block["row"].to_numpy()
            windows = [[np.array(w, np.int64) for w in asked[c].to_pylist()] for c in ("low", "high", "least")]
            own = zip(vectors(asked["x"], d), asked["ask"].to_pylist(), asked["anchor_id"].to_pylist(), asked["label"].to_pylist())
            for (a, ask, anchor, mine), *bounds in zip(own, *windows):
                allowed = (ids != anchor) & ((label == mine) == same_label)
                for w, (at, score) in enumerate(lists.within(a, allowed, *bounds, k)):
                    parts = (np.full(len(at), ask), np.full(len(at), w), row[at], ids[at], score)
                    for c, part in zip(names, parts):
                        found[c].append(part)
        return pa.table({c: pa.array(np.concatenate(parts), pa.int64()) for c, parts in found.items()})

    return (
        left.select("space", "block", "group", "row", "vec_id", "label", "x")
        .groupBy("space", "block", "group")
        .cogroup(right.groupBy("space", "block", "group"))
        .applyInArrow(compare, ", ".join(f"{c} long" for c in names))
    )


def vectors(column, d: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def best(rows: DataFrame, asks: DataFrame, blocks: DataFrame, same_label: bool, k: int) -> DataFrame:
    """(ask, window, row, vec_id, score, rank): the k best rows of each window
    of ``asks`` (space, ask, anchor_id, label, x, low, high); ``blocks``
    (space, blocks)."""
    groups = asks.groupBy("space").agg(F.ceil(F.count(F.lit(1)) / GROUP_ANCHORS).alias("groups"))
    spaces = small(saved(blocks.join(groups, "space"), "spaces"))
    order = Window.partitionBy("ask", "window").orderBy(F.desc("score"), "vec_id", "row")
    top = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    none = F.transform("low", lambda _: F.lit(LOWEST).cast("long"))
    first = saved(top(met(rows, asks.withColumn("least", none), spaces, True, same_label, k)), "seeds")
    kth = first.where(F.col("rank") == k).groupBy("ask").agg(
        F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("kth")
    )
    least = F.transform("low", lambda _, i: F.coalesce(F.col("kth")[i.cast("long")], F.lit(LOWEST).cast("long")))
    asks = asks.join(kth, "ask", "left").select(*asks.columns, least.alias("least"))
    rest = met(rows, asks, spaces, False, same_label, k)
    return top(first.drop("rank").unionByName(rest))


def mine(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.  Anchors are the rows whose vec_id is divisible by
    ``every``; a negative's score is from ``low_percent`` to ``high_percent``
    of the positive's."""
    spark = vectors.sparkSession
    ship(spark)
    v = usable(vectors)
    lengths = v.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    v = v.where(F.size("x") == lengths[0]["d"]).distinct()
    v = v.withColumn("row", F.xxhash64("label", "x"))
    # A table's column, not a literal: joins on it stay joins on a key.
    v = v.withColumns({"node": F.monotonically_increasing_id(), "all": F.lit(0).cast("long")})
    v = saved(v, "vectors")
    n = v.count()
    deal = lambda blocks: F.pmod(F.xxhash64("node"), blocks).alias("block")
    anchors = v.where(F.col("vec_id") % every == 0)
    anchors = anchors.select(F.col("node").alias("ask"), F.col("vec_id").alias("anchor_id"), "label", "x", "all")

    sizes = v.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"))
    sizes = saved(sizes.withColumnRenamed("label", "space"), "sizes")
    rows = v.withColumn("space", F.col("label")).join(small(sizes), "space")
    rows = rows.select("space", deal(F.col("blocks")), "row", "vec_id", "label", "x")
    widest = [F.array(F.lit(b).cast("long")).alias(c) for b, c in ((LOWEST, "low"), (HIGHEST, "high"))]
    asks = anchors.select(F.col("label").alias("space"), "ask", "anchor_id", "label", "x", *widest)
    found = saved(best(rows, asks, sizes, True, positives), "positives")

    held = found.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("held"))
    held = anchors.join(held, "ask")
    # All labels are one space here.
    space = F.col("all").alias("space")
    sizes = saved(v.groupBy(space).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks")), "sizes")
    rows = v.select(space, deal(F.lit(-(-n // BLOCK_ROWS))), "row", "vec_id", "label", "x")
    score = lambda percent, up: F.transform(
        "held", lambda p: (F.ceil if up else F.floor)(p["score"].cast("decimal(38,0)") * percent / 100).cast("long")
    )
    held = saved(
        held.select(
            space,
            "ask",
            "anchor_id",
            "label",
            "x",
            score(low_percent, True).alias("low"),
            score(high_percent, False).alias("high"),
            "held",
        ),
        "asks",
    )
    found = best(rows, held.drop("held"), sizes, False, negatives)
    chosen = held.select("ask", "anchor_id", F.posexplode("held").alias("window", "positive"))
    return found.join(chosen.withColumn("window", F.col("window").cast("long")), ["ask", "window"]).select(
        "anchor_id",
        F.col("positive.vec_id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
