"""Nearest neighbours by inner product: hierarchical k-means tree, searched
best bin first.

The tree is fitted on a sample of at most about ``sample`` vectors; every
vector is then put into a leaf.  A query goes down the tree with a priority
queue: the node whose best inner product can be expected to be largest is
opened next; leaves come out in the order in which they are worth a visit.
How many are visited is calibrated: for some queries the true neighbours are
found by comparing them with all vectors, and the number of visits is widened
until the leaves visited hold the share ``target`` of them.  Neighbouring
leaves make a block of bounded size (a large leaf makes several); a query goes
once to each block that has leaves for it and is compared with those leaves.

Vectors that are null, zero, or hold null or non-finite components take no
part, nor do rows without vec_id, nor vectors of another length than most.
Rows of one vec_id count as one vector to find, with the best of their
scores, and as one query, whose own rows are all left out.  Equal scores are
ordered by vec_id.  Fewer candidates than ``k`` are returned all; an empty
table, or one without queries, gives an empty table.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, saved, ship

#: Vectors the tree is fitted on, and leaves it may have: 20,000 x 64 numbers
#: are gathered, 4,096 centres are sent to the tasks.
SAMPLE = 20_000
LEAVES = 4_096
LEAF_ROWS = 512
BRANCH = 16
#: Vectors of a block, and queries to it, that one group compares.
GROUP_ROWS = 4_096
CALIBRATION = 200
TARGET = 0.95


def kmeans(x: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    """Cluster of every row; clusters may stay empty."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=k)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return (x @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)


class Tree:
    """Nodes as arrays; ``children[n]`` is empty for a leaf."""

    def __init__(self, x: np.ndarray, rows: int, leaf_rows: int = LEAF_ROWS, leaves: int = LEAVES, seed: int = 1):
        rng = np.random.default_rng(seed)
        weight = rows / max(1, len(x))
        self.centres, self.spread, self.children = [], [], []
        count = 1

        def add(part: np.ndarray) -> int:
            centre = part.mean(0)
            self.centres.append(centre)
            self.spread.append(np.sqrt(((part - centre) ** 2).sum(1).mean() / x.shape[1]) if len(part) else 0.0)
            self.children.append([])
            return len(self.centres) - 1

        waiting = [(-len(x), add(x), np.arange(len(x)))]
        while waiting:  # the largest node is split first
            size, node, at = heapq.heappop(waiting)
            want = int(min(BRANCH, np.ceil(-size * weight / leaf_rows), len(at) // 4, leaves - count + 1))
            if want < 2:
                continue
            near = kmeans(x[at], want, rng)
            groups = [at[near == c] for c in range(want) if (near == c).any()]
            if len(groups) < 2:
                continue
            count += len(groups) - 1
            for group in groups:
                child = add(x[group])
                self.children[node].append(child)
                heapq.heappush(waiting, (-len(group), child, group))
        self.centres = np.array(self.centres)
        self.spread = np.array(self.spread)
        self.expected = np.ones(len(self.spread))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row: at each node on to the nearest centre."""
        out = np.zeros(len(x), np.int64)
        waiting = [(0, np.arange(len(x)))]
        while waiting:
            node, at = waiting.pop()
            out[at] = node
            if self.children[node] and len(at):
                centres = self.centres[self.children[node]]
                near = (x[at] @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
                waiting += [(child, at[near == c]) for c, child in enumerate(self.children[node])]
        return out

    def weigh(self, sizes: dict[int, int]) -> None:
        """Rows below each node; from them how far, in spreads, the best of a
        node's inner products lies above its centre's."""
        rows = np.zeros(len(self.spread))
        for node in range(len(rows) - 1, -1, -1):  # children come after
            rows[node] = sum(rows[c] for c in self.children[node]) + sizes.get(node, 0)
        self.rows = rows
        self.expected = np.sqrt(2 * np.log(np.maximum(rows, 1)))

    def visits(self, q: np.ndarray, leaves: int, rows: int):
        """For every query its leaves, best first: at least ``leaves`` of
        them, and so many that they hold ``rows`` vectors."""
        worth = q @ self.centres.T + np.sqrt((q**2).sum(1))[:, None] * (self.spread * self.expected)
        worth[:, self.rows == 0] = -np.inf
        for one in worth:
            queue, found, held = [(-one[0], 0)], [], 0
            while queue and (len(found) < leaves or held < rows):
                _, node = heapq.heappop(queue)
                if self.children[node]:
                    for child in self.children[node]:
                        if self.rows[child]:
                            heapq.heappush(queue, (-one[child], child))
                elif self.rows[node]:
                    found.append(node)
                    held += self.rows[node]
            yield found


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of row pairs, added up in one fixed order."""
    return (q * x).sum(-1)


def best(
    q: np.ndarray,
    q_ids: np.ndarray,
    x: np.ndarray,
    ids: np.ndarray,
    k: int,
    open_: np.ndarray | None = None,
    take: int | None = None,
):
    """The k best other rows of every query, one for each id, as (query's
    position, position in x, score).  ``open_[i, j]``: whether query i may
    find row j (all, if None); equal rows are alike in that.  Equal vectors
    are found together; a row's id and vector together are stated once.
    ``take``: different vectors looked at first; queries that find fewer than
    k ids among them look at more."""
    order = np.argsort(ids, kind="stable")
    x, ids = np.ascontiguousarray(x[order]), ids[order]
    _, first, group = np.unique(x.view([("", x.dtype)] * x.shape[1]), return_index=True, return_inverse=True)
    group, one = group.ravel(), x[first]
    by = np.argsort(group, kind="stable")
    size = np.bincount(group)
    width = int(min(size.max(), 2 * k + 1))
    at = np.concatenate(([0], np.cumsum(size)[:-1]))[:, None] + np.arange(width)
    members = np.where(np.arange(width) < size[:, None], by[np.minimum(at, len(by) - 1)], -1)
    take = min(len(one), take or k + 12)
    step = max(1, 4_000_000 // (take * width * x.shape[1]))
    out = []
    for a in range(0, len(q), step):
        part, own = q[a : a + step], q_ids[a : a + step]
        near = part @ one.T
        if open_ is not None:
            near[~open_[a : a + step][:, order[first]]] = -np.inf
        if take < len(one):
            top = np.argpartition(-near, take - 1, axis=1)[:, :take]
        else:
            top = np.broadcast_to(np.arange(len(one)), near.shape)
        exact = scores(part[:, None, :], one[top])
        exact[np.isneginf(np.take_along_axis(near, top, 1))] = -np.inf
        cand = members[top].reshape(len(part), -1)
        score = np.repeat(exact, width, axis=1)
        score[(cand < 0) | (ids[cand] == own[:, None])] = -np.inf
        rank = np.lexsort((ids[cand], -score), axis=1)
        cand, score = np.take_along_axis(cand, rank, 1), np.take_along_axis(score, rank, 1)
        # One id once: of equal ids the first, which scores best.
        named = np.argsort(ids[cand], axis=1, kind="stable")
        listed = np.take_along_axis(ids[cand], named, 1)
        again = np.zeros(listed.shape, bool)
        again[:, 1:] = listed[:, 1:] == listed[:, :-1]
        fresh = np.ones(listed.shape, bool)
        np.put_along_axis(fresh, named, ~again, 1)
        keep = fresh & ~np.isneginf(score)
        keep &= np.cumsum(keep, 1) <= k
        i, j = np.nonzero(keep)
        # Places that one id, or the query's own, has taken up.
        found = keep.sum(1)
        lack = np.flatnonzero(found < k) if take < len(one) else np.zeros(0, np.int64)
        full = ~np.isin(i, lack)
        i, j = i[full], j[full]
        out.append((a + i, order[cand[i, j]], score[i, j]))
        if len(lack):
            may = None if open_ is None else open_[a + lack]
            rows, at, more = best(part[lack], own[lack], x, ids, k, None if may is None else may[:, order], 4 * take)
            out.append((a + lack[rows], order[at], more))
    return tuple(map(np.concatenate, zip(*out))) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)


def matrix(column, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: (vec_id, embedding of double)."""
    v = pick(vectors, {"vec_id": "long", "embedding": "array<double>"})
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return v.where("vec_id is not null and embedding is not null").where(~bad).where(some)


def search(vectors: DataFrame, every: int = 20, k: int = 20, target: float = TARGET) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows whose vec_id is
    divisible by ``every``."""
    spark = vectors.sparkSession
    ship(spark)
    # Rows that are stated again take up no places.
    v = usable(vectors).dropDuplicates(["vec_id", "embedding"])
    lengths = v.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], result)
    d, n = lengths[0]
    v = v.where(F.size("embedding") == d)
    share = min(1.0, SAMPLE / n)
    sample = v.where(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    x = matrix(sample.select("embedding").toArrow()["embedding"].combine_chunks(), d)
    tree = Tree(x if len(x) else np.zeros((1, d)), n)

    def place(batches):
        for batch in batches:
            leaf = tree.leaf_of(matrix(batch.column("embedding"), d))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], ["vec_id", "embedding", "leaf"])

    placed = saved(v.mapInArrow(place, "vec_id long, embedding array<double>, leaf int"), "leaves")
    sizes = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
    tree.weigh(sizes)
    queries = placed.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    leaves = calibrate(placed, queries, tree, d, k, target)
    block_of = blocks(tree, sizes)  # leaf: (its first block, their number)

    def visit(batches):
        for batch in batches:
            rows, block, lists = [], [], []
            for i, found in enumerate(tree.visits(matrix(batch.column("embedding"), d), leaves, k + 1)):
                to: dict[int, list[int]] = {}
                for leaf in found:
                    first, n = block_of[leaf]
                    for b in range(first, first + n):
                        to.setdefault(b, []).append(leaf)
                rows += [i] * len(to)
                block += to.keys()
                lists += to.values()
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.take(pa.array(rows, pa.int64())).columns,
                    pa.array(block, pa.int64()),
                    pa.array(lists, pa.list_(pa.int32())),
                ],
                ["query_id", "embedding", "block", "leaves"],
            )

    asks = saved(
        queries.mapInArrow(visit, "query_id long, embedding array<double>, block long, leaves array<int>"), "asks"
    )
    columns = saved(
        asks.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("columns")), "columns"
    )
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    where = spark.createDataFrame([(leaf, *b) for leaf, b in block_of.items()], "leaf int, first long, pieces int")
    left = (
        placed.join(F.broadcast(where), "leaf")
        .withColumn("block", F.col("first") + deal("vec_id", "pieces"))
        .join(columns, "block")
        .withColumn("column", F.explode(F.sequence(F.lit(0), F.col("columns") - 1)))
    )
    right = asks.join(columns, "block").withColumn("column", deal("query_id", "columns"))

    def compare(rows, asked):
        out = {"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)}
        if len(rows) and len(asked):
            ids, x = rows["vec_id"].to_numpy(), matrix(rows["embedding"].combine_chunks(), d)
            q_ids, q = asked["query_id"].to_numpy(), matrix(asked["embedding"].combine_chunks(), d)
            leaf = rows["leaf"].to_numpy()
            open_ = np.array([np.isin(leaf, some) for some in asked["leaves"].to_pylist()])
            i, j, score = best(q, q_ids, x, ids, k, open_)
            out = {"query_id": q_ids[i], "vec_id": ids[j], "score": score}
        return pa.table(out)

    near = (
        left.select("block", "column", "leaf", "vec_id", "embedding")
        .groupBy("block", "column")
        .cogroup(right.select("block", "column", "query_id", "embedding", "leaves").groupBy("block", "column"))
        .applyInArrow(compare, "query_id long, vec_id long, score double")
    )
    once = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def blocks(tree: Tree, sizes: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Leaves in the order of the tree, put together to blocks of at most
    GROUP_ROWS vectors; a larger leaf is dealt over blocks of its own."""
    out, block, held, waiting = {}, 0, 0, [0]
    while waiting:
        node = waiting.pop()
        waiting += tree.children[node]
        size = sizes.get(node, 0)
        if tree.children[node] or not size:
            continue
        if held and held + size > GROUP_ROWS:
            block, held = block + 1, 0
        pieces = -(-size // GROUP_ROWS)
        out[node] = (block, pieces)
        held += size
        if pieces > 1:
            block, held = block + pieces, 0
    return out


def calibrate(placed: DataFrame, queries: DataFrame, tree: Tree, d: int, k: int, target: float) -> int:
    """Leaves to visit, so that they hold ``target`` of the true neighbours
    of some queries, which are compared with all vectors."""
    some = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(CALIBRATION).toArrow().combine_chunks()
    if not len(some):
        return 1
    q_ids, q = some["query_id"].to_numpy(), matrix(some["embedding"].combine_chunks(), d)

    def compare(batches):
        for batch in batches:
            if not len(batch):
                continue
            leaf = batch.column("leaf").to_numpy()
            ids = batch.column("vec_id").to_numpy()
            i, j, score = best(q, q_ids, matrix(batch.column("embedding"), d), ids, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int64()), pa.array(ids[j]), pa.array(score), pa.array(leaf[j])],
                ["i", "vec_id", "score", "leaf"],
            )

    near = placed.mapInArrow(compare, "i long, vec_id long, score double, leaf int")
    order = Window.partitionBy("i").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("i", "leaf").collect()
    ranks = [{leaf: r for r, leaf in enumerate(found)} for found in tree.visits(q, len(tree.children), 0)]
    needed = np.array([ranks[r["i"]][r["leaf"]] + 1 for r in near])
    leaves = 1
    while len(needed) and (needed <= leaves).mean() < target:
        leaves += max(1, leaves // 8)
    return leaves
