"""Whitening of embeddings by their leading principal components.

Every component c of a vector becomes the whole number
x = floor(1024 * c) + 100000.  One pass over the vectors adds up the counts
and sums of x; a second one adds up the products of x less the nearest whole
number to its mean.  These are whole numbers, so that the sums are exact and
the same in any order; what the mean differs from that whole number is taken
off at the end.  The covariance, d x d numbers whatever the table's size, is
solved on the driver: Householder reflections make it tridiagonal, counts of
sign changes (Sturm) bisect the leading eigenvalues, inverse iteration gives
their vectors, and vectors of eigenvalues close to each other are made
orthogonal in every step.  The components go to the tasks by a broadcast; one
pass measures the covariance of the whitened vectors, the last one returns
them.

Rows with a null vector, or null or non-finite entries, take no part; nor do
empty vectors, vectors of another length than most (ties: the shorter), and
vectors with an entry of 2**40 or more in size, whose x a double can't tell
from the next.  Repeated rows count each for itself and come back each for
itself; a null vec_id stays null.  Components whose eigenvalue is not above
the rounding of the covariance (constant or dependent dimensions, fewer
vectors than components) have no unit variance and are left out; equal
vectors only, or one alone, give no rows.  Equal eigenvalues share their
space: any orthonormal vectors of it are returned.  ``deviation`` is null
where it is too large for a long; ``deviation_exact`` has it as a decimal (null
from 39 digits on).  An
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import pick, ship

SCALE, SHIFT = 1024, 100_000
#: Entries of this size or more take no part.
LARGEST = float(2**40)
#: Vectors that are handled at a time.
BLOCK = 4_096

RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double, deviation_exact decimal(38,0)"
)


def usable(vectors: DataFrame) -> DataFrame:
    v = pick(vectors, {"vec_id": "long", "embedding": "array<double>"})
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    return v.where("embedding is not null and size(embedding) > 0").where(~bad)


def scaled(column, d: int) -> np.ndarray:
    """x of a batch of vectors."""
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def products(z: np.ndarray) -> np.ndarray:
    """z.T @ z, exactly, as Python's whole numbers."""
    largest = int(np.abs(z).max(initial=0))
    total = np.zeros((z.shape[1], z.shape[1]), object)
    # Doubles add whole numbers exactly up to 2**53.
    step = BLOCK if not largest else min(BLOCK, 2**53 // largest**2)
    if not step:
        z = z.astype(object)
        return z.T @ z
    for a in range(0, len(z), step):
        part = z[a : a + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def sums(v: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors and the sum of every dimension's x."""

    def add(batches):
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            x = scaled(batch.column("embedding"), d)
            n += len(x)
            # Of up to 10,000 numbers below 2**51 each.
            total += x.sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d + 1), pa.int32()), pa.array([*map(str, total.tolist()), str(n)])], ["i", "total"]
        )

    rows = v.select("embedding").mapInArrow(add, "i int, total string")
    rows = rows.groupBy("i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = {r["i"]: int(r["total"]) for r in rows}
    return total.get(d, 0), [total.get(i, 0) for i in range(d)]


def covariance(v: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """With the divisor n, centred at the nearest whole numbers to the means
    before multiplying."""
    d = len(total)
    centre = centres(n, total)

    def add(batches):
        found = np.zeros((d, d), object)
        for batch in batches:
            found += products(scaled(batch.column("embedding"), d) - centre)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(list(map(str, found[i, j].tolist())))],
            ["i", "j", "total"],
        )

    rows = v.select("embedding").mapInArrow(add, "i int, j int, total string")
    rows = rows.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    rest = [t - n * int(c) for t, c in zip(total, centre)]  # n times what the mean differs
    out = np.zeros((d, d))
    for r in rows:
        i, j = r["i"], r["j"]
        # One division of whole numbers, rounded once.
        out[i, j] = out[j, i] = (n * int(r["total"]) - rest[i] * rest[j]) / n**2
    return out


def centres(n: int, total: list[int]) -> np.ndarray:
    return np.array([(2 * t + n) // (2 * n) for t in total], np.int64)


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, q): q.T @ v @ q has the diagonal a and b beside it; by
    Householder reflections."""
    t, d = np.array(v, float), len(v)
    q = np.eye(d)
    for k in range(d - 2):
        x = t[k + 1 :, k]
        if not x[1:].any():
            continue
        u = x / np.abs(x).max()
        u[0] += np.copysign(np.sqrt(u @ u), u[0])
        u /= np.sqrt(u @ u)
        new = x - 2 * u * (u @ x)
        rest = t[k + 1 :, k + 1 :]
        p = rest @ u
        p -= u * (u @ p)
        rest -= 2 * (np.outer(u, p) + np.outer(p, u))
        t[k + 1 :, k] = t[k, k + 1 :] = 0
        t[k + 1, k] = t[k, k + 1] = new[0]
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ u, u)
    return np.diag(t).copy(), np.diag(t, 1).copy(), q


def below(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are less than each of
    ``at``: the negative pivots (Sturm)."""
    least = np.finfo(float).tiny * max(1.0, float((b**2).max(initial=0)))
    count, pivot = np.zeros(len(at), np.int64), np.ones(len(at))
    for i in range(len(a)):
        pivot = a[i] - at - (b[i - 1] ** 2 / pivot if i else 0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling: bisection until no double is left
    between the bounds."""
    d = len(a)
    beside = np.abs(np.concatenate(([0.0], b))) + np.abs(np.concatenate((b, [0.0])))
    margin = 4 * np.finfo(float).eps * np.abs(a).max() + np.finfo(float).tiny
    low = np.full(k, (a - beside).min() - margin)
    high = np.full(k, (a + beside).max() + margin)
    want = d - 1 - np.arange(k)  # so many are less than the one looked for
    while True:
        mid = low + (high - low) / 2
        open_ = (mid > low) & (mid < high)
        if not open_.any():
            return low
        less = below(a, b, mid) <= want
        low, high = np.where(open_ & less, mid, low), np.where(open_ & ~less, mid, high)


def solved(a: np.ndarray, b: np.ndarray, shift: float, y: np.ndarray, least: float) -> np.ndarray:
    """x with (T - shift) x = y, by elimination with row exchanges; pivots are
    ``least`` at least."""
    d = len(a)
    u, over, over2 = (a - shift).tolist(), [*b.tolist(), 0.0], [0.0] * d
    lower, x = b.tolist(), y.tolist()
    for i in range(d - 1):
        if abs(lower[i]) > abs(u[i]):
            factor = u[i] / lower[i]
            u[i], top = lower[i], over[i]
            over[i], over2[i] = u[i + 1], over[i + 1]
            u[i + 1], over[i + 1] = top - factor * over[i], -factor * over2[i]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            if abs(u[i]) < least:
                u[i] = least
            factor = lower[i] / u[i]
            u[i + 1] -= factor * over[i]
            x[i + 1] -= factor * x[i]
    for i in range(d - 1, -1, -1):
        if abs(u[i]) < least:
            u[i] = least
        right = x[i]
        if i + 1 < d:
            right -= over[i] * x[i + 1]
        if i + 2 < d:
            right -= over2[i] * x[i + 2]
        x[i] = right / u[i]
    return np.array(x)


def eigenvectors(a: np.ndarray, b: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit vectors (columns) of falling eigenvalues, by inverse iteration.
    Eigenvalues within a thousandth of the matrix's size of the one before
    make a cluster; a vector is made orthogonal to its cluster's."""
    d = len(a)
    size = np.abs(a).max() + 2 * np.abs(b).max(initial=0)
    eps = np.finfo(float).eps
    rng = np.random.default_rng(11)
    out = np.zeros((d, len(values)))
    first, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * size:
            first = k
        # Equal eigenvalues are set apart a little, or all would give one vector.
        shift = value if k == first else min(value, shift - 10 * eps * size)
        y = rng.normal(size=d)
        for _ in range(rounds):
            y /= np.abs(y).max()
            y = solved(a, b, shift, y, eps * size)
            y /= np.abs(y).max()
            for _ in range(2):
                y -= out[:, first:k] @ (out[:, first:k].T @ y)
            y /= np.sqrt(y @ y)
        out[:, k] = y
    return out


def principal(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns): at most k of those
    that are above the rounding of the matrix."""
    size = np.abs(v).max(initial=0)
    if not size:
        return np.zeros(0), np.zeros((len(v), 0))
    a, b, q = tridiagonal(v / size)
    values = leading(a, b, min(k, len(v)))
    values = values[values > len(v) * np.finfo(float).eps * np.abs(values).max()]
    return values * size, q @ eigenvectors(a, b, values)


def deviations(z: np.ndarray, n: int, rest: list[int]) -> list[int]:
    """For every row of z the sum of (n * z - rest)**2, exactly."""
    largest, most = int(np.abs(z).max(initial=0)), max(map(abs, rest))
    if z.shape[1] * largest * max(largest, most) >= 2**62:
        z = z.astype(object)
    squares, crossed = (z * z).sum(1).tolist(), (z * np.array(rest)).sum(1).tolist()
    last = sum(r * r for r in rest)
    return [n * n * s - 2 * n * c + last for s, c in zip(squares, crossed)]


def whiten(vectors: DataFrame, components: int = 8) -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n,
    deviation, whitened, explained, identity_error, deviation_exact."""
    spark = vectors.sparkSession
    ship(spark)
    v = usable(vectors)
    lengths = v.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    empty = spark.createDataFrame([], RESULT)
    if not lengths:
        return empty
    d = lengths[0]["d"]
    v = v.where(F.size("embedding") == d)
    n, total = sums(v, d)
    cov = covariance(v, n, total)
    values, axes = principal(cov, components)
    k = len(values)
    if not k:
        return empty
    centre = centres(n, total)
    rest = [t - n * int(c) for t, c in zip(total, centre)]
    # x less its mean, on the components, in units of their deviations.
    known = spark.sparkContext.broadcast(
        {"axes": axes / np.sqrt(values), "centre": centre, "off": np.array([r / n for r in rest])}
    )

    def project(z: np.ndarray) -> np.ndarray:
        return (z - known.value["off"]) @ known.value["axes"]

    def measure(batches):
        count, first, second = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = project(scaled(batch.column("embedding"), d) - known.value["centre"])
            count, first, second = count + len(w), first + w.sum(0), second + w.T @ w
        rows = [(i, j, second[i, j]) for i in range(k) for j in range(k)] + [(i, k, first[i]) for i in range(k)]
        i, j, total = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total)], ["i", "j", "total"]
        )

    found = v.select("embedding").mapInArrow(measure, "i int, j int, total double")
    table = np.zeros((k, k + 1))
    for r in found.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        table[r["i"], r["j"]] = r["total"] / n
    mean = table[:, k]
    error = float(np.abs(table[:, :k] - np.outer(mean, mean) - np.eye(k)).max())
    explained = values / np.trace(cov)

    kinds = {f.name: f.type for f in to_arrow_schema(empty.schema)}

    def returned(batches):
        for whole in batches:
            for a in range(0, len(whole), BLOCK):
                batch = whole.slice(a, BLOCK)
                z = scaled(batch.column("embedding"), d) - known.value["centre"]
                exact = deviations(z, n, rest)
                rows = pa.array(np.repeat(np.arange(len(z)), k))
                columns = {
                    "vec_id": batch.column("vec_id").take(rows),
                    "component": np.tile(np.arange(1, k + 1), len(z)),
                    "n": np.full(len(rows), n),
                    "deviation": pa.array([e if e < 2**63 else None for e in exact], pa.int64()).take(rows),
                    "whitened": project(z).ravel(),
                    "explained": np.tile(explained, len(z)),
                    "identity_error": np.full(len(rows), error),
                    "deviation_exact": pa.array([e if e < 10**38 else None for e in exact], kinds["deviation_exact"]).take(rows),
                }
                yield pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in kinds.items()], list(kinds))

    return v.mapInArrow(returned, RESULT)
