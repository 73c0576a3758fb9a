import numpy as np
import pytest

from telemetry_qc.llm import whitening as W

VECTORS = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], VECTORS
    )


def scaled(rows):
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    return np.floor(1024 * x).astype(np.int64) + 100_000


def compare(got, rows, k):
    """Against numpy's solver and whole-number sums in Python."""
    x, ids = scaled(rows), [i for i, _ in rows]
    n, total = len(x), [int(t) for t in x.sum(0)]
    values, axes = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    want = (x - x.mean(0)) @ axes / np.sqrt(values)
    assert len(got) == n * k
    by = {(r["vec_id"], r["component"]): r for r in got}
    for c in range(k):
        mine = np.array([by[i, c + 1]["whitened"] for i in ids])
        assert min(np.abs(mine - s * want[:, c]).max() for s in (1, -1)) < 1e-7
    for i, row in zip(ids, x.tolist()):
        r = by[i, 1]
        assert r["n"] == n and r["deviation"] == sum((n * v - t) ** 2 for v, t in zip(row, total))
        assert int(r["deviation_exact"]) == r["deviation"]
    for r in got:
        share = values[r["component"] - 1] / np.trace(np.cov(x.T.astype(float), bias=True))
        assert abs(r["explained"] - share) < 1e-9 and 0 <= r["identity_error"] < 1e-9


def test_against_the_library_solver(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 24)) @ rng.normal(size=(24, 24)) + 5
    rows = list(enumerate(x))
    compare(W.whiten(frame(spark, rows).repartition(5)).collect(), rows, 8)


def test_whole_table_query(spark):
    from telemetry_qc.llm.queries import op13_whitening

    where = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{where}/embeddings.parquet").collect()]
    compare(op13_whitening(spark, where).collect(), rows, 8)


def test_edge_cases(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=5)) for i in range(40)] + [(7, rng.normal(size=5)), (None, rng.normal(size=5))]
    bad = [
        (100, None),
        (101, [1, 2, None, 4, 5]),
        (102, [1, 2, float("nan"), 4, 5]),
        (103, [1, float("-inf"), 3, 4, 5]),
        (104, []),
        (105, [1, 2]),
        (106, [1, 2, 3, 4, 1e30]),
    ]
    got = W.whiten(frame(spark, good + bad)).collect()
    assert len(got) == 5 * len(good)  # five dimensions, five components
    assert not {r["vec_id"] for r in got} & {i for i, _ in bad}
    assert len([r for r in got if r["vec_id"] == 7]) == 10
    assert max(r["identity_error"] for r in got) < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    got = W.whiten(frame(spark, rows))
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.collect() == []


def test_dependent_and_repeated_dimensions(spark):
    """Rank two: two components; equal rows are whitened alike."""
    rng = np.random.default_rng(5)
    ab = rng.integers(-900, 900, size=(60, 2)) / 1024
    rows = [(i, [a, b, a, 3.0]) for i, (a, b) in enumerate(np.vstack([ab, ab]))]
    got = W.whiten(frame(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2} and len(got) == 240
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    assert all(by[i, c] == by[i + 60, c] for i in range(60) for c in (1, 2))


def test_clashing_columns(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3)) for i in range(30)]
    more = frame(spark, rows).selectExpr("*", "1 as d", "2 as n", "'x' as total", "0 as component", "vec_id as i")
    compare(W.whiten(more).collect(), rows, 3)


def test_large_numbers_stay_exact():
    z = np.array([[2**39, -(2**39)], [3, 4]], np.int64)
    want = [[sum(int(r[i]) * int(r[j]) for r in z.tolist()) for j in range(2)] for i in range(2)]
    assert W.products(z).tolist() == want
    assert W.deviations(z, 10**9, [5, -7]) == [
        sum((10**9 * v - r) ** 2 for v, r in zip(row, [5, -7])) for row in z.tolist()
    ]


@pytest.mark.parametrize("d", [1, 2, 3, 17, 40])
def test_solver(d):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    for values in (
        rng.random(d) + 0.1,
        np.r_[np.full(min(d, 3), 2.0), rng.random(d)[: max(0, d - 3)]],  # equal leading ones
        2 + 1e-13 * np.arange(d),  # a cluster
        np.r_[1e12, 1e-3 * np.ones(d - 1)],
    ):
        v = (q * values) @ q.T
        v = (v + v.T) / 2
        got, axes = W.principal(v, 8)
        want = np.linalg.eigvalsh(v)[::-1][: len(got)]
        size = np.abs(want).max()
        assert np.abs(got - want).max() < 1e-13 * d * size
        assert np.abs(axes.T @ axes - np.eye(len(got))).max() < 1e-12
        assert np.abs(v @ axes - axes * got).max() < 1e-12 * d * size


def test_solver_of_a_diagonal_matrix():
    got, axes = W.principal(np.diag([3.0, 3.0, 1.0, 0.0]), 8)
    assert got.tolist() == pytest.approx([3, 3, 1]) and np.abs(axes.T @ axes - np.eye(3)).max() < 1e-14
