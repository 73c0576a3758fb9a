import numpy as np
import pytest

from telemetry_qc.llm import ann_tree as A

VECTORS = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], VECTORS)


def brute(rows, every, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for i, v in zip(ids, x):
        if i % every == 0:
            s = (x * v).sum(1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), s[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_scores_and_order(spark, monkeypatch):
    monkeypatch.setattr(A, "LEAF_ROWS", 60)
    monkeypatch.setattr(A, "GROUP_ROWS", 300)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(25, 16))
    x = centres[rng.integers(0, 25, 3000)] + 0.4 * rng.normal(size=(3000, 16))
    rows = list(enumerate(x))
    want, got = brute(rows, 20, 20), found(A.search(frame(spark, rows)))
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    for q, list_ in got.items():
        assert len(list_) == 20 and list_ == sorted(list_, key=lambda p: (-p[1], p[0]))
        score = dict(list_)
        for i, s in want[q]:
            assert abs(score.get(i, s) - s) < 1e-12


def test_a_large_leaf_of_equal_vectors(spark, monkeypatch):
    """A third of all vectors the same: ties go to the smaller id."""
    monkeypatch.setattr(A, "GROUP_ROWS", 64)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 2.0, 0.0] if i % 3 == 0 else rng.normal(size=4) * 0.3) for i in range(600)]
    got = found(A.search(frame(spark, rows), every=50, k=7))
    want = brute(rows, 50, 7)
    for q in want:
        if q % 3 == 0:
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (1, [0, 0]), (2, None), (3, [1, None]), (4, [nan, 1]), (5, [inf, 1]), (6, [1, 2, 3]), (None, [9, 9]), (7, [2, 0]), (8, []), (20, [3, 1]), (7, [2, 0])]
    got = found(A.search(frame(spark, rows)))
    assert got == {0: [(20, 3.0), (7, 2.0)], 20: [(7, 6.0), (0, 3.0)]}


def test_repeated_and_clashing(spark):
    rows = [(0, [1, 0]), (0, [0, 1]), (1, [1, 0]), (1, [0, 5])]
    assert found(A.search(frame(spark, rows))) == {0: [(1, 5.0)]}
    df = frame(spark, rows).selectExpr("*", "1 as leaf", "2 as block", "3 as score", "4 as query_id")
    assert found(A.search(df)) == {0: [(1, 5.0)]}
    assert A.search(frame(spark, [])).count() == 0
    assert A.search(frame(spark, [(1, [1, 0])])).count() == 0
    assert A.search(frame(spark, [(20, [1, 0])])).count() == 0


@pytest.mark.parametrize("n", [1, 5, 400])
def test_tree_places_every_row_in_a_leaf(n):
    x = np.random.default_rng(3).normal(size=(n, 3))
    tree = A.Tree(x, n * 4, leaf_rows=40)
    leaf = tree.leaf_of(x)
    assert all(not tree.children[i] for i in set(leaf.tolist()))
    sizes = dict(zip(*map(lambda a: a.tolist(), np.unique(leaf, return_counts=True))))
    tree.weigh(sizes)
    assert tree.rows[0] == n
    order = next(tree.visits(x[:1], 10**9, 0))
    assert sorted(order) == sorted(sizes)  # all leaves in the end, each once
    blocks = A.blocks(tree, sizes)
    assert set(blocks) == set(sizes)


def test_best_bin_first():
    """The queue yields leaves by what their node promises."""
    x = np.random.default_rng(4).normal(size=(500, 4))
    tree = A.Tree(x, 500, leaf_rows=30)
    leaf = tree.leaf_of(x)
    tree.weigh(dict(zip(*map(lambda a: a.tolist(), np.unique(leaf, return_counts=True)))))
    q = x[:1]
    worth = (q @ tree.centres.T + np.sqrt((q**2).sum(1))[:, None] * (tree.spread * tree.expected))[0]
    order = next(tree.visits(q, 10**9, 0))
    root = tree.children[0]
    if all(not tree.children[c] for c in root):
        assert order == sorted(root, key=lambda c: -worth[c])
    assert len(next(tree.visits(q, 1, 0))) == 1 and len(next(tree.visits(q, 1, 400))) > 5


def test_rows_stated_again_take_no_places(spark):
    """30 ids with one vector, each three times, and farther ones."""
    rng = np.random.default_rng(9)
    rows = [(i, [1.0, 2.0, 2.0]) for i in range(30)] * 3 + [(100 + i, rng.normal(size=3) * 0.1) for i in range(200)]
    got = found(A.search(frame(spark, rows)))
    want = brute(sorted({(i, tuple(v)) for i, v in rows}), 20, 20)
    for q in (0, 20):
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_many_vectors_of_one_id(spark):
    """One id has the 60 nearest vectors: it takes one place."""
    rng = np.random.default_rng(10)
    rows = [(20, [5.0, 0.0])] + [(7, [9.0 + i / 100, 0.0]) for i in range(60)] + [(20, [8.0 + i / 100, 0.0]) for i in range(60)]
    rows += [(100 + i, rng.normal(size=2) * 0.1) for i in range(150)]
    ids = [i for i, _ in found(A.search(frame(spark, rows), k=5))[20]]
    assert ids[0] == 7 and len(set(ids)) == 5 and 20 not in ids
