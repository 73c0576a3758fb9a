import numpy as np
import pytest

from telemetry_qc.llm import hard_negatives as H

VECTORS = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], c) for i, v, c in rows], VECTORS
    )


def brute(rows, every=100, k=5):
    """All pairs, in Python; rows of (vec_id, vector, label), all usable."""
    ids = np.array([r[0] for r in rows])
    x = np.floor(256 * np.array([r[1] for r in rows], np.float32).astype(np.float64)).astype(np.int64)
    label = np.array([r[2] for r in rows])
    out = []
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        order = np.lexsort((ids, -s))
        order = order[ids[order] != ids[i]]
        for p in [j for j in order if label[j] == label[i]][:k]:
            window = [j for j in order if label[j] != label[i] and 80 * s[p] <= 100 * s[j] <= 100 * s[p]]
            out += [(ids[i], ids[p], r + 1, ids[j], s[p], s[j]) for r, j in enumerate(window[:k])]
    return sorted(tuple(map(int, t)) for t in out)


def got(df):
    assert df.columns == NAMES
    return sorted(tuple(r) for r in df.collect())


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 64)
    monkeypatch.setattr(H, "GROUP_ANCHORS", 8)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 10))
    rows = [(i, centres[i % 12] + rng.normal(size=10) * 0.7, i % 4 if i % 3 else 0) for i in range(2400)]
    want = brute(rows)
    assert len(want) > 100
    assert got(H.mine(frame(spark, rows).repartition(7))) == want


def test_ties_and_a_hot_vector(spark, monkeypatch):
    """A third of all rows have one vector, components are coarse."""
    monkeypatch.setattr(H, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(2)
    rows = [(i, [1, 1, 0, 0] if i % 3 == 0 else rng.integers(-1, 3, 4), i % 2) for i in range(900)]
    assert got(H.mine(frame(spark, rows))) == brute(rows)


def test_query_against_all_pairs(spark):
    from telemetry_qc.llm.queries import op12_hard_negatives

    where = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{where}/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in rows]
    assert got(op12_hard_negatives(spark, where)) == brute(rows)


def test_edge_cases(spark):
    rng = np.random.default_rng(3)
    good = [(10 * i, rng.normal(size=3), i % 2) for i in range(60)]
    bad = [
        (None, [1, 2, 3], 0),
        (1, None, 0),
        (2, [1, 2, 3], None),
        (3, [1, None, 3], 0),
        (4, [1, float("nan"), 3], 0),
        (5, [1, float("inf"), 3], 0),
        (6, [1, 1e9, 3], 0),
        (7, [], 0),
        (8, [9, 9], 0),
    ]
    # Rows stated again count once; columns with clashing names are left out.
    df = frame(spark, good + bad + good[:30]).selectExpr("*", "'x' as x", "1 as row", "2 as node", "3 as ask", "0 as Label")
    assert got(H.mine(df)) == brute(good)


def test_rows_of_one_id(spark):
    """Neither positives nor negatives of each other."""
    rows = [(0, [1.0, 0.0], 0), (0, [0.9, 0.1], 1), (1, [0.8, 0.0], 0), (2, [0.7, 0.0], 1)]
    found = got(H.mine(frame(spark, rows)))
    # For the first anchor row: positive 1 (204), negatives 2 from 163.2 on.
    assert (0, 1, 1, 2, 256 * 204, 256 * 179) in found
    assert all(0 not in (t[1], t[3]) for t in found)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(100, None, 1)],
        [(100, [1.0], 1)],  # no other row
        [(100, [1.0], 1), (101, [1.0], 1)],  # no negatives
        [(100, [1.0], 1), (101, [1.0], 2)],  # no positives
        [(101, [1.0], 1), (102, [1.0], 2)],  # no anchors
        [(100, [1.0], 1), (101, [-1.0], 1), (102, [-1.0], 2)],  # a negative score: the window is empty
    ],
)
def test_nothing_found(spark, rows):
    assert got(H.mine(frame(spark, rows))) == []


def test_zero_anchor(spark):
    """All scores are zero: the smallest ids."""
    rows = [(0, [0.0, 0.0], 0)] + [(i, [i, -i], i % 2) for i in range(1, 20)]
    assert got(H.mine(frame(spark, rows))) == brute(rows)


def test_reading_stops_below_the_kth_score():
    """Few rows of a peaked block are met, and the result is whole."""
    rng = np.random.default_rng(4)
    x = rng.integers(-5, 6, size=(5000, 16))
    x[::500] += 200
    lists, a = H.Lists(x), rng.integers(1, 9, 16)
    seen = []

    class Spy(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray) and at.dtype == np.int64:
                seen.append(len(at))
            return np.asarray(self).__getitem__(at)

    lists.floats = lists.floats.view(Spy)
    low, high, least = (np.array([v]) for v in (H.LOWEST, H.HIGHEST, H.LOWEST))
    [(places, scores)] = lists.within(a, np.ones(5000, bool), low, high, least, 5)
    s = x @ a
    want = np.flatnonzero(s >= np.sort(s)[-5])
    assert set(places) == set(want) and sum(seen) < 1000


def test_no_score_is_lost_at_a_bound():
    """Windows, ties at the k-th score and bounds from other blocks."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        n, d = rng.integers(1, 60), rng.integers(1, 5)
        x, a = rng.integers(-4, 5, size=(n, d)), rng.integers(-4, 5, d)
        allowed = rng.random(n) < 0.7
        low = rng.integers(-30, 10, 3)
        high, least = low + rng.integers(-2, 30, 3), rng.integers(-40, 20, 3)
        s = x @ a
        for w, (places, scores) in enumerate(H.Lists(x).within(a, allowed, low, high, least, 3)):
            in_ = allowed & (s >= max(low[w], least[w])) & (s <= high[w])
            bar = np.sort(s[in_])[-3] if in_.sum() >= 3 else -1000
            assert sorted(places) == list(np.flatnonzero(in_ & (s >= bar)))
            assert list(scores) == list(s[places])
