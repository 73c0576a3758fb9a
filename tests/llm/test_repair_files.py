import random
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, docs
from tokenizers import Tokenizer

from telemetry_qc.llm import repair_files as R
from telemetry_qc.paths import fresh_path

FILE = public_tokenizers.path("byte_bpe_50k.json")


@cache
def tokenizer():
    found = Tokenizer.from_file(FILE)
    found.encode_special_tokens = True
    return found


def tokens(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [0]


def wanted(rows):
    """Rows in the order of the files, with their ids."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = tokens(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def by_order(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: t[1])


@pytest.mark.parametrize("kind", ["words", "one", "two", "fib", "random", "short", "empty"])
def test_grammar_round_trip(kind):
    rng = np.random.default_rng(1)
    ids = {
        "words": np.concatenate([[5, 9, 3, 7, 0] if rng.random() < 0.5 else rng.integers(0, 9, 4) for _ in range(4000)]),
        "one": np.full(10_000, 7),
        "two": np.tile([1, 2], 5000),
        "fib": np.array([int(c) for c in fibonacci(9000)]),
        "random": rng.integers(0, 50_000, 3000),
        "short": np.array([4]),
        "empty": np.zeros(0, np.int64),
    }[kind].astype(np.uint32)
    body = R.packed(ids)
    shard = R.Shard(body)
    assert (shard.ids(0, len(ids)) == ids).all() and shard.n_ids == len(ids)
    for _ in range(100):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert (shard.ids(a, b) == ids[a:b]).all()
    if kind in ("words", "one", "two", "fib"):
        assert len(body) < len(ids)  # a quarter of four bytes an id


def fibonacci(n):
    a, b = "0", "01"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_places_do_not_overlap():
    """And the pair that comes first is replaced wherever it stands alone."""
    rng = np.random.default_rng(7)
    for _ in range(500):
        prior = rng.integers(0, 4, rng.integers(1, 30)).astype(np.uint32)
        at = R.places(prior)
        assert (np.diff(at) > 1).all() and (prior[at] > 0).all()
        top = [i for i in range(len(prior)) if prior[i] > max([0, *prior[max(i - 1, 0) : i], *prior[i + 1 : i + 2]])]
        assert set(top) <= set(at.tolist())
    assert R.places(np.full(9, 2, np.uint32)).tolist() == [0, 2, 4, 6, 8]


def test_rules_are_pairs_that_occur_often():
    """Every nonterminal stands at least LEAST times when it is made, and no
    frequent pair that would shorten the shard enough is left."""
    rng = np.random.default_rng(2)
    ids = np.concatenate([[5, 9, 3, 7, 0] if rng.random() < 0.5 else rng.integers(0, 9, 4) for _ in range(3000)])
    s, first, left, right, rounds = R.repair(ids.astype(np.uint32), gain=0)
    sides = np.concatenate([left, right])
    for rule in range(len(left)):
        used = (s == first + rule).sum() + (sides == first + rule).sum()
        assert used >= 1 and max(left[rule], right[rule]) < first + rule
    pairs, count = np.unique(np.stack([s[:-1], s[1:]]), axis=1, return_counts=True)
    assert count.max() < 3 * R.LEAST


@pytest.mark.parametrize("bits", [8, 16, 24])
def test_widths_of_symbols(bits):
    for first in ((1 << bits) - 50, (1 << bits) - 43, (1 << bits) - 20):
        ids = np.arange(first, first + 43, dtype=np.uint32).repeat(2)
        assert (R.Shard(R.packed(ids)).ids(0, len(ids)) == ids).all()


def test_whole_documents(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD_IDS", 700)
    monkeypatch.setattr(R, "PART_BYTES", 4000)
    rnd = random.Random(3)
    vocabulary = ["alpha", "beta", "gamma,", "  odd  ", "größe", "日本", "\n", "<|endoftext|>", "x" * 40]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(60)))) for i in range(300)]
    rows += [(1000, "word " * 20_000), (-5, "before all")]
    df = docs(spark, rnd.sample(rows, len(rows)))
    path = fresh_path(spark, "repair-test")
    R.write(df, path, FILE, True)
    want = wanted(sorted(rows))
    assert by_order(R.read(spark, path)) == want
    assert spark.read.parquet(path).select("part").distinct().count() > 5
    some = [7, 299, 1000, 4_000_000]
    assert by_order(R.read(spark, path, some)) == [w for w in want if w[0] in some]


def test_edge_cases(spark):
    rows = [(None, "no id"), (3, None), (3, ""), (1, "same"), (1, "same"), (2**62, " "), (-(2**62), "low")]
    got = by_order(R.round_trip(clashing(spark, rows), FILE, True))
    assert [t[0] for t in got] == [None, -(2**62), 1, 1, 3, 3, 2**62]
    by = {doc_id: text for doc_id, text in rows}
    at = 0
    for doc_id, start, n, crc in got:
        ids = tokens(by[doc_id])
        assert (start, n, crc) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += n
    assert R.round_trip(docs(spark, rows[:0]), FILE, True).collect() == []


def test_one_document_stated_very_often(spark, monkeypatch):
    """Equal rows are split over ranges; places stay gapless."""
    monkeypatch.setattr(R, "PART_BYTES", 2000)
    rows = [(5, "the same text again and again")] * 900 + [(i, f"text {i}") for i in range(10)]
    path = fresh_path(spark, "repair-test")
    R.write(docs(spark, rows), path, FILE, True)
    sizes = [r["n"] for r in spark.read.parquet(path).selectExpr("part", "size(doc_ids) n").collect()]
    assert max(sizes) < 400
    got = by_order(R.read(spark, path, with_ids=False))
    assert len(got) == 910 and all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))
    assert [t[0] for t in got] == sorted(r[0] for r in rows)


def test_query_over_the_whole_table(spark):
    from telemetry_qc.llm.queries import op11_repair_files

    where = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text").collect()
    want = wanted(sorted((tuple(r) for r in rows), key=lambda t: t[0]))
    assert by_order(op11_repair_files(spark, where)) == [w[:4] for w in want]
