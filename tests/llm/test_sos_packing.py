import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from helpers import clashing, docs
from tokenizers import Tokenizer

from telemetry_qc.llm.sos_packing import cut, pack_documents, sum_of_squares

FILE = P.path("byte_bpe_50k.json")


def squares(gaps):
    return sum(n * n for g, n in Counter(gaps).items() if g)


def test_each_piece_goes_where_the_sum_is_least():
    rnd = random.Random(4)
    for _ in range(60):
        capacity = rnd.randint(3, 14)
        sizes = [rnd.randint(1, capacity) for _ in range(40)]
        where, offsets = sum_of_squares(sizes, capacity)
        gaps: list[int] = []
        for size, sequence, offset in zip(sizes, where, offsets):
            choices = [squares([*gaps, capacity - size])]
            for i, gap in enumerate(gaps):
                if gap >= size:
                    choices.append(squares([*gaps[:i], gap - size, *gaps[i + 1 :]]))
            if sequence == len(gaps):
                gaps.append(capacity)
            assert offset == capacity - gaps[sequence]
            gaps[sequence] -= size
            assert gaps[sequence] >= 0 and squares(gaps) == min(choices)


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)]
    assert cut(5, 4) == [(0, 1), (1, 4)] and cut(8, 4) == [(0, 4), (4, 4)]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return t


def check(rows, out, library, capacity):
    want = Counter()
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for k, (s, n) in enumerate(cut(len(ids), capacity)):
            want[doc_id, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in out) == want
    held = defaultdict(list)
    for r in out:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("spaced", [True, False])
def test_documents(spark, library, spaced):
    rnd = random.Random(5)
    rows = [(1, None), (2, ""), (None, "a  b"), (3, "word " * 9000), (4, " né\n"), (4, " né\n"), (5, "<|endoftext|> x")]
    rows += [(i, " ".join(rnd.choice(["alpha", "beta,", "né.", "x\ny"]) for _ in range(rnd.randint(0, 300)))) for i in range(6, 200)]
    out = pack_documents(docs(spark, rows), FILE, spaced, capacity=256, items=100).collect()
    n = check(rows, out, library, 256)
    assert n <= 1.1 * sum(r["length"] for r in out) / 256 + 4
    assert pack_documents(clashing(spark, rows[:3]), FILE, spaced).count() == 3
    assert pack_documents(docs(spark, []), FILE, spaced).count() == 0


def test_one_key_for_all_rows(spark, library):
    rows = [(7, f"doc {i} " * 9) for i in range(300)]
    out = pack_documents(docs(spark, rows), FILE, True, capacity=64, items=100).collect()
    check(rows, out, library, 64)
    assert len({r["sequence_id"] >> 32 for r in out}) == 3  # dealt over tasks whatever the key
