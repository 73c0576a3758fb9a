import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from helpers import clashing, docs

from telemetry_qc.llm.bpe_fst import REJECT, StreamDecoder, Transducer, codec, encode_documents, read_ranks

FILE = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(FILE, "rb") as f:
        ranks = read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    with open(FILE, "rb") as f:
        return codec(f.read(), P.PATTERN)


ALPHABETS = ["ab", "aeiou tn", "éèçñ ", "  \n\t a1", "あ中文é😀 ", "-=_ ", "0123 ", "a \n", "x' s\n", "\x1c a\n", "   a.", "the ,.;!?\n "]


def test_ids_are_the_librarys(own, library):
    rnd = random.Random(1)
    texts = ["", " ", "\n", "it's we'll", "a" * 5000, " " * 3000 + "x", "ab" * 40_000, "<|endoftext|>"]
    texts += ["".join(rnd.choice(rnd.choice(ALPHABETS)) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += [library.decode([rnd.randrange(50256) for _ in range(12)]) for _ in range(1500)]
    for text in texts:
        assert own.encode(text).tolist() == library.encode_ordinary(text), text[:80]


def test_small_state_limit_changes_nothing(library):
    small = Transducer({b: i for b, i in library._mergeable_ranks.items()}, max_states=50)
    rnd = random.Random(2)
    for _ in range(500):
        word = "".join(rnd.choice("abcdeéñ") for _ in range(rnd.randint(1, 12))).encode()
        assert small.encode(word) == small.merged(word)


def test_tokens_are_emitted_before_the_end(own):
    """The pending bytes never exceed the longest token."""
    machine = own.transducer
    machine.encode(b"internationalisation" * 200)
    assert max(len(text) for text, _ in machine._states) < machine.longest


def test_decoding_as_a_stream(own, library):
    rnd = random.Random(3)
    for _ in range(500):
        ids = np.array([rnd.randrange(50256) for _ in range(rnd.randint(0, 20))], np.uint32)
        stream = StreamDecoder(own.transducer.tokens)
        parts = [stream.feed(ids[i : i + 1]) for i in range(len(ids))]
        left = stream.finish()
        assert b"".join(parts) + left == library.decode_bytes(ids.tolist())
    text = "né 中文 😀 fin"
    stream = StreamDecoder(own.transducer.tokens)
    out = [stream.text(own.encode(text)[i : i + 1]) for i in range(len(own.encode(text)))]
    assert "".join(out) == text and "�" not in "".join(out)  # no code point is cut


def test_utf8_machine():
    go = StreamDecoder.machine
    for n in (1, 2, 3, 4):
        rnd = random.Random(n)
        for _ in range(3000):
            raw = bytes(rnd.choice([0x41, 0x80, 0x9F, 0xA0, 0xBF, 0xC1, 0xC2, 0xE0, 0xED, 0xEF, 0xF0, 0xF4, 0xF5]) for _ in range(n))
            state = 0
            for byte in raw:
                state = int(go[state, byte]) if state != REJECT else REJECT
            try:
                raw.decode()
                whole = True
            except UnicodeDecodeError:
                whole = False
            assert (state == 0) == whole, raw


def test_documents(spark, library):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (None, "né"), (1, "Hello  world"), (4, "word " * 30_000)]
    out = sorted(encode_documents(docs(spark, rows), FILE, P.PATTERN).collect(), key=repr)
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)


def test_arrays_clashing_columns_and_no_rows(spark):
    out = encode_documents(clashing(spark, [(1, "né né")]), FILE, P.PATTERN, arrays=True).first()
    assert out["decoded"] == "né né" and len(out["ids"]) == out["n_tokens"]
    assert encode_documents(docs(spark, []), FILE, P.PATTERN).count() == 0
