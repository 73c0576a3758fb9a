"""Byte-level BPE as a finite-state transducer.

Encoding.  The transducer reads the bytes of one pretoken.  Its state is the
bytes read since the token emitted last; where a transition depends on that
token too, it has a test with two outcomes.  For every end position
among those bytes the last token of that prefix's encoding is known (there is
exactly one token that ends there and forms a stable pair with the token
before it), so the encoding of any prefix is a chain of tokens back to the
emitted one.  A later token can start at a position only if the bytes from
there on begin some token of the vocabulary; tokens on which the chains from
all such positions agree can no longer change and are emitted.  The lookahead
is therefore bounded by the longest token.  States and transitions are made
when first needed and kept (lazy determinisation), up to ``max_states``.

Decoding.  Ids become bytes; a UTF-8 state machine holds back the bytes of an
unfinished code point until the rest arrives.

Null text is empty text; an empty text has no ids and decodes to nothing.
Texts of any length are encoded whole.  Repeated rows are kept, one result
for each; a null doc_id stays null.  An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import gc
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import words
from .common import documents, ship
from .pretokens import UnitCache


class Transducer:
    """Encodes pretokens by the ranks of a byte-level BPE vocabulary."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 300_000):
        self.ranks = ranks
        self.tokens: dict[int, bytes] = {i: b for b, i in ranks.items()}
        self.lengths = {i: len(b) for b, i in ranks.items()}
        self.longest = max(self.lengths.values())
        self.prefixes = {b[:n] for b in ranks for n in range(1, len(b))}
        self.max_states = max_states
        self._pairs: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        # State n: the bytes read since the last emitted token, and the last
        # token of each prefix of those.  Transitions: n << 8 | byte ->
        # m << 24 | k, k naming the tokens emitted (0: none); or, where it
        # depends on the token emitted last, -1 - t, t naming a test.
        self._states: list[tuple[bytes, tuple[int, ...]]] = [(b"", ())]
        self._known = {self._states[0]: 0}
        self._moves: dict[int, int] = {}
        self._tests: list[list[int]] = []  # token; moves if stable, if not
        self._emits: list[tuple[int, ...]] = [()]
        self._emit_ids: dict[tuple[int, ...], int] = {(): 0}
        self._rests: dict[int, tuple[int, ...]] = {0: ()}

    def merged(self, word: bytes) -> list[int]:
        """The definition: merge the adjacent pair of least rank, leftmost
        first, until no pair is in the vocabulary."""
        parts = [word[i : i + 1] for i in range(len(word))]
        get, none = self.ranks.get, 1 << 60
        ranks = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], none)
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], none)
        return [self.ranks[p] for p in parts]

    def _stable(self, left: int, right: int) -> bool:
        """Whether the pair is its own encoding."""
        known = self._pairs.get(left << 32 | right)
        if known is None:
            if len(self._pairs) >= 2 * self.max_states:
                self._pairs.clear()
            known = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
            self._pairs[left << 32 | right] = known
        return known

    def _last(self, text: bytes, lasts: tuple[int, ...], whole: bool) -> int:
        """The token that ends the encoding of what was emitted and text;
        ``lasts`` has those of the shorter prefixes.  ``whole``: all of text
        is a token, stable after the one emitted."""
        get, n = self.ranks.get, len(text)
        if whole:
            return get(text)
        for start in range(max(1, n - self.longest), n):
            token = get(text[start:])
            if token is not None and self._stable(lasts[start - 1], token):
                return token
        raise ValueError("the vocabulary lacks a byte")

    def _chain(self, lasts: tuple[int, ...], end: int) -> tuple[int, ...]:
        out = []
        while end > 0:
            out.append(lasts[end - 1])
            end -= self.lengths[out[-1]]
        return tuple(out[::-1])

    def _plan(self, state: int, byte: int) -> int:
        """The transition, or the test it depends on."""
        token = self.ranks.get(self._states[state][0] + bytes((byte,)))
        if token is None:
            move = self._make(state, byte, False)
        else:
            self._tests.append([token, -1, -1])
            move = -len(self._tests)
        self._moves[state << 8 | byte] = move
        return move

    def _make(self, state: int, byte: int, whole: bool) -> int:
        text, lasts = self._states[state]
        text += bytes((byte,))
        n = len(text)
        lasts += (self._last(text, lasts, whole),)
        # The next token can start here or where the bytes begin a token;
        # ``cut`` is where the chains from all these places meet.
        prefixes, lengths, cut = self.prefixes, self.lengths, n
        if n < self.longest and text in prefixes:
            cut = 0
        else:
            for p in range(n - 1, max(0, n - self.longest), -1):
                if text[p:] in prefixes:
                    while cut != p:
                        if cut > p:
                            cut -= lengths[lasts[cut - 1]]
                        else:
                            p -= lengths[lasts[p - 1]]
                    if not cut:
                        break
        sure = self._chain(lasts, cut) if cut else ()
        after = (text[cut:], lasts[cut:])
        to = self._known.get(after)
        if to is None:
            to = self._known[after] = len(self._states)
            self._states.append(after)
        emit = self._emit_ids.get(sure)
        if emit is None:
            emit = self._emit_ids[sure] = len(self._emits)
            self._emits.append(sure)
        return to << 24 | emit

    def encode(self, word: bytes) -> list[int]:
        if len(self._states) >= self.max_states:
            self._reset()
        state, root, out, moves = 0, -1, [], self._moves
        for byte in word:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._plan(state, byte)
            if move < 0:
                test = self._tests[-1 - move]
                whole = root < 0 or self._stable(root, test[0])
                move = test[1 if whole else 2]
                if move < 0:
                    move = test[1 if whole else 2] = self._make(state, byte, whole)
            state = move >> 24
            if move & 0xFFFFFF:
                emit = self._emits[move & 0xFFFFFF]
                out += emit
                root = emit[-1]
        rest = self._rests.get(state)
        if rest is None:
            lasts = self._states[state][1]
            rest = self._rests[state] = self._chain(lasts, len(lasts))
        out += rest
        return out


# States of the UTF-8 machine: 0 between code points, 1-3 continuation bytes
# due, 4-7 after E0, ED, F0, F4, whose second byte has a narrower range.
REJECT = 8


def utf8_machine() -> np.ndarray:
    go = np.full((8, 256), REJECT, np.uint8)
    go[0, 0x00:0x80] = 0
    go[0, 0xC2:0xE0] = 1
    go[0, 0xE0:0xF0] = 2
    go[0, 0xF0:0xF5] = 3
    go[0, [0xE0, 0xED, 0xF0, 0xF4]] = [4, 5, 6, 7]
    for state in (1, 2, 3):
        go[state, 0x80:0xC0] = state - 1
    go[4, 0xA0:0xC0] = go[5, 0x80:0xA0] = 1
    go[6, 0x90:0xC0] = go[7, 0x80:0x90] = 2
    return go


class StreamDecoder:
    """Ids in, whole code points out; ``finish`` gives what is left over."""

    machine = utf8_machine()

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.whole = np.zeros(max(tokens, default=0) + 1, bool)
        for i, token in tokens.items():
            state = 0
            for byte in token:
                state = self.machine[state, byte]
                if state == REJECT:
                    break
            self.whole[i] = state == 0
        self.reset()

    def reset(self) -> None:
        self.state, self.held = 0, bytearray()

    def feed(self, ids: np.ndarray) -> bytes:
        """Bytes of the code points that are complete now.  Bytes that can't
        be part of any are passed on as they are."""
        out: list[bytes] = []
        rough = np.flatnonzero(~self.whole[ids])
        listed = ids.tolist()
        get, at, n = self.tokens.__getitem__, 0, len(listed)
        while at < n:
            if self.state == 0:
                k = int(np.searchsorted(rough, at))
                end = int(rough[k]) if k < len(rough) else n
                out.append(b"".join(map(get, listed[at:end])))
                at = end
                if at == n:
                    break
            self._bytes(get(listed[at]), out)
            at += 1
        return b"".join(out)

    def _bytes(self, token: bytes, out: list[bytes]) -> None:
        for byte in token:
            state = self.machine[self.state, byte]
            if state == REJECT and self.state:
                out.append(bytes(self.held))
                self.held.clear()
                state = self.machine[0, byte]
            self.held.append(byte)
            self.state = 0 if state == REJECT else int(state)
            if self.state == 0:
                out.append(bytes(self.held))
                self.held.clear()

    def finish(self) -> bytes:
        left = bytes(self.held)
        self.reset()
        return left

    def text(self, ids: np.ndarray) -> str:
        return self.feed(ids).decode("utf-8", "replace")


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


class Codec:
    """Texts to ids and back.  Keeps the ids of what it has met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, limit: int = 1_000_000):
        self.transducer = Transducer(ranks)
        self.decoder = StreamDecoder(self.transducer.tokens)
        split, encode = regex.compile(pattern).findall, self.transducer.encode

        def pretokens(texts: list[str]) -> list[np.ndarray]:
            return [np.array([i for w in split(t) for i in encode(w.encode())], np.uint32) for t in texts]

        self.units = UnitCache(pretokens, " ?" in pattern, limit)

    def encode(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.units(raw, np.array([0, len(raw)]))[0]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.decoder.feed(ids) + self.decoder.finish()


_codecs: dict[str, Codec] = {}


def codec(content: bytes, pattern: str) -> Codec:
    """One a worker process, as its states are worth keeping."""
    key = hashlib.sha256(content + pattern.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(read_ranks(content), pattern)
        gc.freeze()
    return _codecs[key]


def encode_documents(docs: DataFrame, ranks_file: str, pattern: str, arrays: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by a space),
    decoded_sha256 (of the bytes decoded from the ids); with ``arrays`` also
    the ids and the decoded text.  One pass over the rows, no shuffle."""
    spark = docs.sparkSession
    ship(spark)
    with open(ranks_file, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())

    def encode(batches):
        own = codec(content.value, pattern)
        decimal = [str(i) for i in range(max(own.transducer.tokens) + 1)]
        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            for a, b in words.parts(offsets, 2 * words.PART_BYTES):
                counts, ids_sha, decoded_sha, ids_list, decoded_list = [], [], [], [], []
                for ids in own.units(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]):
                    decoded = own.decode(ids)
                    counts.append(len(ids))
                    text = " ".join(map(decimal.__getitem__, ids.tolist()))
                    ids_sha.append(hashlib.sha256(text.encode()).hexdigest())
                    decoded_sha.append(hashlib.sha256(decoded).hexdigest())
                    if arrays:
                        ids_list.append(ids.tolist())
                        decoded_list.append(decoded.decode("utf-8", "replace"))
                columns = [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array(counts, pa.int64()),
                    pa.array(ids_sha, pa.string()),
                    pa.array(decoded_sha, pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if arrays:
                    columns += [pa.array(ids_list, pa.list_(pa.int32())), pa.array(decoded_list, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return documents(docs, "doc_id", "text").mapInArrow(encode, schema + (", ids array<int>, decoded string" if arrays else ""))
