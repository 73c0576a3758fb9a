"""Near-dedup by order MinHash, sensitive to edit similarity.

The k-mers are runs of words, labelled by their occurrence in the document:
three words, or two in texts of under ``LONG`` words.  Each of ``BANDS`` hash
permutations samples the three smallest and keeps them in the order of the
text; such a sample is a band key.  A pair whose k-mers have the Jaccard
similarity J is a candidate with a chance of about 1 - (1 - J**3)**128: 0.99
at 0.33.  Texts of up to ``SHORT`` words have as keys whatever is left after
as many deletions as their length allows edits, which misses no near pair.
Near texts differ in length, so a text has the keys of its own length and of
the longest text that may be near it.
Candidates are verified by a banded alignment of their words: near means an
edit distance of at most a fifth of the longer text, that is an edit
similarity of 0.8 or more.
The band goes down one column of the alignment after the other as two sets of
bits, one bit a cell (bands of over ``CELLS`` cells: diagonals are walked
outwards instead, as far as the distance allows); a bound from shared word
pairs, which is exact, first drops pairs that can't be that close.

Equal texts are always one class.  Null text is empty text; all empty texts
are equal.  Rows of one doc_id with different
texts are documents of their own; rows equal in both are copies.  A class
takes the doc_id of its first document; documents without doc_id come first,
and give a null class_id.  An empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame

from . import words
from .classes import near_classes
from .common import documents, order_key, saved, small

K = 5
BANDS = 128
SAMPLE = 3
SIMILARITY = 0.8
#: Texts of up to SHORT words have exact keys, of under LONG words k-mers of
#: two words, others of three.
SHORT = 14
LONG = 64

_rng = np.random.default_rng(20_251)
_A = _rng.integers(0, 1 << 31, BANDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, BANDS, dtype=np.uint32)
_FACTORS = words.mix(np.arange(1, K + 1, dtype=np.uint64)) | np.uint64(1)
_PLACES = words.mix(np.arange(101, 101 + SHORT, dtype=np.uint64)) | np.uint64(1)
_BAND = np.arange(BANDS, dtype=np.uint64)


def kmers(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of all runs of k words (of all words if there are fewer)."""
    n = len(hashes)
    k = min(k, n)
    return words.mix(sum((hashes[i : n - k + 1 + i] * _FACTORS[i] for i in range(k)), np.full(max(n - k + 1, 1), k, np.uint64)))


def labelled(found: np.ndarray) -> np.ndarray:
    """Each k-mer with the number of its occurrence, as 32 bits."""
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    new = np.ones(len(found), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.arange(len(found))
    occurrence = np.empty(len(found), np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return (words.mix(found + occurrence * _FACTORS[0]) >> np.uint64(32)).astype(np.uint32)


def deletion_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of what is left of a short text without up to a fifth of its
    words: near texts have one in common.  A text without words has one fixed
    key."""
    n, out = len(hashes), []
    if not n:
        return words.mix(np.zeros(1, np.uint64))
    for left in range(n, n - edits(n) - 1, -1):
        at = np.array(list(combinations(range(n), left)), np.int64).reshape(-1, left)
        total = (hashes[at] * _PLACES[:left]).sum(1, dtype=np.uint64)
        out.append(words.mix(words.mix(total) + np.uint64(left)))
    return np.unique(np.concatenate(out))


def sample_keys(hashes: np.ndarray, k: int) -> np.ndarray:
    """The order samples of a text's runs of k words, one a band."""
    found = kmers(hashes, k)
    x = labelled(found)
    picked = np.empty((SAMPLE, BANDS), np.int64)
    group = max(1, min(BANDS, (1 << 18) // len(x)))
    for g in range(0, BANDS, group):
        h = _A[g : g + group, None] * x + _B[g : g + group, None]
        rows = np.arange(len(h))
        for i in range(SAMPLE):
            picked[i, g : g + group] = h.argmin(1)
            h[rows, picked[i, g : g + group]] = 0xFFFFFFFF
    picked.sort(axis=0)
    sample = sum((found[at] * _FACTORS[i] for i, at in enumerate(picked)), np.full(BANDS, k, np.uint64))
    return words.mix(words.mix(sample) + _BAND)


def edits(n: int, similarity: float = SIMILARITY) -> int:
    """Edits that a text of n words may be away from one not longer."""
    return int((1 - similarity) * n + 1e-9)


def level(n: int) -> int:
    """Words of a k-mer where the longer text has n words; 0 for exact keys."""
    return 0 if n <= SHORT else 2 if n < LONG else 3


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """The band keys of a document, given its word hashes."""
    n = len(hashes)
    levels = sorted({level(n), level(int(n / SIMILARITY + 1e-9))})
    return np.concatenate([sample_keys(hashes, k) if k else deletion_keys(hashes) for k in levels])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        end = min(n, at + step)
        differ = a[at:end] != b[at:end]
        k = int(differ.argmax())
        if differ[k]:
            return at + k
        at, step = end, step * 2
    return n


def distance_within(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Edit distance, or None if it is over ``limit``.  ``reach[d]`` is how
    far a is read on diagonal d with the edits so far."""
    k = _common(a, b)
    a, b = a[k:], b[k:]
    k = _common(a[::-1], b[::-1])
    a, b = a[: len(a) - k], b[: len(b) - k]
    n, m = len(a), len(b)
    goal = m - n
    if abs(goal) > limit:
        return None
    if not n or not m:
        return max(n, m)
    low = -(1 << 40)
    mid = limit + 1
    reach = np.full(2 * mid + 1, low, np.int64)
    reach[mid] = 0  # the texts now differ in their first words
    if goal == 0 and n == 0:
        return 0
    for e in range(1, limit + 1):
        # Diagonals from which the goal's can still be reached.
        lo = max(-e, goal - (limit - e), -n)
        hi = min(e, goal + (limit - e), m)
        if lo > hi:
            return None
        d = np.arange(lo, hi + 1)
        at = slice(mid + lo, mid + hi + 1)
        i = np.maximum(reach[at] + 1, np.maximum(reach[mid + lo - 1 : mid + hi], reach[mid + lo + 1 : mid + hi + 2] + 1))
        i = np.minimum(i, np.minimum(n, m - d))
        active = np.flatnonzero((i >= 0) & (i + d >= 0) & (i < n) & (i + d < m))
        active = active[a[i[active]] == b[i[active] + d[active]]]
        for _ in range(4):
            if not len(active):
                break
            i[active] += 1
            x = i[active]
            active = active[(x < n) & (x + d[active] < m)]
            active = active[a[i[active]] == b[i[active] + d[active]]]
        for j in active.tolist():
            x = int(i[j])
            i[j] = x + _common(a[x:], b[x + int(d[j]) :])
        reach[at] = np.where(i < 0, low, i)
        if lo <= goal <= hi and reach[mid + goal] >= n:
            return e
    return None


#: Cells of a band that is aligned by bits; a word's places are one number.
CELLS = 2_000_000


def places(a: np.ndarray) -> dict[int, int]:
    """For every word of a the set of its places, as bits."""
    out, bit = {}, 1
    for w in a.tolist():
        out[w] = out.get(w, 0) | bit
        bit <<= 1
    return out


def banded(at: dict[int, int], n: int, b: list[int], limit: int) -> bool:
    """Whether the text of n words with the places ``at`` is at most ``limit``
    edits from b.

    Bit t of a column j of the alignment is row j - limit + t of 0..n, so that
    the window moves down by a row a column.  ``up`` and ``down`` hold where a
    row is one more, or one less, than the row above; cells outside of the band
    count as further away than they are, which changes no distance within it.
    The distance is followed along the band's lower edge down to row n, and
    then along that row."""
    m = len(b)
    if abs(n - m) > limit:
        return False
    if not n or not m:
        return True
    full = (1 << (2 * limit + 1)) - 1
    edge = 1 << (2 * limit)
    up, down = full >> limit << limit, 0
    slant = max(n - limit, 0)
    far = min(n, limit)
    # From the edge's end on, the distance falls by one a column at most.
    most = limit + m - slant
    for j, w in enumerate(b):
        x = at.get(w, 0)
        x = (x >> (j - limit) if j >= limit else x << (limit - j)) & full
        same = ((((x & up) + up) ^ up) | x | down) & full
        more = down | (full ^ (same | up))
        less = same & up
        if j < slant:
            if not same & edge:
                far += 1
                if far > most:
                    return False
        else:
            last = 1 << (n - 1 - j + limit)
            if more & last:
                far += 1
            elif less & last:
                far -= 1
        same >>= 1
        up = less | (full ^ (same | more))
        down = same & more
    return far <= limit


def within(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    """Whether a and b are at most ``limit`` edits apart."""
    if len(a) * (2 * limit + 1) > CELLS:
        return distance_within(a, b, limit) is not None
    k = _common(a, b)
    a, b = a[k:], b[k:]
    k = _common(a[::-1], b[::-1])
    a, b = a[: len(a) - k], b[: len(b) - k]
    return banded(places(a), len(a), b.tolist(), limit)


def _pairs(w: np.ndarray) -> np.ndarray:
    return np.sort(w[:-1].astype(np.uint64) << np.uint64(32) | w[1:])


def near(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Edit similarity of the words, 1 - distance / longer, at least
    ``similarity``."""
    n = max(len(a), len(b))
    limit = int((1 - similarity) * n + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return False
    if len(a) > 1 and len(b) > 1:
        # An edit touches at most two word pairs.
        x, y = _pairs(a), _pairs(b)
        ux, cx = np.unique(x, return_counts=True)
        uy, cy = np.unique(y, return_counts=True)
        at = np.minimum(np.searchsorted(uy, ux), len(uy) - 1)
        shared = np.where(uy[at] == ux, np.minimum(cx, cy[at]), 0).sum()
        if shared < n - 1 - 2 * limit:
            return False
    return within(a, b, limit)


def numbered(x: np.ndarray) -> np.ndarray:
    """Tokens of x: each with the number of its occurrence."""
    order = np.argsort(x, kind="stable")
    new = np.concatenate(([True], x[order][1:] != x[order][:-1]))
    at = np.arange(len(x))
    again = np.empty(len(x), np.uint64)
    again[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return words.mix(x + again * _FACTORS[0])


def rare_words(w: np.ndarray, similarity: float = SIMILARITY) -> tuple[np.ndarray, int]:
    """As ``rare_tokens``, of a text's words: an edit touches one word, so
    that texts that share less than their edits leave, a passage and no more,
    have none of the passage's words among their rarest."""
    n = len(w)
    if not n:
        return np.zeros(0, np.uint64), 0
    # The longest of the two texts keeps all words but its edits.
    return numbered(w.astype(np.uint64)), edits(n, similarity) + 1


def rare_tokens(w: np.ndarray, similarity: float = SIMILARITY) -> tuple[np.ndarray, int]:
    """A text's word pairs, numbered where they repeat, and how many of the
    rarest it takes that a near text has one of its own rarest among them."""
    n = len(w)
    if n < 2:
        return words.mix(w.astype(np.uint64)), n
    pairs = w[:-1].astype(np.uint64) << np.uint64(32) | w[1:]
    # An edit touches at most two word pairs; the longer text may be this one
    # or another of up to n / similarity words.
    shared = min(m - 1 - 2 * edits(m, similarity) for m in range(n, min(int(n / similarity + 1e-9), n + 5) + 1))
    return numbered(pairs), min(n - 1, n - 1 - max(shared, 1) + 1)


def sharing(tokens: list[np.ndarray]):
    """A function of a place and other places that tells how many tokens the
    text there shares with each of those, repeats counted."""
    owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    _, token = np.unique(np.concatenate([*tokens, np.zeros(0, np.uint64)]), return_inverse=True)
    token = token.astype(np.int64)
    n_tokens = token.max(initial=0) + 1
    both, count = np.unique(owner * n_tokens + token, return_counts=True)
    who, token = np.divmod(both, n_tokens)
    ends = np.searchsorted(who, np.arange(len(tokens) + 1))
    # The texts that have a token, token by token.
    order = np.argsort(token, kind="stable")
    holders, held = who[order], count[order]
    begin = np.searchsorted(token[order], np.arange(n_tokens + 1))

    mine = np.zeros(n_tokens, np.int64)

    def shared_with(x: int, ys: np.ndarray) -> np.ndarray:
        own = slice(ends[x], ends[x + 1])
        first, many = begin[token[own]], begin[token[own] + 1] - begin[token[own]]
        size = ends[ys + 1] - ends[ys]
        if size.sum() > many.sum():  # through the tokens of x, else those of ys
            at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
            return np.bincount(holders[at], np.minimum(held[at], np.repeat(count[own], many)), len(tokens))[ys]
        at = np.repeat(ends[ys] - np.cumsum(size) + size, size) + np.arange(size.sum())
        mine[token[own]] = count[own]
        common = np.minimum(count[at], mine[token[at]])
        mine[token[own]] = 0
        return np.bincount(np.repeat(np.arange(len(ys)), size), common, len(ys))

    return shared_with


def near_many(texts: list[np.ndarray], similarity: float = SIMILARITY):
    """A function of a place and earlier places that tells which of them are
    near it; as ``near``, for many pairs at a time."""
    sizes = np.array([len(t) for t in texts])
    shared_words = sharing([t.astype(np.uint64) for t in texts])
    shared_pairs = sharing([_pairs(t) if len(t) > 1 else np.zeros(0, np.uint64) for t in texts])

    def test(x: int, ys: np.ndarray) -> np.ndarray:
        longer = np.maximum(sizes[x], sizes[ys])
        limits = ((1 - similarity) * longer + 1e-9).astype(np.int64)
        out = np.zeros(len(ys), bool)
        may = np.flatnonzero(np.abs(sizes[x] - sizes[ys]) <= limits)
        # An edit touches one word and at most two word pairs.
        if len(may):
            may = may[shared_words(x, ys[may]) >= (longer - limits)[may]]
        if len(may):
            may = may[shared_pairs(x, ys[may]) >= (longer - 1 - 2 * limits)[may]]
        if not len(may):
            return out
        if len(texts[x]) * (2 * int(limits[may].max()) + 1) > CELLS:
            out[may] = [within(texts[x], texts[ys[i]], int(limits[i])) for i in may]
            return out
        own = places(texts[x])
        out[may] = [banded(own, len(texts[x]), texts[ys[i]].tolist(), int(limits[i])) for i in may]
        return out

    return test


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, kept; one row per document."""
    return near_classes(docs, band_keys, near, near_many, rare_tokens, rare_words).drop("key")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that are the first of their class, once each, with the
    columns of documents."""
    found = saved(near_classes(docs, band_keys, near, near_many, rare_tokens, rare_words).select("key", "kept"), "classes")
    others = small(saved(found.where("not kept").select("key").distinct(), "others"))
    out = documents(docs).withColumn("key", order_key()).join(others, "key", "left_anti")
    # Rows stated many times have one key.
    many = saved(found.where("kept").groupBy("key").count().where("count > 1").select("key"), "many")
    if many.limit(1).count():
        many = small(many)
        out = out.join(many, "key", "left_anti").unionByName(out.join(many, "key", "left_semi").dropDuplicates(["key"]))
    return out.drop("key")
