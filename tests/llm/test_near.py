"""Order MinHash, fingerprints' near pairs, classes and components."""

import random

import numpy as np
import pytest
from helpers import clashing, docs, tuples, words

from telemetry_qc.llm import classes as C
from telemetry_qc.llm import fingerprints as F
from telemetry_qc.llm import order_minhash as O
from telemetry_qc.llm import words as W
from telemetry_qc.llm.components import components


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_alignment_is_the_edit_distance():
    rnd = random.Random(1)
    for _ in range(1500):
        alphabet = rnd.randint(1, 6)
        a = [rnd.randrange(alphabet) for _ in range(rnd.randint(0, 24))]
        b = [rnd.randrange(alphabet) for _ in range(rnd.randint(0, 24))] if rnd.random() < 0.5 else [x for x in a if rnd.random() > 0.2]
        d, limit = distance(a, b), rnd.randint(0, 24)
        got = O.distance_within(np.array(a, "<u4"), np.array(b, "<u4"), limit)
        assert got == (d if d <= limit else None), (a, b, limit)
        assert O.within(np.array(a, "<u4"), np.array(b, "<u4"), limit) == (d <= limit), (a, b, limit)
        assert O.banded(O.places(np.array(a, "<u4")), len(a), b, limit) == (d <= limit), (a, b, limit)


def test_near_is_edit_similarity():
    rnd = random.Random(2)
    for _ in range(600):
        a = [rnd.randrange(8) for _ in range(rnd.randint(0, 40))]
        b = list(a)
        for _ in range(rnd.randint(0, 12)):
            at = rnd.randint(0, len(b))
            b[at : at + rnd.randint(0, 1)] = [rnd.randrange(8)] * rnd.randint(0, 1)
        n = max(len(a), len(b))
        assert O.near(np.array(a, "<u4"), np.array(b, "<u4")) == (10 * distance(a, b) <= 2 * n)


def test_aligning_many_is_aligning_each(monkeypatch):
    rnd = random.Random(12)
    for cells in (O.CELLS, 0):  # 0: one by one
        monkeypatch.setattr(O, "CELLS", cells)
        for _ in range(25):
            base = [rnd.randrange(9) for _ in range(rnd.randint(0, 60))]
            texts = []
            for _ in range(12):
                w = [x for x in base if rnd.random() > 0.12] + [rnd.randrange(9)] * rnd.randint(0, 6)
                texts.append(np.array(w if rnd.random() < 0.8 else base[::-1], "<u4"))
            test = O.near_many(texts)
            for x in range(1, len(texts)):
                got = test(x, np.arange(x))
                assert got.tolist() == [O.near(texts[x], texts[y]) for y in range(x)]


def test_order_matters():
    rnd = random.Random(3)
    w = words(rnd, 300)
    h = lambda x: W.word_hashes(np.frombuffer(" ".join(x).encode(), np.uint8), np.array([0, len(" ".join(x))]))[0]
    assert len(O.kmers(h(w))) == 296 and len(O.kmers(h(w[:3]))) == 1
    # Sentences in another order have the same shingles but for the seams.
    parts = [w[i : i + 30] for i in range(0, 300, 30)]
    moved = [x for p in reversed(parts) for x in p]
    same = lambda a, b: (O.band_keys(h(a)) == O.band_keys(h(b))).mean()
    edited = [*w]
    edited[150] = "new"
    assert same(w, w) == 1 and same(w, edited) > 0.6 > 0.4 > same(w, moved)


def test_occurrences_are_told_apart():
    x = np.array([5, 9, 5, 5, 9], np.uint64)
    assert len(set(O.labelled(x).tolist())) == 5
    assert O.labelled(x)[0] == O.labelled(x[:1])[0]


def test_a_worker_keeps_small_tables_of_powers(monkeypatch):
    monkeypatch.setattr(W, "_powers", {})
    text = np.frombuffer(b"a few words " * 100, np.uint8)
    hashes, _ = W.word_hashes(text, np.array([0, len(text)]))
    assert len(set(hashes.tolist())) == 3
    assert 0 < sum(x.nbytes for x in W._powers.values()) < 6 << 20


def planted(rnd, edits, groups=12, copies=5):
    """Copies with so many words changed, and texts that share a passage."""
    rows, truth, i = [], {}, 0
    for g in range(groups):
        base = words(rnd, rnd.randint(60, 200), 3000)
        for c in range(copies):
            w = list(base)
            for at in rnd.sample(range(len(w)), edits if c else 0):
                w[at] = f"new{rnd.randrange(10**6)}"
            truth[i] = g
            rows.append((i, " ".join(w)))
            i += 1
    shared = words(rnd, 55, 3000)  # a passage that many others share
    for _ in range(15):
        truth[i] = 1000 + i
        rows.append((i, " ".join([*words(rnd, 150, 3000), *shared])))
        i += 1
    return rows, truth


def same_classes(got, truth):
    first = {}
    for i in sorted(truth):
        first.setdefault(truth[i], i)
    return sorted(got) == sorted((i, first[truth[i]]) for i in truth)


@pytest.mark.parametrize("find", [O.near_duplicates, F.similar_documents], ids=["order", "fingerprint"])
def test_planted_copies(spark, find):
    rows, truth = planted(random.Random(4), 2 if find is O.near_duplicates else 1)
    out = find(docs(spark, rows))
    assert same_classes(tuples(out, "doc_id", "class_id"), truth)
    sizes = {r["class_id"]: r["class_size"] for r in out.collect()}
    assert sizes[0] == 5
    assert sum(r["kept"] for r in out.collect()) == len(set(truth.values()))


def test_many_near_copies_of_one_text(spark):
    """One class of hundreds of different texts, and exact copies of it."""
    rnd = random.Random(5)
    base = words(rnd, 80, 3000)
    rows = [(i, " ".join([*base[: i % 80], f"x{i}", *base[i % 80 + 1 :]])) for i in range(300)]
    rows += [(1000 + i, " ".join(base)) for i in range(200)]
    out = O.near_duplicates(docs(spark, rows))
    assert {r["class_id"] for r in out.collect()} == {0} and {r["class_size"] for r in out.collect()} == {500}


def test_edge_cases(spark):
    rows = [(5, None), (6, ""), (7, " "), (8, "a b"), (9, "a b"), (9, "a b"), (None, "a b c"), (10, "a c"), (11, "long " * 30_000)]
    got = {(r["doc_id"], r["class_id"], r["kept"]) for r in O.near_duplicates(docs(spark, rows)).collect()}
    assert {(5, 5, True), (6, 5, False)} <= got  # null is empty text
    assert {(8, 8, True), (9, 8, False), (None, None, True), (10, 10, True), (11, 11, True)} <= got
    assert O.near_duplicates(docs(spark, [])).count() == 0
    assert O.near_duplicates(clashing(spark, [(1, "a"), (2, "a")])).where("class_id = 1").count() == 2
    kept = O.keep_one(docs(spark, [(1, "x y"), (1, "x y"), (2, "x y"), (3, "z")]))
    assert tuples(kept, "doc_id", "text") == [(1, "x y"), (3, "z")]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_fingerprint_places_estimate_jaccard():
    rnd = random.Random(6)
    a = np.array([rnd.getrandbits(64) for _ in range(400)], np.uint64)
    for share in (0.2, 0.5, 0.9):
        b = a.copy()
        b[int(400 * share) :] = [rnd.getrandbits(64) for _ in range(400 - int(400 * share))]
        x, y = F.shingles(a), F.shingles(b)
        exact = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs(F.likeness(F.places(F.signature(x)), F.places(F.signature(y))) - exact) < 0.15
    assert (F.signature(np.zeros(0, np.uint32)) == 0xFFFFFFFF).all()


def test_jaccard_is_exact():
    rnd = random.Random(7)
    for _ in range(300):
        a, b = ([rnd.randrange(3) for _ in range(rnd.randint(0, 14))] for _ in "ab")
        k = lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        x, y = k(a), k(b)
        want = len(x & y) / len(x | y) if x | y else 1.0
        assert abs(F.jaccard(np.array(a, "<u4"), np.array(b, "<u4")) - want) < 1e-12


def fingerprint(text):
    return F.places(F.signature(F._shingled([text])[0]))


def edited_rows(rows):
    """Brute force over (doc_id, text) in the order of the result."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text) // 3
        change = text[: len(text) - n] + after[:n]
        a, b, c = fingerprint(text), fingerprint(change), fingerprint(after)
        out.append((doc_id, len(text), F.hashlib.sha256(change.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), F.likeness(a, b), F.likeness(a, c)))
    return out


def test_edited_fingerprints(spark):
    rnd = random.Random(8)
    rows = [(i * 7, " ".join(words(rnd, rnd.randint(0, 60)))) for i in range(200)]
    rows += [(None, "without an id é中"), (-3, None), (5000, "x"), (6000, "é" * 10), (6001, "long " * 50_000), (2**50, "far")]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    got = F.edited_fingerprints(docs(spark, rows).repartition(7))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(edited_rows(ordered), key=repr)


def test_edited_fingerprints_edge_cases(spark):
    one = F.edited_fingerprints(docs(spark, [(1, "a b c d e f g h i")])).first()
    assert one["near_next"] == 1.0  # its own next
    same = F.edited_fingerprints(clashing(spark, [(1, "a b c"), (1, "a b c"), (2, "a b c")])).collect()
    assert len(same) == 3 and len({r["fingerprint"] for r in same}) == 1
    assert F.edited_fingerprints(docs(spark, [])).count() == 0
    hot = F.edited_fingerprints(docs(spark, [(9, f"text {i}") for i in range(50)] + [(i, "y") for i in range(50)]))
    assert hot.count() == 100


def test_components(spark):
    rnd = random.Random(9)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    want = sorted((v, root(v)) for v in {x for e in edges for x in e if e[0] != e[1]})
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert tuples(got, "id", "label") == sorted(want, key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def all_pairs(texts):
    """Class of every text, by comparing all pairs."""
    label = list(range(len(texts)))
    ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    coded = [np.array([ids[w] for w in t], "<u4") for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and O.near(coded[i], coded[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


@pytest.mark.parametrize("block", [C.BLOCK_TEXTS, 2])
def test_chains_inside_a_bucket(spark, monkeypatch, block):
    """A~B~C with A!~C: whoever leads the only bucket, no link is lost."""
    monkeypatch.setattr(C, "BLOCK_TEXTS", block)
    rnd = random.Random(13)
    texts = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(100)]
        # 15 more words changed a step: only neighbours are near.
        texts += [[f"s{w}" if i < 15 * step else w for i, w in enumerate(base)] for step in range(5)]
    rnd.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    # One bucket for all: links then hang on the comparison alone.
    out = C.near_classes(docs(spark, rows), lambda hashes: np.zeros(1, np.uint64), O.near, O.near_many, O.rare_tokens)
    want = all_pairs(texts)
    assert len(set(want)) == 12
    assert tuples(out, "doc_id", "class_id") == sorted(enumerate(want), key=repr)


def test_a_common_passage_and_little_else(spark, monkeypatch):
    """One bucket of many texts apart: near ones among them are found by
    their rare word pairs, however many share the passage."""
    monkeypatch.setattr(C, "APART", 4)
    rnd = random.Random(14)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for g in range(60):
        own = [f"g{g}w{i}" for i in range(rnd.randint(30, 60))]
        texts.append(passage + own)
        if g % 3 == 0:
            texts.append(passage + changed(rnd, own, len(own) // 8))
    rnd.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    out = C.near_classes(docs(spark, rows), lambda hashes: np.zeros(1, np.uint64), O.near, O.near_many, O.rare_tokens)
    assert tuples(out, "doc_id", "class_id") == sorted(enumerate(all_pairs(texts)), key=repr)


def test_frequent_rare_tokens_lose_no_link(spark, monkeypatch):
    """Also the rarest word pairs of these texts are held by many texts
    apart; near texts that differ evenly are found all the same."""
    monkeypatch.setattr(C, "APART", 4)
    rnd = random.Random(16)
    texts = []
    for g in range(60):
        own = [f"s{s}v{rnd.randrange(2)}w{i}" for s in range(20) for i in range(5)]
        texts += [own, [f"g{g}x{i}" if i % 6 == 3 else w for i, w in enumerate(own)]]
    rnd.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    out = C.near_classes(docs(spark, rows), lambda hashes: np.zeros(1, np.uint64), O.near, O.near_many, O.rare_tokens)
    want = all_pairs(texts)
    assert len(set(want)) == 60
    assert tuples(out, "doc_id", "class_id") == sorted(enumerate(want), key=repr)


def test_near_texts_share_a_rare_token():
    """Whatever the order of rarity."""
    rnd = random.Random(15)
    for _ in range(400):
        n = rnd.randint(5, 60)
        a = [rnd.randrange(8 if n < 20 else 1000) for _ in range(n)]
        b = [rnd.randrange(10**6) if rnd.random() < 0.15 else x for x in a]
        del b[: rnd.randint(0, 2)]
        a, b = np.array(a, "<u4"), np.array(b, "<u4")
        if not O.near(a, b):
            continue
        salt = rnd.randrange(2**63)
        rank = lambda t: hash((salt, int(t)))
        (x, i), (y, j) = O.rare_tokens(a), O.rare_tokens(b)
        assert set(sorted(x.tolist(), key=rank)[:i]) & set(sorted(y.tolist(), key=rank)[:j])


def test_a_passage_that_is_most_of_the_text(spark, monkeypatch):
    """Its word pairs are among the rarest that a text has, in buckets of many
    texts apart; their rare words part these, and no link is lost."""
    monkeypatch.setattr(C, "APART", 4)
    work, real = [], C.linked

    def linked(rest, sizes, *more):
        work.append(sum(r["n"] * r["far"] for r in sizes.where("n > 1").dropDuplicates(["mark0", "mark1"]).collect()))
        return real(rest, sizes, *more)

    monkeypatch.setattr(C, "linked", linked)
    rnd = random.Random(17)
    texts = []
    for g in range(80):
        own = [f"g{g}w{i}" for i in range(28)]
        texts.append(own + ["is", "on"] * 36)
        if g % 4 == 0:
            texts.append(changed(rnd, own, 5) + ["is", "on"] * 36)
    rnd.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    out = C.near_classes(docs(spark, rows), lambda hashes: np.zeros(1, np.uint64), O.near, O.near_many, O.rare_tokens, O.rare_words)
    want = all_pairs(texts)
    assert len(set(want)) == 80
    assert tuples(out, "doc_id", "class_id") == sorted(enumerate(want), key=repr)
    assert sum(work) < 20 * len(texts)


def test_a_text_is_in_few_pairs_with_leaders(spark, monkeypatch):
    """However many leaders its buckets have."""
    work, real = [], C.tested

    def tested(pairs, *more):
        work.append(pairs.count())
        return real(pairs, *more)

    monkeypatch.setattr(C, "tested", tested)
    rnd = random.Random(19)
    texts = []
    for g in range(60):
        own = [f"g{g}w{i}" for i in range(40)]
        texts += [own, own[:1] + changed(rnd, own[1:], 5)]
    rnd.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    keys = lambda hashes: np.random.default_rng(int(hashes[0])).choice(200, 20, False).astype(np.uint64)
    out = C.near_classes(docs(spark, rows), keys, O.near, O.near_many, O.rare_tokens, O.rare_words)
    want = all_pairs(texts)
    assert len(set(want)) == 60
    assert tuples(out, "doc_id", "class_id") == sorted(enumerate(want), key=repr)
    assert sum(work) <= 4 * len(texts)


def test_a_small_bucket_is_one_group(spark, tmp_path):
    """A text apart goes there once, not also with those that passed."""
    rnd = random.Random(20)
    base = [f"w{i}" for i in range(40)]
    texts = [base] + [changed(rnd, base, 4) for _ in range(9)]
    texts += [[f"g{g}w{i}" for i in range(40)] for g in range(30)]
    words = [(i, np.array([W.mix(np.array([hash(w) & 0xFFFFFFFF], np.uint64))[0] & np.uint64(0xFFFFFFFF) for w in t], "<u4").tobytes()) for i, t in enumerate(texts)]
    rest = [(i, 7, 0 if i < 10 else i, i >= 10) for i in range(len(texts))]
    rest = spark.createDataFrame(rest, "node long, band long, label long, apart boolean")
    seen = str(tmp_path / "seen")

    def near_many(found):
        with open(seen, "a") as f:
            f.write(f"{len(found)}\n")
        return O.near_many(found)

    links = C.linked(rest, C.sizes_of(rest), spark.createDataFrame(words, "node long, words binary"), near_many)
    assert links.collect() == []
    assert [int(x) for x in open(seen)] == [len(texts)]


def test_a_text_gives_its_rarest_tokens_only(spark, monkeypatch):
    """Not a row for each of its tokens; near texts have one in common."""
    rows, real = [], C.saved

    def saved(df, name):
        out = real(df, name)
        rows.append(out.count())
        return out

    monkeypatch.setattr(C, "saved", saved)
    rnd = np.random.default_rng(21)
    passage = rnd.integers(0, 2**32, 60, dtype=np.uint32)
    texts = [np.concatenate([passage, rnd.integers(0, 2**32, 60, dtype=np.uint32)]) for _ in range(80)]
    texts += [np.where(rnd.random(120) < 0.1, rnd.integers(0, 2**32, 120, dtype=np.uint32), t) for t in texts]
    texts = [t.astype("<u4") for t in texts]
    table = spark.createDataFrame([(i, t.tobytes()) for i, t in enumerate(texts)], "node long, words binary")
    for rare in (O.rare_tokens, O.rare_words):
        found = C.by_rare_tokens(table.select("node"), table, rare).collect()
        assert len(found) == sum(rare(t)[1] for t in texts) < 0.5 * sum(len(rare(t)[0]) for t in texts)
        own = [set() for _ in texts]
        for r in found:
            own[r["node"]].add(r["band"])
        assert all(own[i] & own[i + 80] for i in range(80) if O.near(texts[i], texts[i + 80]))
        shared = np.array(rare(np.append(passage, 1).astype("<u4"))[0][:59]).view(np.int64).tolist()
        assert max(sum(t in x for x in own) for t in shared) < 80  # the passage is not rare
    assert max(rows) == len(texts)


def test_tokens_of_one_class_are_not_given(spark):
    """Near texts of one class, however many, give only what texts of another
    class have among their rarest too; near texts of two classes still meet."""
    rnd = np.random.default_rng(22)
    base = rnd.integers(0, 2**32, 120, dtype=np.uint32)
    texts = [np.where(rnd.random(120) < 0.05, rnd.integers(0, 2**32, 120, dtype=np.uint32), base) for _ in range(40)]
    texts += [rnd.integers(0, 2**32, 120, dtype=np.uint32) for _ in range(40)]
    texts += [np.where(rnd.random(120) < 0.1, rnd.integers(0, 2**32, 120, dtype=np.uint32), t) for t in texts[70:]]
    texts = [t.astype("<u4") for t in texts]
    table = spark.createDataFrame([(i, t.tobytes()) for i, t in enumerate(texts)], "node long, words binary")
    nodes = spark.createDataFrame([(i, 0 if i < 40 else i) for i in range(len(texts))], "node long, label long")
    for rare in (O.rare_tokens, O.rare_words):
        found = C.by_rare_tokens(nodes, table, rare).collect()
        own = [set() for _ in texts]
        for r in found:
            own[r["node"]].add(r["band"])
        assert not any(own[:70])
        near = [i for i in range(70, 80) if O.near(texts[i], texts[i + 10])]
        assert len(near) > 5 and all(own[i] & own[i + 10] for i in near)


def test_large_buckets_are_compared_whole_if_that_is_little(spark, monkeypatch):
    """One large bucket among many texts is not dealt anew; its links are found."""
    monkeypatch.setattr(C, "APART", 4)
    monkeypatch.setattr(C, "by_rare_tokens", lambda *_: pytest.fail("dealt anew"))
    rnd = random.Random(23)
    texts = []
    for g in range(12):
        own = [f"g{g}w{i}" for i in range(40)]
        texts += [own, changed(rnd, own, 5)]
    many = [[f"o{g}w{i}" for i in range(16)] for g in range(120)]
    keys = lambda hashes: np.zeros(1, np.uint64) if len(hashes) > 20 else hashes[:1]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts + many)]
    out = C.near_classes(docs(spark, rows), keys, O.near, O.near_many, O.rare_tokens, O.rare_words)
    want = all_pairs(texts) + list(range(len(texts), len(rows)))
    assert len(set(want[:24])) == 12
    assert tuples(out, "doc_id", "class_id") == sorted(enumerate(want), key=repr)


def test_texts_of_the_last_buckets_in_one(spark):
    """Where the buckets name more pairs than there are."""
    schema = "node long, band long, label long, apart boolean"
    rest = spark.createDataFrame([(n, b, n, n > 0) for b in range(30) for n in range(20)], schema)
    held, sizes = C.fewest(rest, C.sizes_of(rest))
    assert [(r["n"], r["far"]) for r in sizes.collect()] == [(20, 20)]
    assert sorted((r["node"], r["label"]) for r in held.collect()) == [(n, n) for n in range(20)]
    rest = spark.createDataFrame([(2 * b + n, b, 2 * b + n, n > 0) for b in range(30) for n in range(2)], schema)
    assert C.fewest(rest, C.sizes_of(rest))[0] is rest


def test_near_texts_share_a_rare_word():
    """Whatever the order of rarity."""
    rnd = random.Random(18)
    seen = 0
    for _ in range(400):
        n = rnd.randint(1, 60)
        a = [rnd.randrange(8 if n < 20 else 1000) for _ in range(n)]
        b = [rnd.randrange(10**6) if rnd.random() < 0.15 else x for x in a]
        del b[: rnd.randint(0, 2)]
        a, b = np.array(a, "<u4"), np.array(b, "<u4")
        if not O.near(a, b):
            continue
        seen += 1
        salt = rnd.randrange(2**63)
        rank = lambda t: hash((salt, int(t)))
        (x, i), (y, j) = O.rare_words(a), O.rare_words(b)
        assert set(sorted(x.tolist(), key=rank)[:i]) & set(sorted(y.tolist(), key=rank)[:j])
    assert seen > 100


def changed(rnd, text, n, evenly=False):
    """The text with n words changed, inserted or dropped (changed only, at
    even distances, if ``evenly``)."""
    out = list(text)
    at = [int((i + 0.5) * len(out) / n) for i in range(n)] if evenly else rnd.sample(range(len(out)), n)
    for i in sorted(at, reverse=True):
        kind = 0 if evenly else rnd.randrange(4)
        out[i : i + (kind != 2)] = [] if kind == 1 else [f"new{rnd.randrange(10**9)}"]
    return out


def shared_key(a, b):
    code = lambda t: W.word_hashes(np.frombuffer(" ".join(t).encode(), np.uint8), np.array([0, len(" ".join(t).encode())]))[0]
    return len(np.intersect1d(O.band_keys(code(a)), O.band_keys(code(b)))) > 0


@pytest.mark.parametrize("evenly", [False, True])
@pytest.mark.parametrize("similarity, least", [(0.80, 0.9), (0.85, 0.95), (0.90, 0.99)])
def test_candidates_by_edit_similarity(similarity, least, evenly):
    """Near pairs that share a band key, by length and similarity."""
    rnd = random.Random(14)
    for n in (5, 8, 10, 14, 15, 18, 25, 40, 55, 63, 64, 75, 100, 200, 600):
        edits, found, pairs = int((1 - similarity) * n + 1e-9), 0, 0
        while pairs < 60 and edits:
            a = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
            b = changed(rnd, a, edits, evenly)
            if distance(a, b) * 5 > max(len(a), len(b)) if n < 100 else len(b) < n:
                continue
            pairs += 1
            found += shared_key(a, b)
        # Every fifth word changed is the worst case for runs of words.
        low = 1.0 if n <= O.SHORT - 3 else least if not evenly or similarity > 0.8 else 0.7
        assert not edits or found >= low * pairs, (n, found, pairs)


def test_short_texts_share_a_key_if_near():
    rnd = random.Random(15)
    for _ in range(1500):
        a = [f"w{rnd.randrange(6)}" for _ in range(rnd.randint(1, O.SHORT))]
        b = changed(rnd, a, min(len(a), rnd.randint(1, 3)))
        if b and max(len(a), len(b)) <= O.SHORT and distance(a, b) <= O.edits(max(len(a), len(b))):
            assert shared_key(a, b), (a, b)


def test_spread_edits_against_all_pairs(spark):
    rnd = random.Random(16)
    texts = []
    for n in (10, 14, 20, 45, 60, 90, 150):
        for share in (0.1, 0.15, 0.2):
            for evenly in (False, True):
                base = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
                texts += [base, changed(rnd, base, int(share * n + 1e-9), evenly)]
    out = O.near_duplicates(docs(spark, [(i, " ".join(t)) for i, t in enumerate(texts)]))
    assert tuples(out, "doc_id", "class_id") == sorted(enumerate(all_pairs(texts)), key=repr)
