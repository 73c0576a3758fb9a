"""Kneser-Ney classifier and log-bilinear model."""

import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import clashing, docs, tuples

from pyspark.sql import functions as F

from telemetry_qc.llm import common as CO
from telemetry_qc.llm import kneser_ney as K
from telemetry_qc.llm import log_bilinear as B

LABELS = "doc_id long, quality int, toxic int"


def prose(rnd, n, vocabulary):
    out = []
    for _ in range(n):
        out += [rnd.choice(["the", "of", "and", "to"]), rnd.choice(vocabulary)]
        if rnd.random() < 0.2:
            out[-1] += "."
            out.append(rnd.choice(vocabulary).capitalize())
    return " ".join(out)


def corpus(rnd, n=120):
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(300)]
    good = [(i, prose(rnd, rnd.randint(15, 60), vocabulary)) for i in range(n)]
    bad = []
    for i in range(n, n + 40):
        w = [rnd.choice(vocabulary) for _ in range(60)]
        kind = i % 4
        if kind == 0:
            w = [x.upper() + "!!" for x in w]
        elif kind == 1:
            w = [x + rnd.choice(["###", "%%%"]) for x in w]
        elif kind == 2:
            w = [x for x in w[:4] for _ in range(20)]
        else:
            w = [y for x in w for y in (x, "|")]
        bad.append((i, " ".join(w)))
    return good, bad


def test_symbols():
    s = K.Symbols(["the", "of"])
    of = lambda t: list(s.of(t))
    assert of("The of") == [K.FIRST_WORD, K.FIRST_WORD + 1, K.END]
    assert of("") == [K.END]
    assert of("word, Word. WORD!! x1 a@b ### of%%%") == [
        K.LOW, K.COMMA, K.CAP, K.STOP, K.UPPER, K.SIGNS, K.DIGIT, K.DIGIT, K.SIGN, K.NOISY, K.END]
    assert of("the the the") == [K.FIRST_WORD, K.REPEAT, K.REPEAT, K.END]
    assert of("ab cd ab cd ab")[2:] == [K.LOW, K.REPEAT, K.REPEAT, K.END]


def brute_trigrams(symbols):
    """(two before, symbol); repeats are no context."""
    out, context = [], [K.START, K.START]
    for s in symbols:
        out.append((*context[-2:], s))
        if s != K.REPEAT:
            context.append(s)
    return out


def test_trigrams():
    rnd = random.Random(1)
    texts = [[rnd.choice([K.REPEAT, 20, 21, 22]) for _ in range(rnd.randint(0, 9))] + [K.END] for _ in range(80)]
    languages = np.array([rnd.randrange(3) for _ in texts], np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    got = K.trigrams(np.array(sum(texts, []), np.uint8), ends, languages)
    want = [int(lang) << 24 | a << 16 | b << 8 | c for t, lang in zip(texts, languages) for a, b, c in brute_trigrams(t)]
    assert got.tolist() == want


def brute_kneser_ney(trusted, asked):
    """log p of asked trigrams from the trusted ones, by the formulas."""
    c3 = Counter(trusted)
    c2 = Counter((v, w) for _, v, w in c3)
    c1 = Counter(w for _, w in c2)
    order = {3: (c3, lambda g: g[:2]), 2: (c2, lambda g: g[:1]), 1: ({(w,): n for w, n in c1.items()}, lambda g: ())}
    discounts, contexts = {}, {}
    for i, (c, ctx) in order.items():
        t = Counter(c.values())
        d = []
        for k in (1, 2, 3):
            y = t[1] / (t[1] + 2 * t[2]) if t[1] + t[2] else 0
            est = k - (k + 1) * y * t[k + 1] / t[k] if t[k] and t[1] else 0.5 * k
            d.append(max(0.05, min(est, k - 0.05)))
        discounts[i] = d
        group = defaultdict(list)
        for g, n in c.items():
            group[ctx(g)].append(n)
        contexts[i] = group

    def p(i, g):
        if i == 0:
            return 1 / K.SYMBOLS
        below = p(i - 1, g[1:])
        c, ctx = order[i]
        ns, d = contexts[i].get(ctx(g)), discounts[i]
        if not ns:
            return below
        n = c.get(g, 0)
        less = d[min(n, 3) - 1] if n else 0
        left = sum(d[min(x, 3) - 1] for x in ns)
        return (n - less) / sum(ns) + left / sum(ns) * below

    return {g: math.log(p(3, g)) for g in asked}


def test_probabilities_against_brute_force(spark):
    rnd = random.Random(2)
    trusted = [(rnd.choice([0, 20, 21]), rnd.choice([20, 21, 22]), rnd.choice([1, 20, 21, 22, 23])) for _ in range(300)]
    asked = {*trusted, *((a, b, c) for a in (0, 20, 30) for b in (20, 31) for c in (1, 22, 40))}
    n = Counter(trusted)
    number = lambda g: 1 << 24 | g[0] << 16 | g[1] << 8 | g[2]
    halves = trusted[:170], trusted[170:]
    n1, n2 = map(Counter, halves)
    schema = "gram long, n1 long, n2 long"
    rows = [(number(g), n1[g], n2[g]) for g in asked] + [(2 << 24 | 20 << 16 | 20 << 8 | 20, 3, 0)]  # another language
    got = {r["gram"]: r for r in K.log_probabilities(spark.createDataFrame(rows, schema)).collect()}
    # Documents of one half are scored by the counts of the other.
    for p, counted in (("p0", trusted), ("p1", halves[1]), ("p2", halves[0])):
        for g, want in brute_kneser_ney(counted, asked).items():
            assert abs(got[number(g)][p] - want) < 1e-9, (p, g)
    # The probabilities after a context add up to one.
    whole = [(number((20, 21, c)), n[20, 21, c], 0) for c in range(K.SYMBOLS)]
    whole += [(number(g), n[g], 0) for g in n if g[:2] != (20, 21)]
    got = {r["gram"]: r["p0"] for r in K.log_probabilities(spark.createDataFrame(whole, schema)).collect()}
    assert abs(sum(math.exp(got[number((20, 21, c))]) for c in range(K.SYMBOLS)) - 1) < 1e-9


def test_packed_log_probabilities(spark):
    rows = [(0.0, -0.5, -31.9), (-3.25, -40.0, -1e-9)]
    df = spark.createDataFrame(rows, "p0 double, p1 double, p2 double").select(K.packed(["p0", "p1", "p2"]).alias("p"))
    got = K.unpacked(np.array([r["p"] for r in df.collect()]))
    assert np.abs(got - np.maximum(np.array(rows).T, -32)).max() <= K.STEP


def test_replies_hold_what_a_block_needs(spark):
    p = spark.createDataFrame([(7, -0.5, -1.0, -2.0), (9 << 32 | 8, -3.25, -4.0, -5.0)], "gram long, p0 double, p1 double, p2 double")
    known = p.select("gram", K.packed(["p0", "p1", "p2"]).alias("p"))
    asks = spark.createDataFrame([(1, 7, 1), (1, 9 << 32 | 8, 7), (1 << 32, 7, 6)], "block long, gram long, need byte")
    got = {}
    for r in K.replies(asks, known).collect():
        grams, logp = K.opened([r["n"]], [r["body"]])
        got |= {(r["block"], g): tuple(x) for g, x in zip(grams.tolist(), logp.T.tolist())}
    assert got == {(1, 7): (-0.5, 0, 0), (1, 9 << 32 | 8): (-3.25, -4.0, -5.0), (1 << 32, 7): (0, -1.0, -2.0)}


def test_saved_tables_leave_no_shuffle_files(spark):
    """What a write has shuffled goes with it; the session's setting stays."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        every = manager.getAllFiles()
        names = [every.apply(i).getName() for i in range(every.size())]
        return {n for n in names if n.startswith("shuffle_")}

    old = files()
    got = CO.saved(spark.range(20_000).groupBy((F.col("id") % 977).alias("k")).count(), "counts")
    for _ in range(50):
        if not files() - old:
            break
        time.sleep(0.1)
    assert not files() - old
    assert got.count() == 977
    assert spark.conf.get(name, None) == before


@pytest.mark.parametrize("part", [1, 3, K.PART])
def test_asked_trigrams_whatever_the_parts(spark, monkeypatch, part):
    """Counts of a block are the same however it is worked on in parts."""
    monkeypatch.setattr(K, "PART", part)
    rnd = np.random.default_rng(3)
    bodies = [bytes([*rnd.integers(K.FIRST_WORD, K.FIRST_WORD + 3, 8), K.END]) for _ in range(40)]
    trusted, lang = [i % 3 for i in range(40)], [i % 2 for i in range(40)]
    ends = np.cumsum([len(b) for b in bodies])
    row = (7, bytes(trusted), np.array(lang, "<i4").tobytes(), ends.astype("<i4").tobytes(), b"".join(bodies))
    blocks = spark.createDataFrame([row], "block long, trusted binary, lang binary, ends binary, symbols binary")
    want = Counter()
    for body, t, i in zip(bodies, trusted, lang):
        for g in K.trigrams(np.frombuffer(body, np.uint8), np.array([len(body)]), np.array([i])).tolist():
            want[g, t] += 1
    got = {r["gram"]: (r["n1"], r["n2"], r["need"]) for r in K.asked(blocks).collect()}
    assert got == {
        g: (want[g, 1], want[g, 2], sum((want[g, m] > 0) << m for m in K.MODELS)) for g in {g for g, _ in want}
    }


def test_frequent_words_are_of_all_trusted_documents(spark):
    """Above 10,000 documents a language no document is left out: a word of
    one rare document beats a word of fewer occurrences whatever the size."""
    n = 30_000
    rows = [(i, "common") for i in range(n)] + [(n + i, f"only{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(90)]
    rows = [(i, t, "en", "s", len(t)) for i, t in rows]
    docs_ = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = K.frequent_words(docs_, spark.createDataFrame([(i,) for i, *_ in rows], "doc_id long"))
    assert found["en"] == ["common", *sorted(r[1] for r in rows[n:])]


@pytest.fixture(scope="module")
def judged(spark):
    good, bad = corpus(random.Random(3))
    labels = [(i, 1, 0) for i, _ in good[:80]] + [(i, 0, 0) for i, _ in bad] + [(good[90][0], 1, 0), (good[90][0], 0, 0), (None, 1, 0)]
    rows = [*good, *bad, (900, None), (901, ""), (902, good[0][1], "xx"), (903, good[0][1], None), (None, good[1][1]), (0, good[0][1])]
    return rows, good, bad, labels


def test_junk_is_rejected_and_prose_kept(spark, judged):
    rows, good, bad, labels = judged
    out = K.classify(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    got = defaultdict(list)
    for r in out.collect():
        got[r["doc_id"]].append(r)
    assert sum(len(x) for x in got.values()) == len(rows)
    assert not any(got[i][0]["keep"] for i, _ in bad)
    assert sum(got[i][0]["keep"] for i, _ in good) >= len(good) - 1
    assert len(got[0]) == 2 and got[0][0] == got[0][1]
    assert got[902][0]["perplexity"] is None and got[902][0]["keep"]  # no trusted text in its language
    assert got[900][0]["n_symbols"] == 1 == got[901][0]["n_symbols"]
    kept = K.keep_good(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert tuples(kept, "doc_id") == tuples(out.where("keep"), "doc_id")


def test_no_labels_no_rows_clashing_names(spark, judged):
    rows = judged[0][:5]
    none = spark.createDataFrame([], LABELS)
    assert K.classify(docs(spark, rows), none).where("keep and perplexity is null").count() == 5
    assert K.classify(docs(spark, []), none).count() == 0
    some = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert K.classify(clashing(spark, judged[1][:3]), some).count() == 3


def brute_counts(rows):
    train = Counter()
    split = {}
    for i, (doc_id, text) in enumerate(rows):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        tokens = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w] + [None]
        held = zlib.crc32((str(doc_id) if doc_id is not None else "").encode()) % 7 == 2
        split[i] = (held, tokens)
        if not held:
            train.update(tokens)
    return train, split


def test_scores(spark):
    rnd = random.Random(4)
    good, _ = corpus(rnd, 300)
    rows = [*good, (1000, None), (1001, ""), (None, "A b\x0bC"), (5, good[5][1]), (1002, "new Words né\n" * 3000)]
    out = B.score_documents(docs(spark, rows)).collect()
    train, split = brute_counts(rows)
    n, v = sum(train.values()), len(train)
    want = []
    for i, (doc_id, _) in enumerate(rows):
        held, tokens = split[i]
        base = sum(math.log10((train[t] + 1) / (n + v + 1)) for t in tokens)
        want.append((doc_id, held, len(tokens), sum(train[t] > 0 for t in tokens), n, round(base, 5)))
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert len(held) > 20 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in out)
    twice = [r["score"] for r in out if r["doc_id"] == 5]
    assert len(twice) == 2 and abs(twice[0] - twice[1]) < 1e-6


def test_scores_edge_cases(spark):
    assert B.score_documents(docs(spark, [])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    alone = B.score_documents(docs(spark, [(held, "a b")])).first()  # nothing to learn from
    assert alone["train_tokens"] == 0 and alone["n_known"] == 0 and abs(alone["base_score"]) < 1e-12
    assert B.score_documents(clashing(spark, [(1, "a b"), (2, "a")])).count() == 2


def test_model_is_normalised():
    rng = np.random.default_rng(1)
    unigram = rng.random(B.OUTPUTS)
    model = B.Model(unigram / unigram.sum())
    context = rng.integers(0, B.OUTPUTS + 1, (5, B.CONTEXT))
    for row in context:
        every = model.log_probabilities(np.repeat(row[None], B.OUTPUTS, 0), np.arange(B.OUTPUTS))
        assert abs(np.exp(every).sum() - 1) < 1e-4
    flat = model.flat()
    other = B.Model(unigram / unigram.sum(), seed=9)
    other.fill(flat)
    assert np.allclose(other.log_probabilities(context, np.arange(5)), model.log_probabilities(context, np.arange(5)))


def test_training_learns_what_follows():
    """Each word is followed by the next one, in a ring: the model must find
    that, far from the unigram's uncertainty."""
    unigram = np.full(B.OUTPUTS, 1e-9)
    unigram[:50] = 1
    unigram /= unigram.sum()
    rng = np.random.default_rng(2)
    first = rng.integers(0, 50, 40_000)
    target = ((first + 1) % 50).astype(np.int16)
    context = np.full((len(target), B.CONTEXT), B.START, np.int16)
    context[:, 0] = first
    model, state = B.Model(unigram), {}
    before = model.log_probabilities(context, target).mean()
    for round_ in range(6):
        model.train(context, target, [round_], state, B.RATE)
    after = model.log_probabilities(context, target).mean()
    assert before < -3.5 and after > -1.0


def test_sums_by_number():
    rng = np.random.default_rng(3)
    at, rows = rng.integers(0, 7, 50), rng.random((50, 3)).astype(np.float32)
    want = np.zeros((9, 3), np.float32)
    np.add.at(want, at, rows)
    numbers, sums = B._sums(at, rows)
    assert numbers.tolist() == sorted(set(at.tolist())) and np.allclose(sums, want[numbers], atol=1e-5)


def test_every_language_with_trusted_text_has_a_model(spark, monkeypatch):
    """However small its share of the trusted documents, however many
    languages there are, and also without spaced words."""
    monkeypatch.setattr(K, "SAMPLE_DOCS", 20)
    good, _ = corpus(random.Random(6))
    rows = [(i, text, "en") for i, text in good] + [(1000 + i, "wie der Hund und die Katze .", "de") for i in range(3)]
    rows += [(2000 + i, "我们今天去学校，明天休息。" * (i + 1), "zh") for i in range(3)]
    rows += [(3000 + i, f"some words in language {i}", f"x{i}") for i in range(300)]
    labels = [(i, 1, 0) for i, *_ in rows]
    rows.append((5000, "no trusted text", "none"))
    out = {r["doc_id"]: r["perplexity"] for r in K.classify(docs(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    assert [i for i, p in out.items() if p is None] == [5000]
    words = K.frequent_words(docs(spark, rows), spark.createDataFrame([(i,) for i, *_ in labels], "doc_id long"))
    assert "hund" in words["de"] and words["zh"] == [] and len(words) == 303


def test_a_hundred_words_of_a_language_stand_for_themselves():
    s = K.Symbols([f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100)])
    found = s.of(" ".join(s.frequent))
    assert len(set(found)) == 101 and max(found) < K.SYMBOLS <= 256


def test_training_does_not_depend_on_size(spark, monkeypatch):
    """As many rounds over a large table as over a small one."""
    monkeypatch.setattr(B, "ROUNDS", 3)
    rounds = []
    monkeypatch.setattr(B.Model, "fill", lambda self, flat: rounds.append(len(flat)))
    blocks = B.token_blocks(docs(spark, [(0, "a b c"), (1, "b c d")]))
    reader, unigram = B.Reader(np.array([B._END], np.uint64)), np.full(B.OUTPUTS, 1 / B.OUTPUTS)
    for total in (8, 10**12):
        B.fit(blocks, reader, unigram, total)
    assert len(rounds) == 6 and B.OUTPUTS == 512
