"""Classes of near-duplicate documents from band keys and a pairwise test.

Equal texts, told by 128 bits of hashes, are one node from the start.  Texts
that share a band key form a bucket.  Each text is tested against the leader of
its buckets, first the least of them, then those it is in no class with yet;
links that hold join classes, and only joined classes go on.

A text is tested against the leaders of most of its buckets, at most
``LEADERS`` of them after the least; others are left to the comparison of the
bucket, which misses nothing.

A bucket then may hold texts apart, in another class than its leader's.  Where
they are at most ``APART``, each is compared with all other texts of the
bucket, also those that passed, unless both are in one class already; so it is
in larger buckets, or in all others as one, while a kind's comparisons are at
most ``SPARE`` times ``APART`` for every text.  Where they are more - texts with a common passage and little else in common -
their texts are dealt anew by rare tokens: near texts have so many tokens in
common that one is among the rarest of both (``rare_of`` tells how many that
takes), so no near pair is lost, while a passage that many share is not rare.
Rarity is told by counts of slots that tokens are hashed to, tables of fixed
size; a text gives its rarest tokens only.  A token that texts of one class hold,
and no others, names no pair that is still to be compared: such tokens are the
rarest of all, and are not given; nor are tokens that only texts of one class
have among their rarest.
Where a passage is so large a part of the texts that its tokens are among these,
buckets of tokens have many texts apart too; then the next kind of tokens deals
the texts of those buckets anew, with leaders from the texts apart.  Near texts
that meet in such a bucket meet again under a token of any kind.  Buckets of the
last kind are compared whole, however many texts are apart, or all their texts
as one bucket if that is fewer pairs.  So a bucket costs its size times
``APART``, and one of the last kind its size times its texts apart.

Comparisons are made in groups of bounded size (a bucket of over two blocks is
cut into blocks, and every two blocks with a text apart make a group), which
give back only links that join something.  Two texts are compared in the first
of the buckets that they share, not in every one.

Tables live in the shared folder.  Counting a bucket aggregates partially;
joins on a key that many texts share are between plain tables, so adaptive
execution splits them.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words
from .common import KEY, documents, key_doc_id, order_key, saved, ship, small, text_hashes
from .components import components


#: Texts in a block of a bucket; a group has at most two blocks or so.
BLOCK_TEXTS = 250
#: Texts apart from their leader that are compared with their whole bucket.
APART = 32
#: Buckets with more are compared whole too, the smallest first, as long as a
#: kind's comparisons are at most SPARE times APART for every text; the others'
#: texts are compared as one bucket if that is as few.
SPARE = 4
#: Leaders a text is tested against, after the least one.
LEADERS = 3
#: Slots of each of the two tables in which tokens are counted, 8 MB in all,
#: and slots of a row of counts.
SLOTS = 1 << 20
PART_SLOTS = 1 << 13


def slots(tokens: np.ndarray) -> np.ndarray:
    """The slots of the tokens, a row for each of the two tables."""
    mixed = words.mix(tokens)
    own = [(mixed >> np.uint64(k)).astype(np.int64) & (SLOTS - 1) for k in (44, 24)]
    return np.stack([own[0], own[1] + SLOTS])


def sketches(docs: DataFrame, bands_of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(key, doc_id, one, two, bands): one and two are hashes of the text;
    ``bands_of`` gives the uint64 band keys of a document's word hashes."""

    def find(batches):
        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            bands = []
            for a, b in words.parts(offsets):
                hashes, count = words.word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ends = np.cumsum(count)
                bands += [bands_of(hashes[e - n : e]) for e, n in zip(ends.tolist(), count.tolist())]
            sizes = np.array([0, *map(len, bands)], np.int32)
            flat = np.concatenate(bands) if bands else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("doc_id"),
                    batch.column("one"),
                    batch.column("two"),
                    pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(flat.view(np.int64))),
                ],
                ["key", "doc_id", "one", "two", "bands"],
            )

    rows = docs.select(order_key().alias("key"), "doc_id", *text_hashes(), "text")
    return rows.mapInArrow(find, f"key {KEY}, doc_id long, one long, two long, bands array<long>")


def word_table(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(node, words): 32-bit word hashes of the documents in ``keys`` (key,
    node)."""

    def find(batches):
        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            blobs = []
            for a, b in words.parts(offsets):
                hashes, count = words.word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                short = (hashes >> np.uint64(32)).astype("<u4")
                ends = np.cumsum(count)
                blobs += [short[e - n : e].tobytes() for e, n in zip(ends.tolist(), count.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(blobs, pa.binary())], ["node", "words"])

    rows = docs.select(order_key().alias("key"), "text").join(small(keys), "key")
    # Rows that are stated many times have one key: one of them will do.
    return rows.select("node", "text").mapInArrow(find, "node long, words binary").dropDuplicates(["node"])


def tested(pairs: DataFrame, texts: DataFrame, near: Callable[[np.ndarray, np.ndarray], bool]) -> DataFrame:
    """Adds ``near`` to pairs (a, b) by their words."""

    def test(batches):
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            found = [
                near(np.frombuffer(x.as_buffer(), "<u4"), np.frombuffer(y.as_buffer(), "<u4"))
                for x, y in zip(left, right)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(found, pa.bool_())], ["a", "b", "near"]
            )

    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("words").alias("left")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("words").alias("right")), "b"
    )
    return both.select("a", "b", "left", "right").mapInArrow(test, "a long, b long, near boolean")


def sizes_of(rest: DataFrame) -> DataFrame:
    """(band, n, far, mark0, mark1) of the buckets with texts apart: texts,
    texts apart and marks of which they are."""
    marks = [F.bit_xor(F.xxhash64("node", "apart", F.lit(i))).alias(f"mark{i}") for i in (0, 1)]
    return rest.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.count_if("apart").alias("far"), *marks).where("far > 0")


def most_apart(sizes: DataFrame, texts: int) -> int:
    """Texts apart of the largest buckets of ``sizes`` to be compared whole:
    ``APART``, or as many as leave all comparisons in proportion to ``texts``,
    which costs less than dealing their texts anew."""
    once = sizes.where("n > 1").dropDuplicates(["n", "far", "mark0", "mark1"])
    work = once.groupBy(F.ceil(F.log2("far")).cast("int").alias("power")).agg(F.sum(F.col("n") * F.col("far")).alias("work"))
    most, total = APART, 0
    for power, more in sorted(work.collect()):
        total += more
        if total > SPARE * APART * texts:
            break
        most = max(most, 2**power)
    return most


def one_bucket(held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rest`` and ``sizes`` of one bucket of all texts of ``held`` (node,
    label)."""
    held = saved(held.select("node", F.lit(0).cast("long").alias("band"), "label", F.lit(True).alias("apart")), "rest")
    return held, saved(sizes_of(held), "apart")


def fewest(rest: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rest`` and ``sizes`` as they are, or all texts in one bucket if the
    buckets name more pairs than these texts have."""
    held = rest.join(sizes.select("band"), "band").select("node", "label").distinct()
    n = held.count()
    if not n or sizes.agg(F.sum(F.col("n") * F.col("far"))).first()[0] < n * (n - 1) // 2:
        return rest, sizes
    return one_bucket(held)


def shared_before(bands: pa.ListArray, band: int) -> Callable[[int], np.ndarray]:
    """A function of a text's place that gives the places of those it shares a
    bucket before ``band`` with; ``bands`` are the buckets of each."""
    size = np.diff(bands.offsets.to_numpy())
    flat, owner = bands.flatten().to_numpy(), np.repeat(np.arange(len(size)), size)
    flat, owner = flat[flat < band], owner[flat < band]
    ends = np.searchsorted(owner, np.arange(len(size) + 1))
    order = np.argsort(flat, kind="stable")
    holders, ranked = owner[order], flat[order]
    first, last = np.searchsorted(ranked, flat, "left"), np.searchsorted(ranked, flat, "right")

    def of(x: int) -> np.ndarray:
        a, n = first[ends[x] : ends[x + 1]], (last - first)[ends[x] : ends[x + 1]]
        return holders[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]

    return of


def linked(rest: DataFrame, sizes: DataFrame, texts: DataFrame, near_many: Callable) -> DataFrame:
    """Links (a, b) within the buckets of ``sizes`` (by ``sizes_of``) of
    ``rest`` (node, band, label, apart), enough to join whatever is near;
    ``label`` is the class so far.  ``near_many(texts)`` is a test of one of the texts against some before it,
    by their places."""
    apart = F.col("apart")
    # Buckets of the same texts are compared once.
    count = sizes.where("n > 1").groupBy("n", "far", "mark0", "mark1").agg(F.min("band").alias("band"))
    # A bucket that fits into one group is one block of texts apart: those that
    # passed have one label and are not compared with each other.
    whole = F.col("n") <= 2 * BLOCK_TEXTS
    blocks = [
        F.when(whole, F.lit(one)).otherwise(F.ceil(x / BLOCK_TEXTS)).cast("int")
        for one, x in ((1, F.col("far")), (0, F.col("n") - F.col("far")))
    ]
    count = saved(count.select("band", blocks[0].alias("far"), blocks[1].alias("passed")), "buckets")
    # Blocks of texts apart from their leader come first; the others' blocks
    # are paired with those only.
    place = F.xxhash64("node")
    passed = F.col("far") + F.pmod(place, F.greatest("passed", F.lit(1)))
    mine = F.when(F.col("far") + F.col("passed") == 1, F.lit(0)).when(apart, F.pmod(place, F.col("far"))).otherwise(passed)
    split = saved(rest.join(count, "band").withColumn("mine", mine.cast("int")), "compared")
    bands = split.groupBy("node").agg(F.collect_list("band").alias("bands"))
    last = F.when(apart, F.col("far") + F.col("passed")).otherwise(F.col("far")) - 1
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    split = split.select(
        "band", "node", "label", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")
    )

    def compare(group):
        nodes, mine = group["node"].to_pylist(), group["mine"].to_numpy()
        words_ = [np.frombuffer(w.as_buffer(), "<u4") for w in group["words"]]
        one = group["i"][0].as_py() == group["j"][0].as_py()
        test, out = near_many(words_), []
        before = shared_before(group["bands"].combine_chunks(), group["band"][0].as_py())
        here = np.ones(len(nodes), bool)
        label = np.unique(group["label"].to_numpy(), return_inverse=True)[1]
        for x in range(1, len(nodes)):
            ys = np.arange(x) if one else np.flatnonzero(mine[:x] != mine[x])
            here[elsewhere := before(x)] = False
            ys = ys[(label[ys] != label[x]) & here[ys]]
            here[elsewhere] = True
            for y in ys[test(x, ys)].tolist() if len(ys) else ():
                if label[x] != label[y]:
                    label[label == label[x]] = label[y]
                    out.append((nodes[x], nodes[y]))
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return (
        split.join(texts.join(bands, "node"), "node")
        .select("band", "i", "j", "mine", "node", "label", "words", "bands")
        .groupBy("band", "i", "j")
        .applyInArrow(compare, "a long, b long")
    )


def token_counts(hot: DataFrame, tokens_of: Callable[[np.ndarray], np.ndarray], one_label: bool = True) -> np.ndarray:
    """How many tokens of ``hot`` (node, label, words) fall into each slot of
    the tables, with ``one_label`` 0 where all are of texts of one label.  A
    task gives back one row a part of the slots."""

    def add_to(total, first, mixed, at, n, label, more):
        new = at[total[at] == 0]
        first[new] = label if np.isscalar(label) else label[total[at] == 0]
        mixed[at] |= (first[at] != label) | more
        total[at] += n

    def count(batches):
        total, first, mixed = (np.zeros(2 * SLOTS, kind) for kind in (np.int64, np.int64, bool))
        for batch in batches:
            for label, blob in zip(batch.column("label").to_pylist(), batch.column("words")):
                slot, n = np.unique(slots(tokens_of(np.frombuffer(blob.as_buffer(), "<u4"))), return_counts=True)
                add_to(total, first, mixed, slot, n, label, False)
        some = np.flatnonzero(total.reshape(-1, PART_SLOTS).any(1))
        at = [p * PART_SLOTS + np.flatnonzero(total[p * PART_SLOTS : (p + 1) * PART_SLOTS]) for p in some]
        columns = [[(x % PART_SLOTS).astype("<u2").tobytes() for x in at]]
        columns += [[c[x].astype(kind).tobytes() for x in at] for c, kind in ((total, "<i8"), (first, "<i8"), (mixed, "?"))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), *(pa.array(c, pa.binary()) for c in columns)],
            ["part", "slots", "counts", "labels", "mixed"],
        )

    def add(group):
        total, first, mixed = (np.zeros(PART_SLOTS, kind) for kind in (np.int64, np.int64, bool))
        for row in zip(*(group[c] for c in ("slots", "counts", "labels", "mixed"))):
            at, n, label, more = (np.frombuffer(x.as_buffer(), kind) for x, kind in zip(row, ("<u2", "<i8", "<i8", "?")))
            add_to(total, first, mixed, at, n, label, more)
        total[~mixed if one_label else total < 0] = 0
        counts = np.minimum(total, 2**32 - 1).astype("<u4").tobytes()
        return pa.table({"part": group["part"][:1], "counts": pa.array([counts], pa.binary())})

    schema = "part int, slots binary, counts binary, labels binary, mixed binary"
    found = hot.select("label", "words").mapInArrow(count, schema)
    out = np.zeros((2 * SLOTS // PART_SLOTS, PART_SLOTS), np.uint32)
    for part, counts in found.groupBy("part").applyInArrow(add, "part int, counts binary").collect():
        out[part] = np.frombuffer(counts, "<u4")
    return out.reshape(-1)


def by_rare_tokens(nodes: DataFrame, texts: DataFrame, rare_of: Callable) -> DataFrame:
    """(node, band): the rarest tokens of each of ``nodes`` (node), as many
    as ``rare_of(words)`` - (tokens, number) - says.  Tokens are different
    numbers; rare are those with a slot that few of the nodes' tokens fall
    into.  That is one order of all tokens for every text, so that near texts
    have one in common whatever falls into one slot.

    If ``nodes`` has the texts' classes as ``label``, tokens of texts of one
    class are the rarest, and a token is given only if texts of two classes
    have it, and have it among their rarest: near texts of two classes do."""
    told = "label" in nodes.columns
    nodes = nodes if told else nodes.withColumn("label", F.col("node"))
    hot = saved(texts.join(nodes, "node").select("node", "label", "words"), "hot")
    counts = token_counts(hot, lambda w: rare_of(w)[0], told)

    def rarest(w):
        tokens, number = rare_of(w)
        rarity = counts[slots(tokens)].min(0)
        at = np.lexsort((tokens, rarity))[:number]
        return tokens[at[rarity[at] > 0]]

    given = token_counts(hot, rarest) if told else None

    def find(batches):
        for batch in batches:
            found = []
            for blob in batch.column("words"):
                tokens = rarest(np.frombuffer(blob.as_buffer(), "<u4"))
                found.append(tokens if given is None else tokens[given[slots(tokens)].min(0) > 0])
            size = [len(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("node").to_numpy(), size)),
                    pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)),
                ],
                ["node", "band"],
            )

    return hot.select("node", "words").mapInArrow(find, "node long, band long")


class Labels:
    """Classes so far: a table (id, label); texts that are not in it are
    classes of their own."""

    def __init__(self):
        self.table = None

    def of(self, rows: DataFrame, node: str, name: str) -> DataFrame:
        """``rows`` with the label of ``node`` as ``name``."""
        if self.table is None:
            return rows.withColumn(name, F.col(node))
        mine = self.table.select(F.col("id").alias(node), F.col("label").alias(name))
        return rows.join(mine, node, "left").withColumn(name, F.coalesce(name, node))

    def join(self, links: DataFrame) -> None:
        """Join the classes of ``links`` (a, b)."""
        edges = self.of(self.of(links, "a", "x"), "b", "y").where("x <> y")
        # Many links between the texts of two classes are one between these.
        edges = edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = saved(edges, "joins")
        if not edges.limit(1).count():
            return
        joined = components(edges)
        if self.table is None:
            self.table = joined
            return
        to = joined.select(F.col("id").alias("label"), F.col("label").alias("to"))
        old = self.table.join(to, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
        # Texts that were classes of their own till now.
        new = joined.join(self.table.select("id"), "id", "left_anti")
        self.table = saved(old.unionByName(new), "labels")


def near_classes(
    docs: DataFrame,
    bands_of: Callable[[np.ndarray], np.ndarray],
    near: Callable[[np.ndarray, np.ndarray], bool],
    near_many: Callable,
    *rare_of: Callable[[np.ndarray], tuple[np.ndarray, int]],
) -> DataFrame:
    """One row per row of ``docs``: key, doc_id, class_id (doc_id of the
    class's first document), class_size (rows), kept (it is that document).
    ``rare_of`` are the kinds of tokens, in the order of their use."""
    docs = documents(docs, "doc_id", "text")
    ship(docs.sparkSession)
    rows = saved(sketches(docs, bands_of), "sketches")
    # The first of a node has the least key; its doc_id comes with it.
    nodes = rows.groupBy("one", "two").agg(
        F.min("key").alias("key"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands")
    )
    nodes = saved(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = nodes.select("node", F.explode("bands").alias("band"))
    leaders = members.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n"))
    leaders = saved(leaders.where("n > 1").select("band", "leader"), "leaders")
    led = saved(members.join(leaders, "band"), "led")
    heads = led.select("node").distinct()
    heads = saved(nodes.join(heads, "node", "left_semi").select("node", "key"), "ends")
    texts = saved(word_table(docs, heads), "words")
    labels, known, n_texts = Labels(), None, nodes.count()

    def test(pairs: DataFrame) -> DataFrame:
        nonlocal known
        pairs = saved(pairs, "pairs")
        if known is not None:
            pairs = pairs.join(known, ["a", "b"], "left_anti")
        found = saved(tested(pairs, texts, near), "tested")
        known = found.select("a", "b") if known is None else known.unionByName(found.select("a", "b"))
        labels.join(found.where("near").select("a", "b"))

    for rare in (*rare_of, None):
        led = led.where("node <> leader")
        test(led.groupBy(F.col("node").alias("a")).agg(F.min("leader").alias("b")))
        some = labels.of(labels.of(led, "node", "label"), "leader", "led_by").where("label <> led_by")
        # The leaders of most buckets; who is near another is a text apart, for
        # the comparison of the bucket.
        order = Window.partitionBy("node").orderBy(F.desc("n"), "leader")
        some = some.groupBy("node", "leader").agg(F.count(F.lit(1)).alias("n"))
        some = some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= LEADERS)
        test(some.select(F.col("node").alias("a"), F.col("leader").alias("b")))
        # Texts apart, and their buckets, the leader among them.
        every = led.select("node", "band", "leader").unionByName(
            led.select(F.col("leader").alias("node"), "band", "leader").distinct()
        )
        some = labels.of(labels.of(every, "node", "label"), "leader", "led_by")
        apart = F.col("label") != F.col("led_by")
        some = saved(some.select("node", "band", "label", apart.alias("apart")), "rest")
        sizes = saved(sizes_of(some), "apart")
        if rare is None:
            some, sizes = fewest(some, sizes)
        most = most_apart(sizes, n_texts) if rare else None
        links = linked(some, sizes.where(F.col("far") <= most) if rare else sizes, texts, near_many)
        labels.join(saved(links, "links"))
        if rare is None:
            break
        large = sizes.where(F.col("far") > most).select("band")
        if not large.limit(1).count():
            break
        hot = labels.of(some.join(large, "band").select("node", "band", "apart"), "node", "label")
        held = saved(hot.select("node", "label").distinct(), "held")
        n = held.count()
        if n * (n - 1) // 2 <= SPARE * APART * n_texts:
            labels.join(saved(linked(*one_bucket(held), texts, near_many), "links"))
            break
        deep = by_rare_tokens(held, texts, rare)
        # One row a text and key; leaders are texts apart, where there are any.
        deep = saved(deep, "deeper")
        away = hot.where("apart").select("node").distinct().withColumn("away", F.lit(1))
        first = deep.join(away, "node", "left").groupBy("band").agg(
            F.coalesce(F.min(F.when(F.col("away") == 1, F.col("node"))), F.min("node")).alias("leader"),
            F.count(F.lit(1)).alias("n"),
        )
        led = saved(deep.join(first.where("n > 1").drop("n"), "band"), "led")

    known = labels.of(nodes.select("node", "one", "two", "key", "n"), "node", "label")
    known = saved(known, "labelled")
    firsts = saved(known.groupBy("label").agg(F.min("key").alias("first"), F.sum("n").alias("class_size")), "classes")
    known = saved(known.select("one", "two", "label").join(firsts, "label"), "known")
    found = rows.select("key", "doc_id", "one", "two").join(known, ["one", "two"])
    # The doc_id of a class is in its first row; the key holds it.
    return found.select(
        "key",
        "doc_id",
        key_doc_id("first").alias("class_id"),
        "class_size",
        (F.col("key") == F.col("first")).alias("kept"),
    )
