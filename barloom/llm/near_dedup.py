"""Near-duplicate classes by ProbMinHash signatures, banding and verification.

Shingles are runs of five words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased), weighted by how often they occur in
the document. Every shingle is a Poisson process whose rate is its weight: its arrivals come at
exponential distances drawn from the shingle's hash, and each falls on one of the signature's components. A component
keeps the shingle of its earliest arrival; a shingle is given up once its next arrival is later than the
latest kept by any component. Two signatures agree in a component with the probability Jaccard similarity J_P of
the documents. A text in which a shingle repeats has a second signature with all weights 1, which agrees with
the Jaccard similarity of the shingle sets; without repeats the two are the same. Signatures are cut into ``BANDS`` bands of ``ROWS``
components, and the bands of both signatures share their keys (at 0.8 in either similarity a pair shares no band with a probability
below 4e-5).

Equal texts are one node, found by their SHA-256. In a bucket (documents that share a band) every member is compared
with the bucket's leader, the member whose buckets are fullest (of a group of near copies that is one close to
their common origin), of several the one with the largest doc_id; then, in buckets of two successive bands, with that one's
leader; then, while a bucket's last leader joined an eighth of the members that were in no earlier leader's class, a new
leader is chosen among the rest of them, and compared with all members of other classes. So a bucket of n members makes
n log n pairs at most. That joins most of a hot group. At last, members of buckets that hold several classes are compared with the members of other classes with which
they have one of their rarest shingles in common, early enough that what follows can still make a link (prefix and position
filter, see ``_pairs_left``; no pair at the threshold is without). So every pair that shares a bucket is compared, joined already,
or proven to be no link, and texts that are alike below the threshold by a common template do not meet. Compared pairs are verified on the whole texts: a link needs a similarity of at least
``THRESHOLD``, the larger of the set Jaccard and the probability Jaccard of the shingles. Classes are the connected
components of links, found by joining each class with its smallest neighbour; links inside a class are dropped after every round, and
later links are laid between the classes that there are.

Leaders are combined before the shuffle and meet members in plain joins that adaptive execution can split. Texts are
moved once to the nodes that have a partner; only those go on. Every pass is staged.

Defined cases: null counts as empty. A text of one to four words is one shingle; a text without words is linked to
equal texts alone. Rows that repeat are members of one class. A null doc_id is smaller than any other; a class whose ids
are all null has a null class_id. An empty table gives no rows. Extra columns are carried in one struct.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import give_back, only_model, stage, text_or_empty

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 26, 5
LEAST_JOINED = 8  # a leader that joins less than an eighth of its bucket's open members is the last one
CACHED_WORDS = 200_000
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _task_hashes() -> WordHashes:
    """A table of word hashes for one task; models of earlier stages make room."""
    only_model("near_dedup", lambda: None)
    return WordHashes()


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


def shingles(texts: list[str], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts with the text's number and the weight, sorted by text and hash."""
    words, owners = [], []
    for i, text in enumerate(texts):
        own = text.encode("utf-8", "surrogatepass").lower().split()
        if own:
            own += [b""] * (WORDS - len(own))
            words.append(np.fromiter(map(hashes.__getitem__, own), np.uint64, len(own)))
            owners.append((i, len(own)))
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    flat = np.concatenate(words)
    owner = np.repeat([i for i, _ in owners], [n for _, n in owners])
    size = len(flat) - WORDS + 1
    with np.errstate(over="ignore"):
        value = flat[:size]
        for j in range(1, WORDS):
            value = value * _P + flat[j:size + j]
        value = _mix(value)
    inside = owner[:size] == owner[WORDS - 1:]
    owner, value = owner[:size][inside], value[inside]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], value[at], np.diff(np.append(at, len(value)))


def signatures(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int, size: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash signatures (n x size): the shingle of the earliest arrival in every component."""
    earliest = np.full(n * size, np.inf)
    kept = np.zeros(n * size, np.uint64)
    time, turn = np.zeros(len(value)), 0
    with np.errstate(over="ignore"):
        while len(value):
            turn += 1
            draw = _mix(value + np.uint64(turn) * _P)
            time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / weight
            component = (_mix(draw ^ _Q) % np.uint64(size)).astype(np.int64)
            slot = owner * size + component
            better = np.flatnonzero(time < earliest[slot])
            better = better[np.argsort(-time[better], kind="stable")]  # the earliest is written last
            earliest[slot[better]] = time[better]
            kept[slot[better]] = value[better]
            latest = earliest.reshape(n, size).max(1)
            going = time < latest[owner]
            owner, value, weight, time = owner[going], value[going], weight[going], time[going]
    return kept.reshape(n, size)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
        for j in range(ROWS):
            key = _mix(key * _P + parts[:, :, j])
    return key.view(np.int64)


def key_lists(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int) -> list[list[int] | None]:
    """Band keys of n texts: those of the weighted shingles, then, where a shingle repeats, those of the shingle set."""
    lists = [None if w else k for w, k in zip(np.bincount(owner, minlength=n) == 0, band_keys(signatures(owner, value, weight, n)).tolist())]
    uneven = np.unique(owner[weight > 1])  # without repeats both signatures are the same
    if len(uneven):
        of = np.isin(owner, uneven)
        once = np.ones(np.count_nonzero(of), np.int64)
        for i, keys in zip(uneven.tolist(), band_keys(signatures(np.searchsorted(uneven, owner[of]), value[of], once, len(uneven))).tolist()):
            lists[i] = lists[i] + keys
    return lists


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of the set Jaccard and the probability Jaccard of two weighted shingle sets."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    plain = len(both) / (len(a[0]) + len(b[0]) - len(both))
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    # for a common shingle i: sum over j of max(x_j / x_i, y_j / y_i); shingles of a alone have the largest ratio
    above = np.searchsorted(ratio, ratio, "right")
    x_above = a[1].sum() - np.concatenate([[0.0], np.cumsum(x)])[above]
    y_below = b[1].sum() - y.sum() + np.concatenate([[0.0], np.cumsum(y)])[above]
    return max(plain, float((1 / (x_above / x + y_below / y)).sum()))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _task_hashes()
    for batch in batches:
        part, start, size = [], 0, 0
        for end, text in enumerate(batch.column("text"), 1):
            part.append(text.as_py())
            size += len(part[-1])
            if size < 1_000_000 and end < len(batch):
                continue
            owner, value, weight = shingles(part, hashes)
            lists = key_lists(owner, value, weight, len(part))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(start, end - start) for c in ("doc_id", "digest")), pa.array(lists, pa.list_(pa.int64()))],
                ["doc_id", "digest", "keys"],
            )
            part, start, size = [], end, 0
    give_back()


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, recent = _task_hashes(), (None, None)

    def weighted(text: str):
        _, value, weight = shingles([text], hashes)
        return value, weight

    for batch in batches:
        links = []
        for a, b, text_a, text_b in zip(*(batch.column(c) for c in ("a", "b", "text_a", "text_b"))):  # one row at a time: texts repeat
            a, b = a.as_py(), b.as_py()
            if recent[0] != b:  # rows of one leader follow each other
                recent = b, weighted(text_b.as_py())
            if similarity(weighted(text_a.as_py()), recent[1]) >= THRESHOLD:
                links.append((a, b))
        a, b = zip(*links) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    give_back()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    first = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return stage(both.select("a", "b", "text_a", "text_b").mapInArrow(_compared, "a long, b long"), "near-links")


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between different classes, one for two classes, from the larger label to the smaller."""
    ends = _labelled(_labelled(links, labels, "a", "label_a"), labels, "b", "label_b").where("label_a != label_b")
    return stage(ends.select(F.greatest("label_a", "label_b").alias("a"), F.least("label_a", "label_b").alias("b")).distinct(), "near-edges")


def components(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Node and label (the smallest node of its class) after ``links`` joined classes; a node without a row is its own label.

    Every round joins each class with its smallest neighbour, follows those steps to their end and goes on with the links that
    are left between classes: of all links once, then of those left. Two rounds at least halve the classes that have links.
    """
    links = _between(links, labels)
    while not links.isEmpty():
        smaller = stage(links.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "node"), "near-smaller")
        while True:
            further = smaller.select(F.col("node").alias("label"), F.col("label").alias("next"))
            if smaller.join(further, "label", "left_semi").isEmpty():
                break
            smaller = stage(smaller.join(further, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "near-jump")
        moved = smaller.select(F.col("node").alias("label"), F.col("label").alias("next"))
        before = labels.join(moved, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
        labels = stage(before.unionByName(smaller), "near-labels")
        links = _between(links, smaller)
    return labels


def _leaders(members: DataFrame, key: str = "key") -> DataFrame:
    top = members.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("weight", "doc_id", "node")).alias("top"))
    return top.where("n > 1").select(key, F.col("top.node").alias("leader"))


def _labelled(rows: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    known = labels.select(F.col("node").alias(node), F.col("label").alias(label))
    return rows.join(known, node, "left").withColumn(label, F.coalesce(label, node))


def near_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, digest), nodes (digest, node, doc_id) and labels (node, label) of all documents."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    signed = stage(rows.mapInArrow(_keyed, "doc_id long, digest binary, keys array<long>"), "near-keys")
    nodes = stage(
        signed.groupBy("digest").agg(F.max("doc_id").alias("doc_id"), F.first("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()), "near-nodes",
    )
    buckets = nodes.select("node", F.explode(F.array_distinct("keys")).alias("key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    weights = buckets.join(shared, "key").groupBy("node").agg(F.sum("n").alias("weight"))
    wanted = stage(nodes.join(weights, "node").select("node", "doc_id", "digest", "keys", "weight"), "near-wanted")
    buckets = wanted.select("node", "doc_id", "weight", F.explode(F.array_distinct("keys")).alias("key"))
    members = stage(buckets.join(_leaders(buckets), "key"), "near-members")
    pairs = stage(members.where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct(), "near-pairs")
    texts = stage(
        rows.join(wanted.select("node", F.coalesce("doc_id", F.lit(0)).alias("at"), "digest"),
                  (rows.digest == wanted.digest) & (F.coalesce(rows.doc_id, F.lit(0)) == F.col("at"))).select("node", "text"),
        "near-texts",
    )
    alone = wanted.select("node", F.col("node").alias("label")).limit(0)
    labels = components(_verified(pairs, texts), alone)

    # a second leader for each bucket of two successive bands of one signature
    following = lambda i: i - i % BANDS + (i + 1) % BANDS
    succession = F.transform(F.sequence(F.lit(0), F.size("keys") - 1), lambda i: F.xxhash64(F.get("keys", i), F.get("keys", following(i).cast("int"))))
    finer = wanted.select("node", "doc_id", "weight", F.explode(F.array_distinct(succession)).alias("key"))
    second = finer.join(_leaders(finer), "key").where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    labels, compared = _extended(second, labels, pairs, texts)

    # a bucket has a next leader if its last one joined a share of the members that were in no earlier leader's class
    led, going = members.select("key", "leader").distinct(), members.select("key", "node", "doc_id", "weight")
    before = members.groupBy("key").agg(F.count(F.lit(1)).alias("before"))
    while True:
        now = stage(_labelled(going, labels, "node", "label"), "near-open")
        led_labels = _labelled(led.select("key", F.col("leader").alias("node")), labels, "node", "label").select("key", "label").distinct()
        left = now.join(led_labels, ["key", "label"], "left_anti")
        chosen = stage(
            left.groupBy("key").agg(F.count(F.lit(1)).alias("left"), F.max(F.struct("weight", "doc_id", "node", "label")).alias("top"))
            .join(before, "key").where((F.col("before") - F.col("left") - 1) * LEAST_JOINED >= F.col("before"))
            .select("key", "left", F.col("top.node").alias("leader"), F.col("top.label").alias("leader_label")), "near-leaders",
        )
        more = now.join(chosen, "key").where("label != leader_label").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
        known = labels
        labels, compared = _extended(more, labels, compared, texts)
        if labels is known:
            break
        led, before = led.union(chosen.select("key", "leader")), chosen.select("key", F.col("left").alias("before"))
        going = now.drop("label").join(before.select("key"), "key", "left_semi")
    labels, _ = _extended(_pairs_left(members.select("key", "node"), labels, texts), labels, compared, texts)
    return signed.select("doc_id", "digest"), nodes.select("digest", "node", "doc_id"), labels


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _task_hashes()
    for batch in batches:
        for node, label, text in zip(*(batch.column(c) for c in ("node", "label", "text"))):
            node, label = node.as_py(), label.as_py()
            _, value, weight = shingles([text.as_py()], hashes)
            n = len(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, node)), pa.array(np.full(n, label)), pa.array(value.view(np.int64)), pa.array(weight),
                 pa.array(np.full(n, n)), pa.array(np.full(n, weight.sum()))],
                ["node", "label", "shingle", "weight", "size", "mass"],
            )
    give_back()


# A pair is a link only if 1/a + 1/b <= MOST_INVERSE, a and b being the shares of either text that both have in common: of
# the sets this is what the Jaccard similarity says, of the masses it follows from J_P <= 1 / (1/a + 1/b - 1).
MOST_INVERSE = 1 + 1 / THRESHOLD + 1e-9
LONG, SHORT = 1 / (MOST_INVERSE - 1), 2 / MOST_INVERSE  # least share of either text, least share of the one that has more in common


def _may_link(a: str, b: str) -> Column:
    """Whether what is left of two texts from their first common shingle on suffices for a link.

    They have at most ``common`` shingles in common, the smaller of what is left of the two; of the masses left, those shingles hold
    at most ``common`` and all repeats (``over``).
    """
    of = lambda name, side: F.col(f"{name}_{side}")
    common = F.least(of("rest", a), of("rest", b))
    in_set = lambda side: F.least(of("set", side), common / of("size", side))
    in_mass = lambda side: F.least(of("mass", side), (of("over", side) + common) / of("total", side))
    return (1 / in_set(a) + 1 / in_set(b) <= MOST_INVERSE) | (1 / in_mass(a) + 1 / in_mass(b) <= MOST_INVERSE)


def _pairs_left(members: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """All pairs that can be links among the members of buckets that hold several classes.

    The shingles of a text are taken from the rarest to the most frequent; at each, ``set`` and ``mass`` are the shares of
    the text's set and weight from there on. From the first shingle that two linked texts have in common, either has at least
    ``LONG`` of itself left and one of the two at least ``SHORT``, so only short prefixes meet long ones.
    Texts that share a template and are no links have more of their own than a short prefix holds, and do not meet.
    Classes meet first, by the best of their members; of a class, texts with repeats and texts without (``even``) meet by themselves.
    """
    now = stage(_labelled(members, labels, "node", "label"), "near-left")
    several = now.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    nodes = now.join(several, "key").select("node", "label").distinct()
    schema = "node long, label long, shingle long, weight long, size long, mass long"
    found = stage(texts.join(nodes, "node").select("node", "label", "text").mapInArrow(_shingled, schema), "near-shingles")
    # a shingle of one class alone takes its place in the order, but makes no pair
    held = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    held = stage(held.where("n > 1").select("shingle", "n", (F.col("low") < F.col("high")).alias("mixed")), "near-shared")
    after = Window.partitionBy("node").orderBy(F.desc("n"), "shingle").rowsBetween(Window.unboundedPreceding, 0)
    counted = found.join(held, "shingle").select(
        "shingle", "label", "node", "mixed", "size", F.col("mass").alias("total"), F.count(F.lit(1)).over(after).alias("rest"),
        F.sum("weight").over(after).alias("left"),
    ).select(
        "*", (F.col("left") - F.col("rest")).alias("over"), (F.col("size") == F.col("total")).alias("even"),
        (F.col("rest") / F.col("size")).alias("set"), (F.col("left") / F.col("total")).alias("mass"),
    )
    first = stage(counted.where(F.col("mixed") & (F.greatest("set", "mass") >= LONG - 1e-9)).drop("mixed", "left"), "near-first")
    classes = first.groupBy("shingle", "label", "even").agg(
        *[F.max(c).alias(c) for c in ("set", "mass", "rest", "over")], F.min("size").alias("size"), F.min("total").alias("total")
    )
    named = lambda df, side: df.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c != "shingle"])
    is_short = F.greatest("set", "mass") >= SHORT - 1e-9
    meetings = stage(  # classes first, so that members of one class never meet
        named(classes.where(is_short), "a").join(named(classes, "b"), "shingle").where(F.col("label_a") != F.col("label_b"))
        .where(_may_link("a", "b")).select("shingle", "label_a", "even_a", "label_b", "even_b"), "near-meetings",
    )
    short = meetings.join(named(first.where(is_short), "a"), ["shingle", "label_a", "even_a"])
    pairs = short.join(named(first, "b"), ["shingle", "label_b", "even_b"]).where(_may_link("a", "b"))
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _extended(pairs, labels, compared, texts):
    """Verify the pairs of different classes that were not compared before; ``labels`` itself is returned if no link is found."""
    apart = _labelled(_labelled(pairs, labels, "a", "label_a"), labels, "b", "label_b").where("label_a != label_b").select("a", "b")
    known = compared.union(compared.select("b", "a"))
    fresh = stage(apart.join(known, ["a", "b"], "left_anti"), "near-more-pairs")
    if fresh.isEmpty():
        return labels, compared
    found = _verified(fresh, texts)
    compared = compared.union(fresh)
    return labels if found.isEmpty() else components(found, labels), compared


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (largest doc_id of its class), class_size, text_sha256 and kept for every row."""
    rows, nodes, labels = near_links(docs)
    member = _labelled(rows.join(nodes.select("digest", "node"), "digest"), labels, "node", "label")
    member = stage(member.select("doc_id", "digest", "label"), "near-classes")
    sizes = member.groupBy("label").agg(F.max(F.struct("doc_id", "digest")).alias("top"), F.count(F.lit(1)).alias("class_size"))
    out = stage(member.join(sizes, "label"), "near-sized")  # staged, so that the join of a hot class can be split
    is_top = F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("digest") == F.col("top.digest"))
    tops = out.where(is_top).withColumn("kept", F.row_number().over(Window.partitionBy("label").orderBy("digest")) == 1)
    rest = out.where(~is_top).withColumn("kept", F.lit(False))
    return tops.unionByName(rest).select(
        "doc_id", F.col("top.doc_id").alias("class_id"), "class_size", F.lower(F.hex("digest")).alias("text_sha256"), "kept"
    )


def near_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, all their columns."""
    kept = near_classes(docs).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_digest"))
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), F.sha2(text_or_empty().cast("binary"), 256).alias("digest"))
    # ids are compared through a non-null form, so that the join stays an equality join
    at = lambda c: F.struct(F.col(c).isNull().alias("null"), F.coalesce(c, F.lit(0)).alias("id"))
    met = rows.withColumn("at", at("id")).join(kept.select(at("kept_id").alias("at"), F.col("kept_digest").alias("digest")), ["at", "digest"])
    turn = F.row_number().over(Window.partitionBy("at", "digest").orderBy("id"))
    return met.withColumn("turn", turn).where("turn = 1").select("doc.*")
