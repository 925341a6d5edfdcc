"""Document fingerprints from closed syncmers.

A k-mer is a closed syncmer when the least of its inner s-mers (by hash) is its first or its last. Whether it
is one depends on the k-mer alone, so anchors survive edits elsewhere in the text. The fingerprint keeps all
anchors of the text, each with its hash and the position of its first occurrence. So it grows with the text (one anchor for about
six code points), a passage that two texts share leaves its anchors in both, and the likeness of two fingerprints is the
Jaccard similarity of the texts' whole anchor sets. Positions allow matching passages on a diagonal (``aligned``).

Text form: anchors as ``hash:position`` in hexadecimal, ascending by hash, joined by a space.

Neighbours in doc_id order are found without a global sort in one task: the ids are cut into ranges at
approximate quantiles; the highest row of each range is also sent to the range above it, where it is only the
last neighbour. Texts are shuffled once and stream through their range in order.

Defined cases: a null text counts as empty; the fingerprint of an empty text is empty; two empty ones have likeness 1 and
an empty one and another 0. A text with no closed syncmer (shorter than k, say) has one anchor, the hash
of the whole text. Rows that repeat a doc_id stand in the order of their texts, a null id after all
others; the last row's neighbour is the first row, which may be itself. An empty table gives no rows. Extra columns
are not read.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import text_or_empty

K = 16  # code points of an anchor
S = 5  # code points of an inner s-mer
HASH_BITS = 40
RANGE_ROWS = 2_048  # rows aimed at per range
MOST_RANGES = 100_000  # ranges at most; their first places are broadcast
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _windows(points: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of ``n`` values, from runs of half the length."""
    parts, run, total, power = [], points, 1, _BASE
    value, have = None, 0
    while n:
        if n & 1:
            parts.append((run, total, power))
        n >>= 1
        if n:
            run = run[:len(run) - total] * power + run[total:]
            power, total = power * power, total * 2
    for run, length, power in reversed(parts):
        if value is None:
            value, have = run, length
        else:
            size = len(points) - have - length + 1
            value, have = value[:size] * power + run[have:have + size], have + length
    return value


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the closed syncmers of a text, in text order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    found = np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        if len(points) >= k:
            inner = _mix(_windows(points, s))
            span = k - s + 1  # s-mers in a k-mer
            least, width = inner, 1
            while width * 2 <= span:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < span:
                least = np.minimum(least[:len(inner) - span + 1], least[span - width:])
            found = np.flatnonzero((inner[:len(least)] == least) | (inner[span - 1:] == least))
        if len(found):
            return _mix(_windows(points, k)[found]), found
        if not len(points):
            return np.empty(0, np.uint64), found
        return _mix(_windows(points, len(points))), np.zeros(1, np.int64)


class Fingerprint:
    """All anchors of a text: 40-bit hashes, ascending, and their first positions."""

    def __init__(self, text: str):
        hashes, positions = anchors(text)
        self.hashes, first = np.unique(hashes >> np.uint64(64 - HASH_BITS), return_index=True)
        self.positions = positions[first]

    def __str__(self) -> str:
        return " ".join(map("%x:%x".__mod__, zip(self.hashes.tolist(), self.positions.tolist())))


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Jaccard similarity of two anchor sets."""
    if not len(a.hashes) or not len(b.hashes):
        return float(len(a.hashes) == len(b.hashes))
    both = len(np.intersect1d(a.hashes, b.hashes, assume_unique=True))
    return both / (len(a.hashes) + len(b.hashes) - both)


def aligned(a: Fingerprint, b: Fingerprint) -> float:
    """Share of the common anchors that lie on one diagonal, the most frequent shift of positions."""
    both, i, j = np.intersect1d(a.hashes, b.hashes, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    return int(np.unique(a.positions[i] - b.positions[j], return_counts=True)[1].max()) / len(both)


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as many first code points of the next text, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "aligned_edited"]


def _compared(pairs: list[tuple]) -> pa.RecordBatch:
    rows = []
    for doc_id, text, own, following, other in pairs:
        changed = edited(text, following)
        print_changed = own if changed == text else Fingerprint(changed)
        rows.append((
            doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), str(own), str(print_changed),
            likeness(own, print_changed), likeness(own, other), aligned(own, print_changed),
        ))
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], NAMES)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, aligned_edited double"
)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges arrive one after the other, each in order and closed by the row after its last."""
    before, pairs, size = None, [], 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("ahead", "doc_id", "text")]
        for ahead, doc_id, text in zip(*columns):
            own = Fingerprint(text)
            if before is not None:
                pairs.append((*before, text, own))
                size += len(before[1]) + len(text)
            before = None if ahead else (doc_id, text, own)
            if size > 4_000_000:
                yield _compared(pairs)
                pairs, size = [], 0
    if pairs:
        yield _compared(pairs)


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness to it and to the next document."""
    # descending ids become ascending places; a null id comes last
    place = F.coalesce(-F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
        place.alias("place"), place.cast("double").alias("at"),
    )
    pieces = max(1, min(rows.count() // range_rows, MOST_RANGES))
    chances = [i / pieces for i in range(1, pieces)]
    cuts = sorted(set(rows.approxQuantile("at", chances, 0.1 / pieces))) if chances else []
    if cuts:
        rows = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="at", outputCol="range").transform(rows)
    else:
        rows = rows.withColumn("range", F.lit(0.0))
    ranged = rows.drop("at")
    # one row per range, MOST_RANGES at most: its first place and the range before it (before the first: the last)
    around = Window.orderBy("range")
    last = Window.orderBy(F.col("range").desc())
    first = ranged.groupBy("range").agg(F.min("place").alias("place")).select(
        "range", "place", F.coalesce(F.lag("range").over(around), F.first("range").over(last)).alias("to")
    )
    heads = (
        ranged.join(F.broadcast(first), ["range", "place"]).groupBy("to").agg(F.min_by(F.struct("doc_id", "place", "text"), "text").alias("head"))
        .select("head.*", F.col("to").alias("range"), F.lit(1).alias("ahead"))
    )
    met = ranged.withColumn("ahead", F.lit(0)).unionByName(heads).repartition("range")
    in_order = met.sortWithinPartitions("range", "ahead", "place", "text").select("ahead", "doc_id", "text")
    return in_order.mapInArrow(_streamed, SCHEMA)
