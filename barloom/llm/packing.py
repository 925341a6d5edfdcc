"""Packing token ids into training sequences, balanced by attention cost.

Texts are encoded and packed where they lie: every input partition is one stream, cut into windows of
``WINDOW_TOKENS`` ids, and no text or id is shuffled. A document longer than a sequence fills whole
sequences first. The pieces left in a window are taken by descending length; each goes to the
sequence of least cost that has room for it, where a piece of n ids costs ``LINEAR * n + QUADRATIC * n * n`` (the
feed-forward and the attention share). A piece that no sequence has room for is cut at the room of the
emptiest one. The window opens only as many sequences as its ids fill, and what is left over waits for the next
window. At the end of a partition the rest goes to sequences at powers of two, so no id of padding is
needed. Sequences are numbered from 0 without gaps: pieces are staged, and one count per partition gives its first
number.

Defined cases: a null or empty text is its end id alone. Repeated rows are packed each for itself, and an
id is in exactly one piece. An empty table gives no rows. Extra columns are not read.
"""
from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import give_back, stage, text_or_empty
from barloom.llm.tokens import encoder, slices_of, tokenizer_path

CAPACITY = 4_096
END_ID = 2
WINDOW_TOKENS = 64 * CAPACITY
LINEAR = 1.0
QUADRATIC = 1.0 / CAPACITY


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def assign(lengths: list[int], room: list[int]) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """Pieces (item, start in item, length, sequence) and what is left over (item, start), when the rooms are full."""
    waiting = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    cheapest = [(0.0, s) for s, r in enumerate(room) if r]
    heapq.heapify(cheapest)
    placed = []
    while waiting and cheapest:
        n, i, start = heapq.heappop(waiting)
        n, passed, chosen = -n, [], None
        while cheapest and chosen is None:
            entry = heapq.heappop(cheapest)
            if room[entry[1]] >= n:
                chosen = entry
            else:
                passed.append(entry)
        if chosen is None:
            chosen = max(passed, key=lambda e: (room[e[1]], -e[0], -e[1]))
            passed.remove(chosen)
            heapq.heappush(waiting, (room[chosen[1]] - n, i, start + room[chosen[1]]))
            n = room[chosen[1]]
        spent, s = chosen
        placed.append((i, start, n, s))
        room[s] -= n
        for entry in passed:
            heapq.heappush(cheapest, entry)
        if room[s]:
            heapq.heappush(cheapest, (spent + cost(n), s))
    return placed, [(i, start) for _, i, start in sorted(waiting)]


class Packer:
    """Packs one stream of documents; rows come out as (doc_id, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, capacity: int = CAPACITY, window_tokens: int = WINDOW_TOKENS):
        self.capacity, self.window_tokens = capacity, window_tokens
        self.items: list[tuple[object, int, int, np.ndarray]] = []  # doc_id, start, tokens of the document, ids left
        self.held = self.sequences = 0

    def _row(self, doc_id, start, total, ids, sequence, offset):
        return doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        total, start = len(ids), 0
        while total - start >= self.capacity:
            yield self._row(doc_id, start, total, ids[start:start + self.capacity], self.sequences, 0)
            self.sequences += 1
            start += self.capacity
        if start < total:
            self.items.append((doc_id, start, total, ids[start:]))
            self.held += total - start
        if self.held >= self.window_tokens:
            yield from self._pack([self.capacity] * (self.held // self.capacity))

    def finish(self) -> Iterator[tuple]:
        rest = self.held % self.capacity
        powers = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        yield from self._pack([self.capacity] * (self.held // self.capacity) + powers)

    def _pack(self, room: list[int]) -> Iterator[tuple]:
        used = [0] * len(room)
        placed, left = assign([len(ids) for *_, ids in self.items], room)
        for i, at, n, s in placed:
            doc_id, start, total, ids = self.items[i]
            yield self._row(doc_id, start + at, total, ids[at:at + n], self.sequences + s, used[s])
            used[s] += n
        self.sequences += len(room)
        self.items = [(d, start + at, total, ids[at:]) for i, at in left for d, start, total, ids in [self.items[i]]]
        self.held = sum(len(ids) for *_, ids in self.items)


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, release: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``release`` empties the workers' tables of known words after each partition, for jobs whose workers go on to other stages.
    """
    path = tokenizer or tokenizer_path()
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence", "offset"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, packer, part = encoder(path), Packer(), TaskContext.get().partitionId()
        end = np.array([end_id], codec.dtype).tobytes()

        def out(rows):
            columns = list(zip(*rows)) or [()] * 7
            arrays = [pa.array(c, pa.int64()) for c in columns]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(rows), pa.int64())], ["doc_id", *names, "part"])

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at, texts in slices_of(batch.column("_text")):
                rows = []
                for doc_id, coded in zip(ids[at:at + len(texts)], codec.encode(texts)):
                    rows.extend(packer.add(doc_id, np.frombuffer(coded + end, codec.dtype)))
                yield out(rows)
        yield out(list(packer.finish()))
        if release:
            codec.rest()
            give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("_text"))
    schema = rows.select("doc_id").schema
    for n in [*names, "part"]:
        schema = schema.add(n, "long")
    pieces = stage(rows.mapInArrow(packed, schema), "packed-pieces")
    counts = pieces.groupBy("part").agg((F.max("sequence") + 1).alias("n"))
    first = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    return pieces.join(counts.select("part", first.alias("first")), "part").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("sequence")).alias("sequence_id"), "offset"
    )
