"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts learned from the whole training part of the corpus. The contexts of a byte are the
token so far (up to ``MAX_CONTEXT`` bytes), then its last two bytes, its last byte, none, and at last all bytes
alike; bytes that a longer context has ruled out are excluded from the shorter ones. A context that has seen n bytes, k of them
different, escapes with an estimated probability: for the trie, contexts of like depth, n and k are pooled and
the share of bytes that would be new if one occurrence were left out is counted; for the short contexts it is k / (n + k). Tokens
end with a blank, which no token holds; a document ends with an empty token.

A document's own tokens are its first context and adapt the model to it: after t tokens, one seen c times so far
has (c + ADAPT * p) / (t + ADAPT), p being its probability in the trie; ADAPT / (t + ADAPT) is the escape. All
probabilities of documents add up to 1, and a score is the log10 probability of a whole document.

A token's p depends on the token alone, so each distinct token is looked up once:

1. Documents are cut into blocks where they lie; a block holds its distinct tokens with their training counts and its
   documents as numbers of those tokens. Blocks are staged.
2. Counts of equal tokens are added up (combined by block already), which gives c, N and V for the base score.
3. Tokens are cut into ranges of the sorted order, so that subtrees of the trie stay together, one row per range. Trie nodes
   that span ranges are prefixes of the cut points; their counts, the short contexts (256**3 at most) and the escape
   classes are summed up and sent to all tasks. Then each range is walked as a trie and gives p of its tokens.
4. Results return to the blocks through a join on the token (a token comes once per block, hot tokens are split by
   adaptive execution), and each block adds up its documents.

Nothing but those bounded counts goes through the driver; a block and a range are bounded by their parameters.

Defined cases: null counts as empty and consists of the end token alone. A null doc_id hashes as the empty text. Without
training documents all bytes are alike, N and V are 0 and the base score is log10(0.1 / 0.1) = 0. Rows that repeat count each for itself. An
empty table gives no rows. Extra columns are not read. A word longer than MAX_CONTEXT bytes goes on with its last two bytes.
"""
from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import id_crc, stage, text_or_empty

BLOCK_CHARS = 16_000_000
MAX_CONTEXT = 32
RANGE_WORDS = 50_000
MOST_RANGES = 16_384
END = 0x20  # the byte that ends a token
ADAPT = 1_000  # tokens of a document that weigh as much as the trie
ALPHABET = 251  # bytes that can occur: all but five kinds of white space


class ShortContexts:
    """Predictions from the last two bytes, the last, none, and from no knowledge."""

    def __init__(self, counts: dict[bytes, dict[int, int]]):
        self.counts = counts
        self.known: dict[tuple[bytes, int], float] = {}

    def step(self, token: bytes, i: int, excluded: frozenset[int] | set[int] = frozenset()) -> float:
        """log10 probability of the byte at ``i`` (the end after the last), the excluded bytes being ruled out."""
        symbol = token[i] if i < len(token) else END
        recent = token[max(0, i - 2):i]
        if not excluded and (recent, symbol) in self.known:
            return self.known[recent, symbol]
        out, ruled = 0.0, set(excluded)
        for start in range(len(recent) + 1):
            seen = self.counts.get(recent[start:])
            if not seen:
                continue
            left = {s: c for s, c in seen.items() if s not in ruled}
            n, k = sum(left.values()), len(left)
            if not n:
                continue
            if symbol in left:
                out += log10(left[symbol] / (n + k))
                break
            out += log10(k / (n + k))
            ruled.update(left)
        else:
            out -= log10(ALPHABET - len(ruled))
        if not excluded:
            self.known[recent, symbol] = out
        return out

    def rest(self, token: bytes, i: int) -> float:
        return sum(self.step(token, j) for j in range(i, len(token) + 1))


def escape_class(depth: int, n: int, k: int) -> tuple[int, int, int]:
    """Contexts that share an escape estimate: depth up to 8, n and k exact when small, else by powers of two."""
    return min(depth, 8), n if n < 4 else 2 + n.bit_length(), k if k < 4 else 2 + k.bit_length()


def add_escapes(depth: int, counts: list[int], events: dict[tuple[int, int, int], list[int]]) -> None:
    """What leaving out each occurrence of a context's bytes in turn tells: [new bytes, all bytes] by class."""
    n, k, once = sum(counts), len(counts), counts.count(1)
    if n > 1 and once:
        event = events.setdefault(escape_class(depth, n - 1, k - 1), [0, 0])
        event[0] += once
        event[1] += once
    if n > once and n > 1:
        events.setdefault(escape_class(depth, n - 1, k), [0, 0])[1] += n - once


def _runs(tokens: list[bytes], lo: int, hi: int, depth: int) -> list[tuple[int, int, int]]:
    """Stretches of sorted tokens with the same byte at ``depth``."""
    runs, start, symbol = [], lo, None
    for i in range(lo, hi):
        token = tokens[i]
        s = token[depth] if len(token) > depth else END
        if s != symbol:
            if symbol is not None:
                runs.append((symbol, start, i))
            start, symbol = i, s
    runs.append((symbol, start, hi))
    return runs


def range_escapes(tokens: list[bytes], counts: list[int], spanning, events, max_context: int = MAX_CONTEXT) -> None:
    """Escape events of the trie nodes that lie within a range; all counts are positive."""
    stack = [(0, len(tokens), 0)] if tokens else []
    while stack:
        lo, hi, depth = stack.pop()
        if depth == max_context:
            continue
        spans = tokens[lo][:depth] in spanning
        if hi - lo == 1 and not spans:
            if counts[lo] > 1:
                for d in range(depth, min(len(tokens[lo]) + 1, max_context)):
                    add_escapes(d, [counts[lo]], events)
            continue
        runs = _runs(tokens, lo, hi, depth)
        if not spans:
            add_escapes(depth, [sum(counts[a:b]) for _, a, b in runs], events)
        stack.extend((a, b, depth + 1) for s, a, b in runs if s != END)


class TokenScorer:
    """log10 probabilities of the sorted distinct tokens of one range."""

    def __init__(self, spanning: dict[bytes, dict[int, int]], short: ShortContexts, events, max_context: int = MAX_CONTEXT):
        self.spanning, self.short, self.max_context, self.events = spanning, short, max_context, events

    def escape(self, depth: int, n: int, k: int) -> float:
        event = self.events.get(escape_class(depth, n, k))
        return (event[0] + 0.5) / (event[1] + 1) if event else k / (n + k)

    def score(self, tokens: list[bytes], counts: list[int]) -> list[float]:
        self.tokens, self.counts, self.out = tokens, counts, [0.0] * len(tokens)
        if tokens:
            self._walk(0, len(tokens), 0, 0.0)
        return self.out

    def _walk(self, lo: int, hi: int, depth: int, so_far: float) -> None:
        tokens, counts, out = self.tokens, self.counts, self.out
        prefix = tokens[lo][:depth]
        spanning = self.spanning.get(prefix)
        if depth == self.max_context:
            for i in range(lo, hi):
                out[i] = so_far + self.short.rest(tokens[i], depth)
            return
        if hi - lo == 1 and spanning is None and counts[lo]:
            token, c = tokens[lo], counts[lo]  # all that is left is this token: each step only does not escape
            out[lo] = so_far + sum(log10(1 - self.escape(d, c, 1)) for d in range(depth, min(len(token) + 1, self.max_context)))
            if len(token) >= self.max_context:
                out[lo] += self.short.rest(token, self.max_context)
            return
        runs = _runs(tokens, lo, hi, depth)
        seen = spanning if spanning is not None else {s: c for s, a, b in runs if (c := sum(counts[a:b]))}
        n, k = sum(seen.values()), len(seen)
        escape = self.escape(depth, n, k) if n else 1.0
        for s, a, b in runs:
            if c := seen.get(s):
                reached = so_far + log10((1 - escape) * c / n)
                if s == END:
                    out[a] = reached
                else:
                    self._walk(a, b, depth + 1, reached)
            else:
                escaped = so_far + log10(escape)
                ruled = set(seen)
                for i in range(a, b):
                    token = tokens[i]
                    out[i] = escaped + self.short.step(token, depth, ruled)
                    if depth < len(token):
                        out[i] += self.short.rest(token, depth + 1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block; documents as compressed numbers of the block's distinct tokens."""
    packer, part, number = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId(), 0
    index: dict[bytes, int] = {}
    trained, documents, size = [], [], 0

    def row():
        nonlocal index, trained, documents, size, number
        learned = np.zeros(len(index), np.int64)
        for ids in trained:
            learned += np.bincount(ids, minlength=len(index))
        out = {
            "block": (part << 33) + number, "tokens": list(index), "learned": learned.tolist(),
            "documents": [{"doc_id": d, "held_out": h, "n": n, "ids": ids} for d, h, n, ids in documents],
        }
        index, trained, documents, size = {}, [], [], 0
        number += 1
        return pa.RecordBatch.from_pylist([out], schema=BLOCK_ARROW)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text")]
        for doc_id, held_out, text in zip(*columns):
            tokens = text.encode("utf-8", "surrogatepass").lower().split()
            tokens.append(b"")
            ids = np.fromiter((index.setdefault(t, len(index)) for t in tokens), np.uint32, len(tokens))
            if not held_out:
                trained.append(ids)
            planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T  # the high bytes of all numbers together compress well
            documents.append((doc_id, held_out, len(ids), packer.compress(planes.tobytes())))
            size += len(text)
            if size >= BLOCK_CHARS:
                yield row()
    if documents:
        yield row()


BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("tokens", pa.list_(pa.binary())), ("learned", pa.list_(pa.int64())),
    ("documents", pa.list_(pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n", pa.int64()), ("ids", pa.binary())]))),
])
BLOCK = (
    "block long, tokens array<binary>, learned array<long>, "
    "documents array<struct<doc_id: long, held_out: boolean, n: long, ids: binary>>"
)


def context_counts(tokens: list[bytes], counts: np.ndarray, spanning: set[bytes], found: dict[tuple[int, bytes, int], int]) -> None:
    """Add to ``found`` what tokens tell about the short contexts (by order) and the spanning trie nodes (order -1)."""
    flat = np.frombuffer(b"".join(t + b" " for t in tokens), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    weight = np.repeat(counts, lengths)
    one, two = np.roll(flat, 1), np.roll(flat, 2)
    for order in range(3):
        at = place >= order
        key = flat[at] | (one[at] << 8 if order > 0 else 0) | (two[at] << 16 if order > 1 else 0)
        keys, inverse = np.unique(key, return_inverse=True)
        for key, n in zip(keys.tolist(), np.bincount(inverse, weight[at]).tolist()):
            context = (key >> 8).to_bytes(order, "big")
            found[order, context, key & 255] = found.get((order, context, key & 255), 0) + int(n)
    for token, n in zip(tokens, counts.tolist()):
        depth = 0
        while depth < MAX_CONTEXT and depth <= len(token) and (prefix := token[:depth]) in spanning:
            cell = -1, prefix, token[depth] if depth < len(token) else END
            found[cell] = found.get(cell, 0) + n
            depth += 1


def _token_scores(words: DataFrame, distinct: int, range_words: int) -> DataFrame:
    """token, c and logp of every distinct token."""
    ranges = max(1, min(distinct // range_words, MOST_RANGES))
    cuts: list[bytes] = []
    if ranges > 1:
        stride = max(1, distinct // (ranges * 50))  # about 50 sampled tokens per range, bounded by MOST_RANGES
        sample = words.where(F.pmod(F.xxhash64("token"), F.lit(stride)) == 0).select(F.substring("token", 1, MAX_CONTEXT).alias("t"))
        drawn = sorted(bytes(r["t"]) for r in sample.collect())
        cuts = sorted({drawn[i * len(drawn) // ranges] for i in range(1, ranges)}) if drawn else []
    spanning = {c[:d] for c in cuts for d in range(len(c) + 1)}

    def placed(batches):
        for batch in batches:
            place = pa.array([bisect_right(cuts, t) for t in batch.column("token").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([place, batch.column("token"), batch.column("c")], ["place", "token", "c"])

    in_ranges = words.mapInArrow(placed, "place int, token binary, c long").repartition(max(1, len(cuts) + 1), "place")
    schema = "place int, tokens array<binary>, counts array<long>"
    sorted_ranges = stage(in_ranges.sortWithinPartitions("place", "token").mapInArrow(_gathered, schema), "ppm-ranges")

    def counted(batches):
        found: dict[tuple[int, bytes, int], int] = {}
        events: dict[tuple[int, int, int], list[int]] = {}
        for batch in batches:
            for tokens, counts in zip(batch.column("tokens").to_pylist(), batch.column("counts").to_pylist()):
                tokens, counts = [t for t, c in zip(tokens, counts) if c], [c for c in counts if c]
                if tokens:
                    context_counts(tokens, np.array(counts, np.int64), spanning, found)
                    range_escapes(tokens, counts, spanning, events)
        for key, event in events.items():
            found.update({(-2, bytes(key), i): x for i, x in enumerate(event)})
        rows = list(zip(*[(o, p, s, n) for (o, p, s), n in found.items()])) or [()] * 4
        types = [pa.int32(), pa.binary(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], ["kind", "context", "symbol", "n"])

    short: dict[bytes, dict[int, int]] = {}
    nodes: dict[bytes, dict[int, int]] = {p: {} for p in spanning}
    events: dict[tuple[int, int, int], list[int]] = {}
    partial = sorted_ranges.select("tokens", "counts").mapInArrow(counted, "kind int, context binary, symbol int, n long")
    for r in partial.groupBy("kind", "context", "symbol").agg(F.sum("n").alias("n")).collect():
        context = bytes(r["context"])
        if r["kind"] == -2:
            events.setdefault(tuple(context), [0, 0])[r["symbol"]] += r["n"]
        else:
            (nodes if r["kind"] < 0 else short).setdefault(context, {})[r["symbol"]] = r["n"]
    for prefix, seen in nodes.items():
        add_escapes(len(prefix), list(seen.values()), events)
    shared = words.sparkSession.sparkContext.broadcast((nodes, short, events))

    def scored(batches):
        nodes, short, events = shared.value
        scorer = TokenScorer(nodes, ShortContexts(short), events)
        for batch in batches:
            for tokens, counts in zip(batch.column("tokens").to_pylist(), batch.column("counts").to_pylist()):
                logp = scorer.score(tokens, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens, pa.binary()), pa.array(counts, pa.int64()), pa.array(logp, pa.float64())], ["token", "c", "logp"]
                )

    return sorted_ranges.select("tokens", "counts").mapInArrow(scored, "token binary, c long, logp double")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range; its tokens arrive in order."""
    schema = pa.schema([("place", pa.int32()), ("tokens", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])
    place, tokens, counts = None, [], []
    for batch in batches:
        for p, t, c in zip(*(batch.column(n).to_pylist() for n in ("place", "token", "c"))):
            if p != place:
                if tokens:
                    yield pa.RecordBatch.from_pylist([{"place": place, "tokens": tokens, "counts": counts}], schema=schema)
                place, tokens, counts = p, [], []
            tokens.append(t)
            counts.append(c)
    if tokens:
        yield pa.RecordBatch.from_pylist([{"place": place, "tokens": tokens, "counts": counts}], schema=schema)


def adapted(ids: np.ndarray, logp: np.ndarray, adapt: float = ADAPT) -> float:
    """log10 probability of a document whose tokens (by number) have the given probabilities in the trie."""
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[order], prepend=-1))
    seen = np.empty(len(ids))  # earlier occurrences of each token in the document
    seen[order] = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
    before = np.arange(len(ids))
    # a token seen never before may have a probability too small for a double; its logarithm is added instead
    again = np.log10(np.maximum(seen + adapt * 10.0 ** logp, 1e-300))
    return float(np.where(seen > 0, again, logp + np.log10(adapt)).sum() - np.log10(before + adapt).sum())


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and scores of a block's tokens as arrays; rows arrive by block and token number."""
    block, counts, scores = None, [], []

    def out():
        return pa.RecordBatch.from_pylist([{
            "block": block, "counts": np.concatenate(counts).astype("<i8").tobytes(), "scores": np.concatenate(scores).astype("<f8").tobytes(),
        }])

    for batch in batches:
        blocks = batch.column("block").to_numpy()
        for at in np.split(np.arange(len(blocks)), np.flatnonzero(np.diff(blocks)) + 1):
            if not len(at):
                continue
            if blocks[at[0]] != block:
                if counts:
                    yield out()
                block, counts, scores = int(blocks[at[0]]), [], []
            counts.append(batch.column("c").to_numpy()[at])
            scores.append(batch.column("logp").to_numpy()[at])
    if counts:
        yield out()


RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def ppm_scores(docs: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """Base and PPM scores of every document; those whose id hashes to a multiple of ten are held out of the training."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (id_crc() % 10 == 0).alias("held_out"), text_or_empty().alias("text")
    )
    blocks = stage(rows.mapInArrow(_blocks, BLOCK), "ppm-blocks")
    entries = blocks.select(F.explode(F.arrays_zip("tokens", "learned")).alias("e")).select("e.tokens", "e.learned")
    words = stage(entries.groupBy(F.col("tokens").alias("token")).agg(F.sum("learned").alias("c")), "ppm-words")
    total = words.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.count(F.lit(1)).alias("distinct")).first()
    n, v = total["n"] or 0, total["v"] or 0
    scored = stage(_token_scores(words, total["distinct"], range_words), "ppm-scores")
    wanted = blocks.select("block", F.posexplode("tokens").alias("at", "token"))
    met = wanted.join(scored, "token").select("block", "at", "c", "logp")
    arrays = met.repartition("block").sortWithinPartitions("block", "at").mapInArrow(_returned, "block long, counts binary, scores binary")

    def summed(batches):
        unpacker, divisor = zstandard.ZstdDecompressor(), n + 0.1 * (v + 1)
        for batch in batches:
            for documents, counts, scores in zip(*(batch.column(c).to_pylist() for c in ("documents", "counts", "scores"))):
                c, logp = np.frombuffer(counts, "<i8"), np.frombuffer(scores, "<f8")
                base, out = np.log10((c + 0.1) / divisor), []
                for d in documents:
                    planes = np.frombuffer(unpacker.decompress(d["ids"]), np.uint8).reshape(4, -1)
                    ids = np.ascontiguousarray(planes.T).view("<u4").ravel()
                    out.append((d["doc_id"], d["held_out"], d["n"], int((c[ids] > 0).sum()), n, float(base[ids].sum()), adapted(ids.astype(np.int64), logp[ids])))
                types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                names = [x.split()[0] for x in RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names)

    return blocks.select("block", "documents").join(arrays, "block").select("documents", "counts", "scores").mapInArrow(summed, RESULT)
