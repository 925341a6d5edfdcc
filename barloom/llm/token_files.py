"""Token ids in binary files, coded by static range asymmetric numeral systems.

One frequency table serves all files: ids are counted over the whole corpus (one partial count per
partition, at most one row per id of the vocabulary after that) and scaled to 2**SCALE_BITS. Documents are
range-sorted by doc_id; each partition writes files of about FILE_TOKENS ids, cut between documents. A file
holds blocks of BLOCK_TOKENS ids. A block is coded by itself: LANES interleaved coder states
take the ids in turn, and their end states open the block, so every entry of the file's block directory is a
checkpoint from which a decoder can start. Blocks, the directory and the frequency table carry a crc32.

File: magic, blocks, directory, length of the directory, magic. Block: crc32 of what follows, number of ids, number of
words (three 32-bit integers), LANES 64-bit states, then the 32-bit words. Directory (JSON lines compressed by
zlib): byte offset and ids of each block, then doc_id and number of ids of each document, in order.
All integers are little-endian.

Defined cases: a null or empty text has the end id alone. Rows that repeat a doc_id stand next to
each other, in the order of their ids, each with its own start. Null ids come first. An empty table gives no files and
no rows. Extra columns are not read. Several workers may decode one file at any checkpoint; decoding streams by
block, so a document may be longer than memory would hold.
"""
from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import stage, text_or_empty
from barloom.llm.shards import committed, read_file
from barloom.llm.tokens import encoder, slices_of, tokenizer_path
from barloom.sources.tables import scratch_dir

MAGIC = b"RANSTOK1"
END_ID = 1
SCALE_BITS = 20
LANES = 2_048
BLOCK_TOKENS = 1 << 19
FILE_TOKENS = 1 << 22
LOWEST = np.uint64(1 << 31)


class Coder:
    """Coder states over a frequency table scaled to 2**SCALE_BITS."""

    def __init__(self, counts: np.ndarray, lanes: int = LANES):
        self.lanes = lanes
        self.freq = scale(counts)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.freq = self.freq.astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.uint32), self.freq.astype(np.int64))
        self.crc = zlib.crc32(self.freq.tobytes())

    def encode(self, ids: np.ndarray) -> bytes:
        """One block: the ids are taken backwards, so that decoding goes forward."""
        state = np.full(self.lanes, LOWEST, np.uint64)
        words = []
        bits, half = np.uint64(SCALE_BITS), np.uint64(32)
        for at in range((len(ids) - 1) // self.lanes * self.lanes, -1, -self.lanes):
            row = ids[at:at + self.lanes]
            f, c, x = self.freq[row], self.start[row], state[:len(row)]
            full = x >= f << np.uint64(63 - SCALE_BITS)
            words.append(x[full].astype("<u4"))
            x = np.where(full, x >> half, x)
            q = x // f
            state[:len(row)] = (q << bits) + (x - q * f) + c
        stream = np.concatenate(words[::-1]) if words else np.empty(0, "<u4")
        body = struct.pack("<II", len(ids), len(stream)) + state.astype("<u8").tobytes() + stream.tobytes()
        return struct.pack("<I", zlib.crc32(body)) + body

    def decode(self, block: bytes) -> np.ndarray:
        if zlib.crc32(block[4:]) != struct.unpack_from("<I", block)[0]:
            raise ValueError("a block's checksum does not match its content")
        n, n_words = struct.unpack_from("<II", block, 4)
        state = np.frombuffer(block, "<u8", self.lanes, 12).astype(np.uint64)
        stream = np.frombuffer(block, "<u4", n_words, 12 + 8 * self.lanes).astype(np.uint64)
        out, used = np.empty(n, np.uint32), 0
        mask, bits, half = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
        for at in range(0, n, self.lanes):
            x = state[:min(self.lanes, n - at)]
            slot = x & mask
            row = self.symbol[slot]
            out[at:at + len(x)] = row
            x[:] = self.freq[row] * (x >> bits) + slot - self.start[row]
            low = np.flatnonzero(x < LOWEST)
            x[low] = (x[low] << half) | stream[used:used + len(low)]
            used += len(low)
        return out


def scale(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to 2**SCALE_BITS, at least 1 for every id that occurs."""
    total = 1 << SCALE_BITS
    n = int(counts.sum())
    if n == 0:
        return np.zeros(len(counts), np.int64)
    seen = counts > 0
    freq = np.where(seen, np.maximum(1, (counts.astype(float) * total / n).astype(np.int64)), 0)
    excess = int(freq.sum()) - total
    for i in np.argsort(-freq, kind="stable"):  # the most frequent ids bear the rounding
        if excess == 0:
            break
        step = min(excess, int(freq[i]) - 1) if excess > 0 else excess
        freq[i] -= step
        excess -= step
    return freq


@lru_cache(maxsize=2)
def _coder(counts: bytes) -> Coder:
    return Coder(np.frombuffer(zlib.decompress(counts), np.int64))


def _encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id and ids (little-endian 32-bit when the vocabulary asks for it, else 16-bit), the end id appended."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        end = np.array([end_id], codec.dtype).tobytes()
        for batch in batches:
            for at, texts in slices_of(batch.column("_text")):
                ids = pa.array([x + end for x in codec.encode(texts)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), ids], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("_text"))
    return rows.mapInArrow(coded, "doc_id long, ids binary")


def _counts(encoded: DataFrame, path: str) -> bytes:
    """How often each id occurs in the corpus; at most one row per id reaches the driver."""

    def counted(batches):
        codec, total = encoder(path), None
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), codec.dtype)
            n = np.bincount(ids, minlength=codec.full.get_vocab_size())
            total = n if total is None else total + n
        if total is not None:
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    rows = encoded.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(encoder(path).full.get_vocab_size(), np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return zlib.compress(counts.tobytes())


class _Writer:
    """The files of one partition."""

    def __init__(self, folder: str, part: int, coder: Coder):
        self.folder, self.part, self.coder, self.number = folder, part, coder, 0

    def file(self, documents: Iterator[tuple[int | None, np.ndarray]]) -> dict | None:
        """Write documents until the file has FILE_TOKENS ids; None when there are none left."""
        first = next(documents, None)
        if first is None:
            return None
        name = f"part-{self.part:06d}-{self.number:06d}.rans"
        self.number += 1
        blocks, index, tokens, pending, held = [], [], 0, [], 0
        with committed(self.folder, name) as out:
            out.write(MAGIC)
            document = first
            while True:
                index.append((document[0], len(document[1])))
                pending.append(document[1])
                held += len(document[1])
                tokens += len(document[1])
                if held >= BLOCK_TOKENS:
                    ids = np.concatenate(pending)
                    for at in range(0, held - BLOCK_TOKENS + 1, BLOCK_TOKENS):
                        blocks.append((out.tell(), BLOCK_TOKENS))
                        out.write(self.coder.encode(ids[at:at + BLOCK_TOKENS]))
                    pending = [ids[held - held % BLOCK_TOKENS:].copy()]
                    held %= BLOCK_TOKENS
                if tokens >= FILE_TOKENS:
                    break
                document = next(documents, None)
                if document is None:
                    break
            if held:
                blocks.append((out.tell(), held))
                out.write(self.coder.encode(np.concatenate(pending)))
            directory = zlib.compress(json.dumps({"table_crc32": self.coder.crc, "blocks": blocks, "docs": index}).encode())
            out.write(struct.pack("<I", zlib.crc32(directory)) + directory + struct.pack("<Q", len(directory) + 4) + MAGIC)
            size = out.tell()
        return {"part": self.part, "number": self.number - 1, "file": name, "docs": len(index), "tokens": tokens, "bytes": size}


MANIFEST = "part long, number long, file string, docs long, tokens long, bytes long"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write all documents in ascending doc_id order; the manifest, one row per file."""
    path = tokenizer or tokenizer_path()
    encoded = stage(_encoded(docs, path, end_id), "token-ids")
    counts = _counts(encoded, path)

    def written(batches):
        codec = encoder(path)

        def documents():
            for batch in batches:
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                    yield doc_id, np.frombuffer(ids, codec.dtype)

        writer, source = _Writer(folder, TaskContext.get().partitionId(), _coder(counts)), documents()
        while (row := writer.file(source)) is not None:
            yield pa.RecordBatch.from_pylist([row])

    ordered = encoded.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    manifest = ordered.mapInArrow(written, MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{folder}/_manifest")
    spark = docs.sparkSession
    spark.createDataFrame([(counts,)], "counts binary").write.mode("overwrite").parquet(f"{folder}/_frequencies")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def _documents(folder: str, name: str, coder: Coder) -> Iterator[tuple[int | None, int, int, int]]:
    """doc_id, first id in the file, number of ids and crc32 of the ids of each document, block by block."""
    with read_file(folder, name) as f:
        size = f.size()
        tail = f.read_at(16, size - 16)
        if tail[8:] != MAGIC or f.read_at(8, 0) != MAGIC:
            raise ValueError(f"{name} is no token file or is cut short")
        length = struct.unpack("<Q", tail[:8])[0]
        raw = f.read_at(length, size - 16 - length)
        if zlib.crc32(raw[4:]) != struct.unpack_from("<I", raw)[0]:
            raise ValueError(f"the directory of {name} does not match its checksum")
        directory = json.loads(zlib.decompress(raw[4:]))
        if directory["table_crc32"] != coder.crc:
            raise ValueError(f"{name} was coded with another frequency table")
        offsets = [b[0] for b in directory["blocks"]] + [size - 16 - length]
        decoded = (coder.decode(f.read_at(b - a, a)) for a, b in zip(offsets, offsets[1:]))
        ids, start = np.empty(0, np.uint32), 0
        for doc_id, n in directory["docs"]:
            crc, left = 0, n
            while left:
                if not len(ids):
                    ids = next(decoded)
                crc = zlib.crc32(ids[:left].astype("<u4").tobytes(), crc)
                took = min(left, len(ids))
                ids, left = ids[took:], left - took
            yield doc_id, start, n, crc
            start += n


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files of a manifest."""
    counts = spark.read.parquet(f"{folder}/_frequencies").first()["counts"]
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("part_tokens"))
    in_order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.select("part", (F.sum("part_tokens").over(in_order) - F.col("part_tokens")).alias("part_start"))
    in_part = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    files = manifest.join(parts, "part").select(
        "file", (F.col("part_start") + F.sum("tokens").over(in_part) - F.col("tokens")).alias("file_start")
    )

    def decoded(batches):
        coder = _coder(counts)
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("file_start").to_pylist()):
                rows = [(d, first + s, n, c) for d, s, n, c in _documents(folder, name, coder)]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = spark.sparkContext.defaultParallelism * 4
    return files.repartition(tasks, "file").mapInArrow(decoded, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    folder = scratch_dir(spark, "token-files")
    write_token_files(docs, folder)
    return read_token_files(spark, folder)
