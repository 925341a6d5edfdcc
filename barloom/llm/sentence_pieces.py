"""SentencePiece ids of whole texts by a table of distinct chunks, and texts of ids.

The library puts a marker in place of every space. When no piece holds a marker after another character, no merge
crosses the start of a marker run, so a text's ids are those of its chunks (a marker run with what follows it), one
after the other. Texts are taken in slices of about ``SLICE_CHARS`` code points where they lie: their chunks become a
column of places in the slice's table of distinct chunks, each of these is segmented once (normalised already, so the
library's normaliser is off), and the ids are joined back by position. A worker keeps short chunks it has segmented, up to
``KEPT_CHUNKS``, for its next slices. Nothing is shuffled and memory does not grow with the input or with how often
a chunk occurs. A table for the whole corpus would move every text or every distinct chunk of every block, for a segmentation that
costs less than the move.

A model whose pieces can cross markers gets whole texts as chunks, so equal texts of a slice are still segmented once.
Decoding is the library's own, on the ids of each row.

Defined cases: a null text counts as empty and gives no ids; null ids give null; texts without any space, or of
any length, are one chunk; repeated and null document ids change nothing; an empty table gives no rows; only ``keep``
columns are carried, so other columns may have any names.
"""
from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import text_or_empty

SLICE_CHARS = 1_000_000
KEPT_CHUNKS = 150_000  # a worker's table of known chunks starts anew beyond
KEPT_LENGTH = 64  # code points; longer chunks are hardly met again
CHUNKS_PER_CALL = 2_000
MARKER = "▁"
_CHUNKS = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")


class Pieces:
    """A model of the library with the chunks it allows."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.full = SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        names, rules = [p.piece for p in spec.pieces], spec.normalizer_spec
        crossing = any(MARKER in name.lstrip(MARKER) for name in names)
        self.cuts = MARKER in names and not crossing and rules.escape_whitespaces
        # every text then starts with a marker, and so does every chunk: its key leaves the marker out
        self.marked = self.cuts and rules.add_dummy_prefix
        rules.name, rules.precompiled_charsmap = "identity", b""
        rules.add_dummy_prefix = rules.remove_extra_whitespaces = False
        self.bare = SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.known: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        """Keys of the chunks of a text in order."""
        normal = self.full.normalize(text)
        if not normal:
            return []
        if not self.cuts:
            return [normal]
        if not self.marked:
            return _CHUNKS.findall(normal)
        if MARKER * 2 in normal:
            return [chunk[1:] for chunk in _CHUNKS.findall(normal)]
        return normal[1:].split(MARKER)

    def segmented(self, keys: list[str]) -> Iterator[bytes]:
        """Ids of chunks as 32-bit numbers, each segmented by the library."""
        lead = MARKER if self.marked else ""
        for start in range(0, len(keys), CHUNKS_PER_CALL):
            some = [lead + key for key in keys[start:start + CHUNKS_PER_CALL]]
            for ids in self.bare.encode(some, num_threads=1, add_bos=False, add_eos=False, enable_sampling=False):
                yield array("i", ids).tobytes()

    def encode(self, texts: list[str]) -> pa.ListArray:
        """Ids of whole texts: distinct chunks are segmented, then taken by the places of all chunks."""
        split = [self.chunks(text) for text in texts]
        places = pa.array(chain.from_iterable(split), pa.large_string()).dictionary_encode()
        keys = places.dictionary.to_pylist()
        if len(self.known) > KEPT_CHUNKS:
            self.known = {}
        new = [key for key in keys if key not in self.known]
        found = dict(zip(new, self.segmented(new)))
        of_keys = [found[key] if key in found else self.known[key] for key in keys]
        self.known.update((key, ids) for key, ids in found.items() if len(key) <= KEPT_LENGTH)
        sizes = np.fromiter(chain([0], map(len, of_keys)), np.int64) // 4
        ids = np.frombuffer(b"".join(of_keys), np.int32)
        by_place = pa.LargeListArray.from_arrays(pa.array(np.cumsum(sizes)), pa.array(ids)).take(places.indices)
        ends = by_place.offsets.to_numpy()[np.cumsum([0, *map(len, split)])]
        return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), by_place.values).cast(pa.list_(pa.int32()))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts of ids; null for null."""
        flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
        return pa.array(
            [self.full.decode(flat[a:b].tolist()) if ok else None
             for a, b, ok in zip(ends, ends[1:], ids.is_valid().to_pylist())], pa.string())


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(
    docs: DataFrame, keep: Sequence[str], path: str | None = None, text: str = "text", decoded: bool = False,
    slice_chars: int = SLICE_CHARS,
) -> DataFrame:
    """``_row`` (the ``keep`` columns) and ``ids`` (array of int) of every row, as the library encodes its whole text.

    ``decoded`` adds the text that the library gives back for these ids, in the same pass.
    """
    path = path or model_path()
    rows = docs.select(text_or_empty(text).alias("text"), F.struct(*keep).alias("_row"))
    schema = T.StructType([
        T.StructField("_row", rows.schema["_row"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        *([T.StructField("decoded", T.StringType())] if decoded else []),
    ])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for part in _slices(batch, slice_chars):
                ids = model.encode(part.column("text").to_pylist())
                back = [model.decode(ids)] if decoded else []
                yield pa.RecordBatch.from_arrays([part.column("_row"), ids, *back], names=schema.names)

    return rows.mapInArrow(encoded, schema)


def _slices(batch: pa.RecordBatch, most_chars: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch whose texts end in the same stretch of ``most_chars`` code points."""
    stretch = np.cumsum(pc.utf8_length(batch.column("text")).to_numpy()) // most_chars
    starts = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), len(stretch)]
    for start, end in zip(starts, starts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def decode(ids: Column, path: str | None = None) -> Column:
    """The text the library gives back for an array of ids; null for null."""
    path = path or model_path()

    @F.arrow_udf(T.StringType())
    def texts(column: pa.Array) -> pa.Array:
        return pieces(path).decode(column)

    return texts(ids)
