"""Token ids of whole texts by a public tokenizer of the ``tokenizers`` library.

The tokenizer drops white space and no merge crosses it, so a text's ids are those of its pieces
between white space, one after the other. Arrow splits a slice of texts and finds its distinct pieces; their
ids are made once per slice and gathered by position. A plain piece (Latin letters, then perhaps ASCII punctuation) is split
into its lower-case word and its tail, both kept in bounded tables, and all new words of a slice go to the library in one
call; other pieces go to it one by one and have a table of their own. Texts with control characters that Python, but
not the tokenizer, takes for white space are encoded whole.
"""
from __future__ import annotations

import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from barloom.llm.common import only_model

KEPT_PIECES = 100_000  # entries after which a worker's tables of tails and of other pieces make room
KEPT_WORDS = 300_000  # the same for its table of lower-case words
WORDS_PER_CALL = 1_000
_PLAIN = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-įı-ſ]+)(?P<tail>[!-/:-@\[-`{-~]*)$"
_ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


class Encoder:
    """Ids of texts as little-endian bytes, two or four per id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        small = self.full.get_vocab_size() <= 1 << 16
        self.dtype, self.code = (np.dtype("<u2"), "H") if small else (np.dtype("<u4"), "I")
        self.words = Tokenizer(self.full.model)  # for plain words: their letters are one unit of the merges; the model is shared
        self.words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # ids that end a word
        mark = getattr(self.full.model, "end_of_word_suffix", None) or "\0"
        self.last = np.zeros(self.full.get_vocab_size(), bool)
        self.last[[i for token, i in self.full.get_vocab(with_added_tokens=False).items() if token.endswith(mark)]] = True
        self.rest()

    def rest(self) -> None:
        """Give back the tables: the worker goes on to other work."""
        self.known: dict[str, bytes] = {}  # tails and pieces that are not plain
        self.known_words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def whole(self, text: str) -> bytes:
        return self._bytes(self.full.encode(text, add_special_tokens=False).ids)

    def _others(self, pieces: list[str]) -> list[bytes]:
        for p in pieces:
            if p not in self.known:
                self.known[p] = self.whole(p)
        return list(map(self.known.__getitem__, pieces))

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words; what an emptied table held counts as known once more when met again."""
        ids, older = self.known_words, self.older_words
        new = [w for w in words if w not in ids]
        if older:
            met = [w for w in new if w in older]
            ids.update(zip(met, map(older.__getitem__, met)))
            new = [w for w in new if w not in older]
        groups = [new[i:i + WORDS_PER_CALL] for i in range(0, len(new), WORDS_PER_CALL)]
        for group, e in zip(groups, self.words.encode_batch_fast(groups, is_pretokenized=True, add_special_tokens=False)):
            raw = self._bytes(e.ids)
            ends = ((np.flatnonzero(self.last[np.frombuffer(raw, self.dtype)]) + 1) * self.dtype.itemsize).tolist()
            if len(ends) == len(group):
                ids.update(zip(group, [raw[a:b] for a, b in zip([0, *ends], ends)]))
            else:  # a vocabulary whose words do not all end in a marked id
                ids.update((w, self._bytes(self.words.encode([w], is_pretokenized=True, add_special_tokens=False).ids)) for w in group)
        return list(map(ids.__getitem__, words))

    def _pieces(self, pieces: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of distinct pieces."""
        parts = pc.extract_regex(pieces, _PLAIN)  # null where a piece is not plain
        words = pc.utf8_lower(pc.struct_field(parts, "word")).dictionary_encode()
        tails = pc.struct_field(parts, "tail").dictionary_encode()
        plain = pc.binary_join_element_wise(
            pa.array(self._words(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices),
            pa.array(self._others(tails.dictionary.to_pylist()), pa.large_binary()).take(tails.indices), pa.scalar(b"", pa.large_binary()),
        )
        others = self._others(pieces.filter(plain.is_null()).to_pylist())
        return pc.replace_with_mask(plain, plain.is_null(), pa.array(others, pa.large_binary()))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > KEPT_PIECES:
            self.known = {}
        if len(self.known_words) > KEPT_WORDS:
            self.known_words, self.older_words = {}, self.known_words
        whole = {i for i, t in enumerate(texts) if any(map(t.__contains__, _ODD_SPACE))}
        split = pc.utf8_split_whitespace(pa.array(["" if i in whole else t for i, t in enumerate(texts)], pa.string()))
        met = split.flatten().dictionary_encode()
        ids = self._pieces(met.dictionary).take(met.indices)
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, np.int64, len(ids) + 1)[split.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        data = memoryview(data) if data else b""
        return [self.whole(t) if i in whole else bytes(data[a:b]) for i, (t, a, b) in enumerate(zip(texts, ends, ends[1:]))]


def encoder(path: str) -> Encoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return only_model(("encoder", path), lambda: Encoder(path))


def slices_of(column: pa.Array, most_chars: int = 4_000_000):
    """Consecutive texts of a column, with the place of the first; at most ``most_chars`` code points, or one text."""
    start, size, texts = 0, 0, []
    for i, t in enumerate(column):
        t = t.as_py()
        if texts and size + len(t) > most_chars:
            yield start, texts
            start, size, texts = i, 0, []
        texts.append(t)
        size += len(t)
    if texts:
        yield start, texts


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
