"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled text. A document is parsed into the
longest matches with each language's text; a language needs the fewer phrases the more the
document resembles it. Phrases are normalised by what each costs to name in its text, log2 of the text's
length, and the language with the least total wins.

Model: per language at most ``train_chars`` code points (a documented bound) of the training
documents, stretches of distinct texts at a place that a hash chooses, taken in the order of a hash of the text: copies count
once, and the sample is the same at every run. Parsing:
transitions and phrase ends are folded into one table per language, and a batch of texts walks through it
in step, one column per block of ``BLOCK`` code points. Texts are lower-cased and what is no letter or mark
counts as one space, so digits and symbols tell nothing; a phrase ends at a block's end, for every
language alike. Whole texts are parsed; batches are cut by size, so memory is bounded.

Defined cases: null and letterless texts give ``und`` with score 0. Score is the winner's margin over the
next language, 1 - best / second, and 1 where only one language was learned; ties go to the language
first by code point. Without any training text every document is ``und``. Rows are judged one by one, so
repeated rows and hot sources change nothing; extra columns are not read. Shuffles: hashes of the labelled texts
and the sample; documents are not moved.
"""
from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import only_model, text_or_empty

TRAIN_CHARS = 32_768  # code points of labelled text per language
ROWS_PER_LANGUAGE = 64  # distinct texts asked for per language, at most twice as many; each gives train_chars / 16 code points at most
BLOCK = 512  # code points parsed as one lane
LANES = 8_192  # lanes walked in step
UNKNOWN = "und"


def training_text(
    docs: DataFrame, trained: Column, train_chars: int = TRAIN_CHARS, rows: int = ROWS_PER_LANGUAGE
) -> dict[str, str]:
    """Per language a bounded sample of its labelled text, in a fixed pseudo-random order."""
    labelled = docs.where(trained & F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text"))
    piece = max(1, train_chars // 16)
    marked = labelled.withColumn("mark", F.xxhash64("text"))
    counts = {r["lang"]: r["n"] for r in marked.select("lang", "mark").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    # a distinct text is asked for with the chance that gives ``rows`` of its language, twice as many to be safe
    chance = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, 2 * rows / n)))])
    draw = F.shiftrightunsigned("mark", 11) / float(1 << 53)
    spare = F.greatest(F.length("text") - piece + 1, F.lit(1)).cast("long")  # places where the stretch can begin
    begin = (F.pmod(F.xxhash64("mark", F.lit(1)), spare) + 1).cast("int")
    picked = (
        marked.where(draw < F.element_at(chance, F.col("lang")))
        .select("lang", "mark", F.substr("text", begin, F.lit(piece)).alias("text")).dropDuplicates(["lang", "mark"])
        .withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy(draw, "text"))).where(F.col("turn") <= 2 * rows)
    )
    texts: dict[str, str] = {}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["turn"])):
        have = texts.get(r["lang"], "")
        texts[r["lang"]] = (have + letters_only(r["text"]) + " ")[:train_chars]
    return {lang: t for lang, t in texts.items() if any(c.isalpha() for c in t)}


def _is_letter(c: str) -> bool:
    return unicodedata.category(c)[0] in "LM"


def letters_only(text: str) -> str:
    """Lower-case letters and marks; every run of other characters is one space."""
    return re.sub(" +", " ", "".join(c if _is_letter(c) else " " for c in text.lower()))


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the start."""
    edges: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return edges


class CrossParser:
    """Phrases that each language's text needs for a batch of texts."""

    def __init__(self, texts: tuple[tuple[str, str], ...]):
        self.languages = [lang for lang, _ in texts]
        self.phrase_bits = np.array([math.log2(len(t) + 1) for _, t in texts])
        alphabet = sorted({c for _, t in texts for c in t} | {" "})  # the space comes first
        # code 0 pads, 1 is any letter unseen in training, 2 is all that is no letter
        self.codes = np.array([1 if _is_letter(chr(i)) else 2 for i in range(0x110000)], np.uint8 if len(alphabet) < 254 else np.uint32)
        for i, c in enumerate(alphabet):
            self.codes[ord(c)] = i + 2
        self.width = len(alphabet) + 2
        self.tables = [self._table(t, alphabet) for _, t in texts]

    def _table(self, text: str, alphabet: list[str]) -> np.ndarray:
        """Flat table: entry = first cell of the next state * 4 + phrases that end on the way."""
        edges = suffix_automaton(text)
        start = np.zeros(self.width, np.int64)
        start_cost = np.ones(self.width, np.int64)  # an unseen character is a phrase of its own
        for c, s in edges[0].items():
            i = alphabet.index(c) + 2
            start[i], start_cost[i] = s, 0
        state = np.tile(start, (len(edges), 1))
        cost = np.tile(start_cost + 1, (len(edges), 1))  # the phrase under way ends, then the start takes the character
        cost[0] = start_cost
        position = {c: i + 2 for i, c in enumerate(alphabet)}
        for s, out in enumerate(edges):
            for c, t in out.items():
                state[s, position[c]], cost[s, position[c]] = t, 0
        state[:, 0], cost[:, 0] = np.arange(len(edges)), 0
        return ((state * self.width) << 2 | cost).astype(np.int32 if state.size * self.width < 2**29 else np.int64).ravel()

    def phrases(self, lanes: np.ndarray) -> np.ndarray:
        """Phrase counts (languages x lanes) of the columns of ``lanes``, padded with code 0."""
        out = np.empty((len(self.tables), lanes.shape[1]), np.int64)
        for k, table in enumerate(self.tables):
            at = np.zeros(lanes.shape[1], table.dtype)
            count = np.zeros(lanes.shape[1], np.int32)
            for row in lanes:
                step = table[at + row]
                count += step & 3
                at = step >> 2
            out[k] = count + (at != 0)  # the phrase under way counts
        return out

    def lanes(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of the texts as columns, with the text each column belongs to; bounded pieces."""
        codes, owners = [], []
        for i, text in enumerate(texts):
            points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            coded = self.codes[points]
            gap = coded == 2
            coded = coded[~(gap & np.append(gap[1:], False))]
            whole = len(coded) // BLOCK
            if whole:
                codes.extend(coded[: whole * BLOCK].reshape(whole, BLOCK))
                owners.extend([i] * whole)
            if len(coded) % BLOCK:
                tail = np.zeros(BLOCK, self.codes.dtype)
                tail[: len(coded) % BLOCK] = coded[whole * BLOCK:]
                codes.append(tail)
                owners.append(i)
            while len(codes) >= LANES:
                yield np.ascontiguousarray(np.stack(codes[:LANES]).T), np.array(owners[:LANES])
                codes, owners = codes[LANES:], owners[LANES:]
        if codes:
            yield np.ascontiguousarray(np.stack(codes).T), np.array(owners)

    def judge(self, texts: list[str]) -> tuple[list[str], list[float]]:
        total = np.zeros((len(self.tables), len(texts)))
        for lanes, owners in self.lanes(texts):
            for k, counts in enumerate(self.phrases(lanes)):
                total[k] += np.bincount(owners, counts, len(texts))
        bits = total * self.phrase_bits[:, None]
        best = bits.argmin(0)
        least = bits.min(0)
        if len(bits) > 1:
            second = np.partition(bits, 1, axis=0)[1]
            score = 1 - least / np.maximum(second, 1e-9)
        else:
            score = np.ones(len(texts))
        wordless = np.array([not any(map(str.isalpha, t)) for t in texts], bool)
        langs = [UNKNOWN if w else self.languages[b] for w, b in zip(wordless, best)]
        return langs, np.where(wordless, 0.0, np.clip(score, 0, 1)).tolist()


def predict(docs: DataFrame, model: dict[str, str], carried: list[str]) -> DataFrame:
    """The ``carried`` columns of every row with lang_pred and score; only ``text`` decides."""
    texts = tuple(sorted(model.items()))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = only_model(("languages", texts), lambda: CrossParser(texts)) if texts else None
        for batch in batches:
            rows = [t or "" for t in batch.column("_text").to_pylist()]
            langs, scores = parser.judge(rows) if parser and rows else ([UNKNOWN] * len(rows), [0.0] * len(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["_row", "lang_pred", "score"]
            )

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_row"), text_or_empty().alias("_text"))
    schema = rows.select("_row").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(judged, schema)
