"""Fill-in-middle: a text is cut at two seeded places and its middle is moved to the end.

A text is n units, each white space with the word after it (white space that ends a text is a unit of its own).
``regexp_count`` gives n; two numbers of the document's hash give the cuts a <= b. A pattern made per
row, with possessive groups ``(unit{a}+)`` and ``(unit{b-a}+)`` and the rest, finds prefix, middle and suffix in one match,
and the replacement puts them in the order of the document's form. Possessive counted groups are matched in a
loop, without recursion or backtracking, so long texts need no deep stack.

All of it is column expressions over one row: no shuffle, no Python, any number of documents.

Defined cases: a null text counts as empty; an empty text, and one that holds a marker, stays ``plain`` (output is the
text, lengths are null); a null id counts as the empty text in the hash; repeated rows get the same cuts; input
columns with the names of added ones are hidden, as only ``keep`` columns are carried; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import text_or_empty

# White space of the units, markers, seed and shares of the forms in percent.
SPACE = r"\x20\x09-\x0D"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, MOVED, SUFFIX_FIRST = 42, 50, 80
PLAIN, SPM, PSM = "plain", "spm", "psm"

# Both classes are disjoint: taking all there is at once finds the same units as trying shorter runs.
UNIT = f"(?:[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++)"


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits as a number."""
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, keep: Sequence[str], doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
    moved: int = MOVED, suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """``_row`` (the ``keep`` columns) with n, form, prefix_chars, middle_chars and the rearranged ``output``.

    ``moved`` percent of the documents get their middle moved, ``suffix_first`` percent of these as ``spm``
    (suffix, prefix, middle), the others as ``psm`` (prefix, suffix, middle).
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    body, n = F.col("_text"), F.col("n")
    marked = F.contains(body, F.lit(PREFIX)) | F.contains(body, F.lit(SUFFIX)) | F.contains(body, F.lit(MIDDLE))
    cut = [_draw(F.col("_digest"), k) % (n + 1) for k in (1, 2)]
    plain = (body == "") | marked | (_draw(F.col("_digest"), 3) % 100 >= moved)
    form = F.when(plain, PLAIN).when(_draw(F.col("_digest"), 4) % 100 < suffix_first, SPM).otherwise(PSM)
    counted = docs.select(
        F.struct(*keep).alias("_row"), text_or_empty(text).alias("_text"), digest.alias("_digest")
    ).withColumn("n", F.regexp_count("_text", F.lit(UNIT)).cast("long"))
    placed = counted.select(
        "_row", "_text", "n", form.alias("form"), F.least(*cut).alias("_a"), F.greatest(*cut).alias("_b")
    )
    pattern = F.format_string(
        rf"\A({UNIT}{{%d}}+)({UNIT}{{%d}}+)((?s:.*+))\z", F.col("_a"), F.col("_b") - F.col("_a")
    )
    order = F.when(F.col("form") == SPM, f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    output = F.when(F.col("form") == PLAIN, body).otherwise(F.regexp_replace(body, pattern, order))
    done = placed.select("_row", "n", "form", output.alias("output"))
    prefix, middle, _ = _parts(F.col("output"), F.col("form"))
    return done.select(
        "_row", "n", "form", F.length(prefix).cast("long").alias("prefix_chars"),
        F.length(middle).cast("long").alias("middle_chars"), "output",
    )


def _parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of an output, null where it is plain.

    The text held no marker and a marker cannot begin inside another one, so each is found once.
    """
    after = F.substring_index(output, MIDDLE, -1)
    before = F.substring_index(output, MIDDLE, 1)
    second = F.when(form == SPM, PREFIX).when(form == PSM, SUFFIX)
    start = F.length(F.lit(PREFIX))
    at = F.position(second, before)
    first = F.substr(before, start + 1, at - start - 1)
    other = F.substr(before, at + start)
    return (
        F.when(form == SPM, other).when(form == PSM, first),
        F.when(form != PLAIN, after),
        F.when(form == SPM, first).when(form == PSM, other),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that gave ``output``."""
    prefix, middle, suffix = _parts(output, form)
    return F.when(form == PLAIN, output).otherwise(F.concat(prefix, middle, suffix))
