"""Exact de-duplication by distributed MSD radix partitioning.

Documents are split by their length and then by successive bytes of their text. A round takes the next bytes of every
open document (64 first, then 16 times as many each round), counts the documents of each
(group, bytes) pair and ends

* a document that is alone with its bytes: no other text equals it;
* a group whose bytes are fewer than the round asks for: its texts have ended and are equal.

All others form the groups of the next round. Bytes are compared themselves, so no digest decides
equality. The counts are combined before they are shuffled, and documents meet their group's row in a
plain join that adaptive execution can split: a group of copies may hold a third of all
rows. Texts are moved once to meet the first groups, and after that only the texts of groups that are still open. Groups get a new number in a written table, and each round is staged, so lost executors
cost a reread. The number of rounds is logarithmic in the longest text.

Defined cases: a null text counts as empty and equals other empty texts. Of a group the row with
the largest doc_id stays; null ids are smallest. Rows that repeat the same id and text are
separate members of their group, of which exactly one stays. An empty table gives no rows. Extra
columns are carried in one struct and cannot clash.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import stage, text_or_empty

FIRST_BYTES = 64
GROWTH = 16


def exact_groups(docs: DataFrame, first_bytes: int = FIRST_BYTES, growth: int = GROWTH, carry: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row; ``carry`` adds the row as struct ``doc``."""
    text = text_or_empty()
    columns = [F.col("doc_id"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias("text_sha256")]
    if carry:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"], F.col("text")).alias("doc"))
    kept_columns = ["doc_id", "text_sha256"] + (["doc"] if carry else [])
    opened = docs.select(*columns, F.octet_length(text).cast("long").alias("gid"))  # the first split is by length
    finished, depth, width, level = [], 0, first_bytes, 0
    while True:
        step, finished_here = _round(opened, kept_columns, depth, width, level, carry)
        finished.append(finished_here)
        opened = step
        if opened.isEmpty():
            break
        depth, width, level = depth + width, width * growth, level + 1
    rows = reduce(DataFrame.unionByName, finished)
    return _with_kept(rows, kept_columns)


def _round(opened, kept_columns, depth, width, level, carry):
    chunk = F.substring(F.col("text").cast("binary"), depth + 1, width)
    keyed = opened.withColumn("chunk", chunk)
    groups = stage(
        keyed.groupBy("gid", "chunk")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top"))
        .where("n > 1")
        .withColumn("next_gid", F.monotonically_increasing_id()),
        f"radix-groups-{level}",
    )
    ended = F.col("n").isNull() | (F.octet_length("chunk") < width)
    met = stage(
        keyed.join(groups.hint("merge"), ["gid", "chunk"], "left").select(
            *kept_columns, "n", "top", F.col("next_gid").alias("gid"), F.lit(level).alias("level"),
            F.when(~ended, F.col("text")).alias("text"), (~ended).cast("int").alias("is_open"),
        ),
        f"radix-round-{level}", ["is_open"],
    )
    opened = met.where("is_open = 1").select(*kept_columns, "text", "gid")
    return opened, met.where("is_open = 0").select(*kept_columns, "n", "top", "gid", "level")


def _with_kept(rows, kept_columns):
    """Mark the row that stays; a window is needed only among rows that share the largest id."""
    out = [*kept_columns, "keep_id", "group_size", "kept"]
    is_top = F.col("doc_id").eqNullSafe(F.col("top"))
    alone = rows.where(F.col("n").isNull()).select(
        *kept_columns, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
    )
    copies = rows.where(F.col("n").isNotNull()).withColumns({"keep_id": F.col("top"), "group_size": F.col("n")})
    turn = F.row_number().over(Window.partitionBy("level", "gid").orderBy("text_sha256"))
    tops = copies.where(is_top).withColumn("kept", turn == 1).select(*out)
    others = copies.where(~is_top).withColumn("kept", F.lit(False)).select(*out)
    return alone.select(*out).unionByName(tops).unionByName(others)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns as they were."""
    kept = exact_groups(docs, carry=True).where("kept").select("doc.*")
    return kept.select(*[f"`{c}`" for c in docs.columns])
