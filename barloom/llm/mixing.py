"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Every source has a weight; targets share the total size in proportion to it, but no source is
repeated more than ``max_epochs`` times. Sources above their cap are clamped to it and the excess
goes to the others by weight, until no target is above its cap. The targets are then reached by
whole repetitions of every document and, for the rest, by one more repetition of a seeded sample:
documents stand in the order of a seeded hash, and those whose middle lies before the cut are taken
again, so a source misses its target by half a document at most.

Running sums within a source are cut into ranges of the hash: totals per (source, range) are
combined before the shuffle, and only their running sum goes by source. A source that holds a
third of all rows is spread over ranges of a few thousand rows each. The number of
ranges changes no result. Sources are numbered through a global sort; water-filling
reads one row per source and brings two sums to the driver per pass.

Defined cases: a null text has size 0, a null source is a source of its own and comes last, a null
doc_id hashes as the empty text. Rows that repeat are documents of their own. An empty table gives no
rows; a source of size 0 has target 0. Extra columns are carried in one struct; columns that
clash with an added one are replaced by it.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import first_n_rank, stage

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 7
RANGE_ROWS = 2_048
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key without nulls in the order of sources: by code point, null last."""
    return F.concat(F.when(source.isNull(), "1").otherwise("0"), F.coalesce(source.cast("string"), F.lit("")))


def water_fill(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``target`` for each row (source key, source_size); weights repeat along the order of the keys."""
    ranked = first_n_rank(sizes, [F.col("source")], "rank", "mix-sources")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = ranked.withColumns({"weight": weight, "cap": F.col("source_size") * max_epochs})
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = 0.0, -1
    while True:  # the level only rises, so a clamped source stays clamped
        over = F.col("weight") * F.lit(level) > F.col("cap")
        n, capped, free = weighted.agg(
            F.count_if(over), F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if n == clamped or not free:
            break
        level, clamped = (total - (capped or 0)) / free, n
    level = F.lit(level)
    target = F.when(F.col("weight") * level > F.col("cap"), F.col("cap").cast("double")).otherwise(F.col("weight") * level)
    return weighted.select("source", "source_size", F.round(target, 6).alias("target"))


def mix(
    docs: DataFrame, carried: Sequence[str], weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
    seed: int = SEED, range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """The ``carried`` columns of every row with size, source_size, target, copies and taken."""
    added = ("size", "source_size", "target", "copies", "taken")
    spans = 1 << max(0, (docs.count() - 1) // range_rows).bit_length()
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried if c not in added]).alias("doc"),
        source_key(F.col("source")).alias("source"), word_count(F.col("text")).alias("size"), mark.alias("mark"),
    ).withColumn("span", F.shiftright(F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") * spans, 32))
    ranges = stage(rows.groupBy("source", "span").agg(F.sum("size").alias("span_size")), "mix-ranges")
    targets = water_fill(ranges.groupBy("source").agg(F.sum("span_size").alias("source_size")), weights, max_epochs)
    earlier = F.sum("span_size").over(
        Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, 0)
    ) - F.col("span_size")
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("long")
    plan = ranges.withColumn("before", earlier).join(targets, "source").select(
        "source", "span", "before", "source_size", "target", whole.alias("whole")
    )
    met = rows.join(plan, ["source", "span"])
    order = Window.partitionBy("source", "span").orderBy("mark", "size").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("before") + F.sum("size").over(order) - F.col("size")
    cut = F.col("target") - F.col("whole") * F.col("source_size")
    copies = F.col("whole") + (start * 2 + F.col("size") < cut * 2).cast("long")
    return met.withColumn("copies", copies).select(
        "doc.*", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all its columns.

    A text without words counts nothing towards a target and comes as often as its source is repeated whole.
    """
    mixed = mix(docs.select(F.struct("*").alias("all"), "doc_id", "source", "text"), ["all"])
    times = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mixed.where("copies > 0").select("all", F.explode(times).alias("turn")).select("all.*")
