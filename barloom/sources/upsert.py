"""Keyed upsert as a join of the target with the newest source row per key."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.sources.schemas import PRICES

# Which columns a conflict replaces, per writer.
LIVE_UPDATES = ("exchange", *PRICES, "volume")
BACKFILL_UPDATES = (*PRICES, "volume")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    sequence: str | Sequence[str],
    touch: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """``target`` after all ``source`` rows arrived in ``sequence`` order.

    A new key inserts its first row; each later row for the key replaces
    ``update_cols`` only (NULLs replace too) and sets ``touch`` to ``now``.  Target
    columns the source lacks keep their value, or are NULL in new rows.
    """
    order = [sequence] if isinstance(sequence, str) else list(sequence)
    arrival = F.struct(*order)
    first_cols = [c for c in source.columns if c in target.columns and c not in keys]
    newest = source.groupBy(*keys).agg(
        F.max_by(F.struct(*update_cols), arrival).alias("_new"),
        F.min_by(F.struct(*first_cols), arrival).alias("_first"),
        (F.count(F.lit(1)) > 1).alias("_again"),
    )
    held = target.select(*keys, F.struct(*target.columns).alias("_old"))
    stamp = F.localtimestamp() if now is None else now
    is_new, is_hit = F.col("_old").isNull(), F.col("_new").isNotNull()

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        old = F.col(f"_old.{c}")
        if c == touch:
            inserted = F.col(f"_first.{c}") if c in first_cols else F.lit(None)
            return (
                F.when(is_new & ~F.col("_again"), inserted).when(is_hit, stamp).otherwise(old)
            ).cast(target.schema[c].dataType)
        if c in update_cols:
            return F.when(is_hit, F.col(f"_new.{c}")).otherwise(old)
        if c in first_cols:
            return F.when(is_new, F.col(f"_first.{c}")).otherwise(old)
        return old

    joined = held.join(newest, list(keys), "full_outer")
    return joined.select(*[value(c).alias(c) for c in target.columns])
