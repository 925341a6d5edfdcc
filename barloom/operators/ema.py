"""Exponential moving averages of whole series, with window functions only.

Between two values of a series, k rows apart, the average follows an affine map. For the plain form (the recurrence starts at
the first value) it is ``y' = (q^k y + a x) / (q^k + a)`` with ``a = 2 / (span + 1)`` and ``q = 1 - a``; the adjusted form
divides a weighted sum ``N' = q^k N + x`` by the sum of weights ``D' = q^k D + 1``. A missing value (NULL or NaN) repeats the
average and ages what came before.

Maps compose, so a series is cut into blocks of a slice and each block becomes one row, (factor, offset) of all its maps.
:func:`carried` composes these rows along the series and gives each block the state it starts from; :func:`finished` puts that
into the rows. No halo is needed, and any span gives exact results, as nothing is cut off.

Factors are kept as logarithms; a scan divides by them only within groups whose factors stay far from underflow.
"""
from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1_024
_SMALL = 300.0  # e^-300 is far from underflow, and nothing beside 1
_BLOCK, _X, _PREV, _FIRST, _LAST, _CARRY = "_ema_block", "_ema_x", "_ema_prev", "_ema_first", "_ema_last", "_ema_carry"


@dataclass(frozen=True)
class Ema:
    """Averages of the column ``value``, one per entry of ``spans`` (column name: span); ``adjust`` divides by the sum of weights."""

    value: str
    spans: Mapping[str, int]
    adjust: bool = False

    def __post_init__(self):
        if not self.spans or min(self.spans.values()) < 1:
            raise ValueError("an average needs spans of at least one row")

    def alpha(self, name: str) -> float:
        return 2.0 / (self.spans[name] + 1.0)

    def decay(self, name: str) -> float:
        # a span of one row forgets all but the last value
        return max(1.0 - self.alpha(name), 1e-17)

    @property
    def channels(self) -> list[tuple[str, str]]:
        """Running sums: (column name, kind)."""
        kinds = ("n", "d") if self.adjust else ("y",)
        return [(name, kind) for name in self.spans for kind in kinds]

    @property
    def block_rows(self) -> int:
        """Largest power of two up to BLOCK_ROWS whose decay stays within e^-300."""
        steepest = max(-math.log(self.decay(n)) for n in self.spans)
        rows = BLOCK_ROWS
        while rows > 1 and rows * steepest > _SMALL:
            rows //= 2
        return rows

    def damping(self, name: str, k: Column) -> Column:
        """What q^k is divided by in a step over k rows: 1 but for the plain form after missing values."""
        if self.adjust:
            return F.lit(1.0)
        return F.when(k == 1, 1.0).otherwise(F.pow(F.lit(self.decay(name)), k) + self.alpha(name))

    def offset(self, name: str, kind: str, x: Column, k: Column) -> Column:
        """What a value adds k rows after the one before (k NULL: there is none)."""
        if kind == "d":
            return F.lit(1.0)
        if kind == "n":
            return x
        return F.when(k.isNull(), x).otherwise(x * self.alpha(name) / self.damping(name, k))


def scanned(ranked: DataFrame, series: tuple[str, str], rank: str, ema: Ema) -> DataFrame:
    """Add the block of each row and its running sums from the block's first value on.

    ``series`` names symbol and slice, ``rank`` the position in the slice from 1 on. The columns belong to the last value up
    to the row, so rows without a value repeat them.
    """
    block = F.floor((F.col(rank) - 1) / F.lit(ema.block_rows)).cast("int")
    value = F.col(ema.value).cast("double")
    df = ranked.withColumns({_BLOCK: block, _X: F.when(~F.isnan(value), value)})
    here = Window.partitionBy(*series, _BLOCK).orderBy(rank)
    until, before = here.rowsBetween(Window.unboundedPreceding, 0), here.rowsBetween(Window.unboundedPreceding, -1)
    place = F.when(F.col(_X).isNotNull(), F.col(rank))
    df = df.withColumns({
        _PREV: F.last(place, ignorenulls=True).over(before),
        _FIRST: F.first(place, ignorenulls=True).over(until),
        _LAST: F.last(place, ignorenulls=True).over(until),
    })
    k = F.col(rank) - F.col(_PREV)
    follows = F.col(_X).isNotNull() & F.col(_PREV).isNotNull()
    if not ema.adjust:
        df = df.withColumns({
            f"_damped_{name}": F.sum(F.when(follows & (k > 1), F.log(ema.damping(name, k))).otherwise(0.0)).over(until)
            for name in ema.spans
        })
    sums = {}
    for name, kind in ema.channels:
        factor = _factor(ema, name)
        added = F.when(follows, ema.offset(name, kind, F.col(_X), k) / factor).otherwise(0.0)
        sums[f"_sum_{kind}_{name}"] = F.sum(added).over(until) * factor
    return df.withColumns(sums)


def _factor(ema: Ema, name: str) -> Column:
    """Factor from the block's first value to the last one up to the row."""
    aged = F.pow(F.lit(ema.decay(name)), F.col(_LAST) - F.col(_FIRST))
    return aged if ema.adjust else aged * F.exp(-F.col(f"_damped_{name}"))


def block_facts(df: DataFrame, series: tuple[str, str], rank: str, ema: Ema) -> DataFrame:
    """One row per block of a scanned frame: rows, places of the first and last value, the first value, sums at the end."""
    ends = [f"_sum_{kind}_{name}" for name, kind in ema.channels]
    if not ema.adjust:
        ends += [f"_damped_{name}" for name in ema.spans]
    place = F.when(F.col(_X).isNotNull(), F.col(rank))
    return df.groupBy(*series, _BLOCK).agg(
        F.count(F.lit(1)).alias("_n"), F.min(place).alias(_FIRST), F.max(place).alias(_LAST),
        F.min_by(_X, place).alias(_X), F.max_by(F.struct(*ends), rank).alias("_end"),
    ).select(*series, _BLOCK, "_n", _FIRST, _LAST, _X, "_end.*")


def carried(facts: DataFrame, series: tuple[str, str], ema: Ema) -> DataFrame:
    """One row per (symbol, slice) with an array, by block and running sum: rows before the slice, and the sum before and after
    the block's first value. All sums share the windows, as rows of their own."""
    symbol, slice_ = series
    before = Window.partitionBy(symbol).orderBy(slice_, _BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    # rows before the slice: places count from its first row on
    earlier_rows = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col(_BLOCK) * ema.block_rows
    df = facts.withColumn("_before", earlier_rows)
    last = F.last(F.col("_before") + F.col(_LAST), ignorenulls=True).over(before)
    df = df.withColumn("_k", F.col("_before") + F.col(_FIRST) - last)
    k, x, empty = F.col("_k"), F.col(_X), F.col(_FIRST).isNull()
    sums = []
    for place, (name, kind) in enumerate(ema.channels):
        ln_q = math.log(ema.decay(name))
        first = F.coalesce(k * ln_q - F.log(ema.damping(name, k)), F.lit(0.0))
        inside = (F.col(_LAST) - F.col(_FIRST)) * ln_q - (F.lit(0.0) if ema.adjust else F.col(f"_damped_{name}"))
        at_first = ema.offset(name, kind, x, k)
        sums.append(F.struct(
            F.lit(place).alias("sum"), first.alias("first"), at_first.alias("at_first"),
            F.when(empty, 0.0).otherwise(first + inside).alias("log"),
            F.when(empty, 0.0).otherwise(F.exp(inside) * at_first + F.col(f"_sum_{kind}_{name}")).alias("offset"),
        ))
    df = df.select(symbol, slice_, _BLOCK, "_before", last.isNotNull().alias("_known"), F.array(*sums).alias("_sums"))
    df = df.select(symbol, slice_, _BLOCK, "_before", "_known", F.inline("_sums"))
    along = Window.partitionBy(symbol, "sum").orderBy(slice_, _BLOCK).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("log", F.sum("log").over(along))
    df = df.withColumn("group", F.floor(-F.col("log") / _SMALL).cast("long"))
    in_group = F.col("log") + F.col("group") * _SMALL
    scan = Window.partitionBy(symbol, "sum", "group").orderBy(slice_, _BLOCK).rowsBetween(Window.unboundedPreceding, 0)
    by_group = Window.partitionBy(symbol, "sum").orderBy("group").rangeBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("total", F.exp(in_group) * F.sum(F.col("offset") * F.exp(-in_group)).over(scan))
    # Groups before the last one weigh less than e^-300.
    df = df.withColumn("tail", F.max_by(F.struct("total", "log"), F.struct(slice_, _BLOCK)).over(by_group))
    total = F.col("total") + F.coalesce(F.exp(F.col("log") - F.col("tail.log")) * F.col("tail.total"), F.lit(0.0))
    # groups rise along the series, so the order of the scan is kept
    before = F.lag(total).over(Window.partitionBy(symbol, "sum").orderBy("group", slice_, _BLOCK))
    df = df.withColumn("y", F.when(F.col("_known"), before))
    start = F.coalesce(F.exp("first") * F.col("y"), F.lit(0.0)) + F.col("at_first")
    state = F.struct(_BLOCK, "sum", "_before", "y", start.alias("start"))
    return df.groupBy(symbol, slice_).agg(F.array_sort(F.collect_list(state)).alias(_CARRY))


def finished(df: DataFrame, ema: Ema) -> DataFrame:
    """A scanned frame joined to its carried sums: the averages, and ``_before`` (rows before the slice)."""
    seen = F.col(_LAST).isNotNull()
    running = {}
    for place, (name, kind) in enumerate(ema.channels):
        state = F.get(_CARRY, F.col(_BLOCK) * len(ema.channels) + place)
        running[name, kind] = F.when(
            seen, state["start"] * _factor(ema, name) + F.col(f"_sum_{kind}_{name}")).otherwise(state["y"])
    done = {}
    for name in ema.spans:
        if ema.adjust:  # no value yet: no weight
            done[name] = F.try_divide(running[name, "n"], running[name, "d"])
        else:
            done[name] = running[name, "y"]
    done["_before"] = F.get(_CARRY, F.lit(0))["_before"]
    helpers = [f"_sum_{kind}_{name}" for name, kind in ema.channels] + [f"_damped_{name}" for name in ema.spans]
    return df.withColumns(done).drop(_BLOCK, _X, _PREV, _FIRST, _LAST, _CARRY, *helpers)
