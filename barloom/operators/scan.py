"""Running totals, peaks and last values in two levels.

Each series is cut into time slices.  A slice is scanned on its own; what must be
carried in from earlier slices comes from a table with one row per slice.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.series import SLICE, SLICE_INTRADAY, time_slice


def running_equity(
    df: DataFrame, by: str, ts: str, gain: str, slice_seconds: int = SLICE_INTRADAY
) -> DataFrame:
    """Add ``equity`` (running sum of ``gain``) and ``peak`` (running maximum of equity, at least 0)."""
    keyed = df.withColumn(SLICE, time_slice(F.col(ts), slice_seconds))
    here = Window.partitionBy(by, SLICE).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    local = keyed.withColumn("_sum", F.sum(gain).over(here)).withColumn("_top", F.max("_sum").over(here))
    per_slice = local.groupBy(by, SLICE).agg(F.sum(gain).alias("_total"), F.max("_sum").alias("_best"))
    before = Window.partitionBy(by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        per_slice.withColumn("_base", F.coalesce(F.sum("_total").over(before), F.lit(0.0)))
        .withColumn("_peak", F.coalesce(F.max(F.col("_base") + F.col("_best")).over(before), F.lit(0.0)))
        .select(by, SLICE, "_base", "_peak")
    )
    return (
        local.join(carried, [by, SLICE])
        .withColumns(
            {
                "equity": F.col("_base") + F.col("_sum"),
                "peak": F.greatest(F.col("_peak"), F.col("_base") + F.col("_top"), F.lit(0.0)),
            }
        )
        .drop("_sum", "_top", "_base", "_peak", SLICE)
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    ts: str,
    values: Sequence[str],
    strict: bool = True,
    slice_seconds: int = SLICE_INTRADAY,
) -> DataFrame:
    """Left join each row to the newest ``right`` row of the same ``by`` before its time.

    ``strict`` asks for strictly before, otherwise at or before.  Right rows must be
    unique on (by, ts).
    """
    packed = F.struct(*[F.col(v) for v in values])
    old = left.columns
    both = left.select(by, ts, F.struct(*old).alias("_row"), F.lit(1).alias("_side")).unionByName(
        right.select(by, ts, packed.alias("_hit"), F.lit(2 if strict else 0).alias("_side")),
        allowMissingColumns=True,
    ).withColumn(SLICE, time_slice(F.col(ts), slice_seconds))
    here = Window.partitionBy(by, SLICE).orderBy(ts, "_side").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy(by, SLICE)
        .agg(F.max_by("_hit", F.when(F.col("_hit").isNotNull(), F.col(ts))).alias("_last"))
        .select(by, SLICE, F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    )
    found = (
        both.withColumn("_here", F.last("_hit", ignorenulls=True).over(here))
        .where(F.col("_side") == 1)
        .join(carried, [by, SLICE])
        .withColumn("_found", F.coalesce("_here", "_carried"))
    )
    return found.select(
        *[F.col(f"_row.{c}").alias(c) for c in old], *[F.col(f"_found.{v}").alias(v) for v in values]
    )


def _fixed_bounds(df: DataFrame, order: str, quantiles: Sequence[float]) -> Column:
    """Approximate quantiles as a literal array.

    They are taken once: a second evaluation may differ on large data, and the ranges of
    two plan branches must agree.  At most ``len(quantiles)`` values pass the driver, as
    text, which keeps doubles and times exact.
    """
    kind = df.schema[order].dataType.simpleString()
    found = df.select(F.percentile_approx(order, list(quantiles)).cast("array<string>")).first()[0]
    if found is None:
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit("|".join(found)), "[|]").cast(f"array<{kind}>")


def _count_below(bounds: Column, value: Column, n_bounds: int) -> Column:
    """How many of the ascending ``bounds`` are below ``value``, by binary search in the row."""
    steps = [1 << k for k in reversed(range(n_bounds.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda found, step: F.when(F.get(bounds, found + step - 1) < value, found + step).otherwise(found),
    )


def ordered_prefix(
    df: DataFrame, order: str, sums: Mapping[str, Column], cuts: int | None = None, by: str | None = None
) -> DataFrame:
    """Totals per distinct ``order`` value with the totals of all smaller values, in each group of ``by`` or over all rows.

    For each ``name -> column``: ``name`` is its sum at that value, ``name_below`` the sum
    over smaller values and ``name_total`` the sum over all.  Ordering is global, so
    instead of one sorted task the distinct values are spread over ranges between
    approximate quantiles of their group; only the range totals (at most ``cuts`` rows a group, by default twice the shuffle
    partitions) are summed in one place.  ``by`` must hold few values, such as feature names: their quantiles pass the driver.
    """
    cuts = cuts or max(16, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    groups = [by] if by else []
    at_value = df.groupBy(*groups, order).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    quantiles = [i / cuts for i in range(1, cuts)]
    if by:
        placed = at_value.join(F.broadcast(_bounds_by(at_value, by, order, quantiles)), F.equal_null(at_value[by], F.col("_group"))).withColumn(
            "_range", _count_below(F.col("_bounds"), F.col(order), len(quantiles))).drop("_group", "_bounds")
    else:
        placed = at_value.withColumn(
            "_range", _count_below(_fixed_bounds(at_value, order, quantiles), F.col(order), len(quantiles)))
    ranges = placed.groupBy(*groups, "_range").agg(*[F.sum(n).alias(n) for n in sums])
    along = Window.partitionBy(*groups).orderBy("_range")
    below = along.rowsBetween(Window.unboundedPreceding, -1)
    everything = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    range_base = ranges.select(
        *[F.col(g).alias("_group") for g in groups], F.col("_range").alias("_at"),
        *[F.coalesce(F.sum(n).over(below), F.lit(0)).alias(f"_base_{n}") for n in sums],
        *[F.sum(n).over(everything).alias(f"{n}_total") for n in sums],
    )
    inside = Window.partitionBy(*groups, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    here = F.col("_range") == F.col("_at")
    if by:
        here = here & F.equal_null(F.col(by), F.col("_group"))
    return (
        placed.withColumns({f"_in_{n}": F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in sums})
        .join(F.broadcast(range_base), here)
        .select(
            *groups, order, *sums,
            *[(F.col(f"_base_{n}") + F.col(f"_in_{n}")).alias(f"{n}_below") for n in sums],
            *[f"{n}_total" for n in sums],
        )
    )


def _bounds_by(df: DataFrame, by: str, order: str, quantiles: Sequence[float]) -> DataFrame:
    """Approximate quantiles per group, taken once like :func:`_fixed_bounds`."""
    kind, group = df.schema[order].dataType.simpleString(), df.schema[by].dataType.simpleString()
    found = df.groupBy(by).agg(F.percentile_approx(order, list(quantiles)).cast("array<string>")).collect()
    rows = df.sparkSession.createDataFrame([tuple(r) for r in found], f"_group {group}, _bounds array<string>")
    return rows.select("_group", F.col("_bounds").cast(f"array<{kind}>").alias("_bounds"))
