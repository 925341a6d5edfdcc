"""Data quality, the feature contract, leakage audit and feature profiles."""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.scan import ordered_prefix
from barloom.sources import schemas

SKETCH_K = 800  # size of a quantile sketch: rank errors of about 0.4 %
CHANCES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
NOT_INPUTS = ("symbol", "event_time", *schemas.FORWARD_LOOKING)


def feature_columns(df: DataFrame) -> list[str]:
    """Allow-list of model inputs: everything but keys and forward-looking columns."""
    return [c for c in df.columns if c not in NOT_INPUTS]


def feature_contract(df: DataFrame, label: str = "target_direction") -> DataFrame:
    """Keys, safe inputs and the label; every other forward-looking column is gone."""
    return df.select("symbol", "event_time", *feature_columns(df), label)


def quality_report(
    df: DataFrame, by: str = "symbol", ts: str = "event_time", label: str | None = "target_direction"
) -> DataFrame:
    """Per symbol: rows, time range, duplicate keys, NULLs per column, class balance.

    Counts merge before the shuffle; only the duplicate check moves a row per key, and
    it moves the key alone.
    """
    aggs = [
        F.count(F.lit(1)).alias("row_count"),
        F.min(ts).alias("first_time"),
        F.max(ts).alias("last_time"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns if c not in (by, ts)],
    ]
    if label is not None:
        aggs += [
            F.count_if(F.col(label) == 1).alias("n_up"),
            F.round(F.avg(F.col(label).cast("double")), 4).alias("up_share"),
        ]
    per_key = df.groupBy(by, ts).agg(F.count(F.lit(1)).alias("_n"))
    repeated = per_key.groupBy(by).agg(F.sum(F.col("_n") - 1).alias("duplicate_keys"))
    return df.groupBy(by).agg(*aggs).join(repeated, by)


def leakage_audit(
    build: Callable[[DataFrame], DataFrame], bars: DataFrame, cut: Column, ts: str = "event_time"
) -> DataFrame:
    """Which columns of ``build`` change in rows up to ``cut`` when later bars are removed.

    One row per column: rows compared, rows that changed, and the verdict.
    """
    full = build(bars).where(F.col(ts) <= cut)
    truncated = build(bars.where(F.col(ts) <= cut))
    cols = [c for c in full.columns if c not in ("symbol", ts)]
    pairs = full.select("symbol", ts, F.struct(*cols).alias("a"), F.lit(True).alias("_in_a")).join(
        truncated.select("symbol", ts, F.struct(*cols).alias("b"), F.lit(True).alias("_in_b")),
        ["symbol", ts], "full_outer",
    )
    changed = [
        F.count_if(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) | F.col("_in_a").isNull() | F.col("_in_b").isNull())
        .alias(c) for c in cols
    ]
    one_row = pairs.agg(F.count(F.lit(1)).alias("rows_compared"), *changed)
    listed = ", ".join(f"'{c}', `{c}`" for c in cols)
    return one_row.selectExpr(
        "rows_compared", f"stack({len(cols)}, {listed}) AS (column_name, rows_changed)"
    ).withColumn("looks_forward", F.col("rows_changed") > 0)


def feature_profile(df: DataFrame, columns: Sequence[str], label: str = "target_direction") -> DataFrame:
    """One row per feature: counts, moments, range, correlation with the label, warnings."""
    y = F.col(label).cast("double")
    fields = []
    for c in columns:
        x = F.col(c).cast("double")
        fields.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.count(x).alias("n"),
                F.count_if(x.isNull()).alias("n_null"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("stddev"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
                F.corr(x, y).alias("label_corr"),
            )
        )
    wide = df.agg(F.count(F.lit(1)).alias("total"), F.array(*fields).alias("profiles"))
    return (
        wide.select("total", F.explode("profiles").alias("p")).select("p.*", "total")
        .withColumns(
            {
                "is_constant": F.coalesce(F.col("min") == F.col("max"), F.lit(True)),
                "mostly_null": F.col("n_null") * 2 > F.col("total"),
            }
        )
        .drop("total")
    )


def feature_histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width counts per feature between its minimum and maximum."""
    ranges = unpivot(df.agg(*[_range(c).alias(c) for c in columns]), columns, "r")
    values = unpivot(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns, "value")
    placed = values.where(F.col("value").isNotNull()).join(F.broadcast(ranges), "feature")
    return placed.groupBy("feature", bin_of(F.col("value"), F.col("r"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _range(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))


def bin_of(value: Column, rng: Column, bins: int) -> Column:
    """0 .. bins-1 inside the range, clamped at its ends; a range of one value is bin 0."""
    width = rng["hi"] - rng["lo"]
    raw = F.floor(F.try_divide(value - rng["lo"], width) * F.lit(float(bins))).cast("int")
    return F.greatest(F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)), F.lit(0))


def unpivot(df: DataFrame, columns: Sequence[str], value: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.unpivot(list(keep), list(columns), "feature", value)


def correlation_matrix(df: DataFrame, columns: Sequence[str], redundant_from: float = 0.95) -> DataFrame:
    """Pearson correlation of each feature pair over rows where both are present, and whether one is redundant.

    Tasks reduce their rows to one set of pair sums, so the shuffle carries a fixed
    number of rows per task whatever the table size. Values are taken relative to the mean and
    deviation of their column, found first, so that large values do not cancel.
    """
    cols = list(columns)
    p = len(cols)
    left, right = (a.ravel() for a in np.meshgrid(np.arange(p), np.arange(p), indexing="ij"))
    upper = left < right

    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    moments = doubles.agg(*[x for c in cols for x in (F.avg(c), F.stddev_samp(c))]).first()  # two numbers per column
    mean = np.array([m or 0.0 for m in moments[0::2]])
    unit = np.array([s if s else 1.0 for s in moments[1::2]])

    def pair_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, p, p))
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            present = ~np.isnan(x)
            m = present.astype(float)
            x = np.where(present, (x - mean) / unit, 0.0)
            sq = x * x
            total += np.stack([m.T @ m, x.T @ m, m.T @ x, sq.T @ m, m.T @ sq, x.T @ x])
        flat = total.reshape(6, -1)[:, upper]
        yield pd.DataFrame(
            {"i": left[upper], "j": right[upper], **{n: flat[k] for k, n in enumerate(("n", "sx", "sy", "sxx", "syy", "sxy"))}}
        )

    sums = (
        doubles.mapInPandas(pair_sums, "i long, j long, n double, sx double, sy double, sxx double, syy double, sxy double")
        .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    )
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    cov = n * F.col("sxy") - sx * sy
    spread = F.sqrt(F.greatest(n * F.col("sxx") - sx * sx, F.lit(0.0))) * F.sqrt(
        F.greatest(n * F.col("syy") - sy * sy, F.lit(0.0))
    )
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(
        names[F.col("i")].alias("feature_a"), names[F.col("j")].alias("feature_b"),
        n.cast("long").alias("n"), F.try_divide(cov, spread).alias("corr"),
    ).withColumn("redundant", F.coalesce(F.abs("corr") >= redundant_from, F.lit(False)))


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """A KLL sketch of the values of every feature and group ``by``; missing values are left out.

    Tasks send one sketch per feature and group, a few kilobytes whatever the rows. Sketches of finer groups (days, say)
    can be stored and merged later by ``merge_sketches``.
    """
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    values = unpivot(doubles, columns, "value", by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return values.groupBy("feature", *by).agg(F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    return sketches.groupBy("feature", *by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, chances: Sequence[float] = CHANCES, by: Sequence[str] = ()) -> DataFrame:
    """``chance``, estimated ``value`` and sketched rows ``n`` per feature and group."""
    asked = F.array(*[F.lit(float(c)) for c in chances])
    found = F.arrays_zip(asked.alias("chance"), F.kll_sketch_get_quantile_double("sketch", asked).alias("value"))
    return sketches.select(
        "feature", *by, F.kll_sketch_get_n_double("sketch").alias("n"), F.explode(found).alias("_q")
    ).select("feature", *by, "n", "_q.chance", "_q.value")


def quantile_rank_error(df: DataFrame, quantiles: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``rank_error``: how far the share of rows below or at each estimate is from its ``chance``; 0 inside a tie.

    Each value meets the one row of its feature and group, which holds all estimates as an array; counts are added up
    before the shuffle. ``quantiles`` has one row per feature, group and chance, and groups are few. The estimates are read
    once: sketches break ties by chance, so a second evaluation may differ.
    """
    keys = ["feature", *by]
    asked = quantiles.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("chance", "value", "n"))).alias("_asked"))
    size = quantiles.select("chance").distinct().count()  # the list of chances asked for
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    values = unpivot(doubles, columns, "value", by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    estimates = [F.col("_asked")[i]["value"] for i in range(size)]
    counts = values.join(F.broadcast(asked), keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.first("_asked").alias("_asked"),
        F.array(*[F.count_if(F.col("value") < q) for q in estimates]).alias("_below"),
        F.array(*[F.count_if(F.col("value") <= q) for q in estimates]).alias("_within"),
    )
    spread = counts.select(*keys, "_rows", F.explode(F.arrays_zip("_asked", "_below", "_within")).alias("_z"))
    wanted = F.col("_z._asked.chance") * F.col("_rows")
    off = F.greatest(F.col("_z._below") - wanted, wanted - F.col("_z._within"), F.lit(0.0)) / F.col("_rows")
    return spread.select(*keys, "_z._asked.n", "_z._asked.chance", "_z._asked.value", off.alias("rank_error"))


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature`` and ``median`` of each column with values: the values at its middle ranks.

    All columns are selected together, by one order over (feature, value) after equal values are counted, so the input is
    read once per pass of that order and no column is collected.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    values = unpivot(doubles, columns, "value").where(F.col("value").isNotNull())
    ranked, n = ordered_prefix(values, "value", {"n": F.lit(1)}, by="feature"), F.col("n_total")

    def at(rank: Column) -> Column:
        return F.max(F.when(F.col("n_below") <= rank, F.col("value")))

    middle = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / F.lit(2.0)
    return ranked.groupBy("feature").agg(middle.alias("median"))


def handle_missing(df: DataFrame, columns: Sequence[str], how: str = "drop") -> DataFrame:
    """Drop rows with a NULL among ``columns``, or fill with the column ``mean`` or ``median``.

    Only double columns are filled; flags and integers are left alone.
    """
    if how == "drop":
        return df.na.drop(subset=list(columns))
    if how not in ("mean", "median"):
        raise ValueError(f"how must be 'drop', 'mean' or 'median', not {how!r}")
    numeric = [c for c in columns if dict(df.dtypes)[c] == "double"]
    if how == "mean":
        means = df.agg(F.struct(*[F.avg(c).alias(c) for c in numeric])).scalar()
        fills = {f"_fill_{c}": means[c] for c in numeric}
    else:
        medians = exact_medians(df, numeric).agg(F.map_from_entries(F.collect_list(F.struct("feature", "median")))).scalar()
        fills = {f"_fill_{c}": F.try_element_at(medians, F.lit(c)) for c in numeric}
    return df.withColumns(fills).withColumns({c: F.coalesce(c, f"_fill_{c}") for c in numeric}).drop(*fills)
