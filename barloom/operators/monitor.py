"""Newest rows, drift, live performance and alerts."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators import series as S
from barloom.operators.quality import bin_of, unpivot

PSI_LIMIT = 0.2
# Stands in for an empty bin so that the logarithm exists.
EMPTY_SHARE = 1e-4


def latest_per_symbol(df: DataFrame, wanted: DataFrame | None = None, ts: str = "event_time") -> DataFrame:
    """Newest row per symbol; with ``wanted`` (symbol) one row per wanted symbol and ``found``.

    Rows merge before the shuffle; of several at the newest time the one of largest hash stays.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    newest = df.groupBy("symbol").agg(F.max_by(row, F.struct(ts, F.xxhash64(*df.columns))).alias("_row")).select("_row.*")
    if wanted is None:
        return newest
    return wanted.join(newest.withColumn("_hit", F.lit(True)), "symbol", "left").withColumn(
        "found", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")


def drift_report(
    df: DataFrame, columns: Sequence[str], is_train, bins: int = 10, psi_limit: float = PSI_LIMIT
) -> DataFrame:
    """Per feature: mean and deviation in training and live rows, population stability index, flag.

    Bins are equal-width over the training range; live values beyond it fall in the end bins.
    """
    doubles = df.select(is_train.alias("_train"), *[F.col(c).cast("double").alias(c) for c in columns])
    # Ranges and moments of all features in one row; the built-in deviation merges without cancellation.
    facts = []
    for c in columns:
        t_x, l_x = F.when(F.col("_train"), F.col(c)), F.when(~F.col("_train"), F.col(c))
        facts.append(F.struct(
            F.min(t_x).alias("lo"), F.max(t_x).alias("hi"), F.count(t_x).alias("t_n"), F.count(l_x).alias("l_n"),
            F.avg(t_x).alias("t_mean"), F.avg(l_x).alias("l_mean"),
            F.stddev_samp(t_x).alias("t_std"), F.stddev_samp(l_x).alias("l_std"),
        ).alias(c))
    ranges = unpivot(doubles.agg(*facts), columns, "r")
    values = unpivot(doubles, columns, "value", ["_train"]).where(F.col("value").isNotNull())
    per_bin = (
        values.join(F.broadcast(ranges.select("feature", "r.lo", "r.hi")), "feature")  # one row per feature
        .groupBy("feature", bin_of(F.col("value"), F.struct("lo", "hi"), bins).alias("bin"))
        .agg(F.count_if("_train").alias("t_n"), F.count_if(~F.col("_train")).alias("l_n"))
    )
    totals = per_bin.groupBy("feature").agg(F.collect_list(F.struct("t_n", "l_n")).alias("bins"))
    totals = ranges.join(F.broadcast(totals), "feature", "left")

    def share(n, total):
        return F.greatest(F.coalesce(F.try_divide(n.cast("double"), total.cast("double")), F.lit(0.0)), F.lit(EMPTY_SHARE))

    def term(b):
        p, q = share(b["t_n"], F.col("r.t_n")), share(b["l_n"], F.col("r.l_n"))
        return (q - p) * F.log(q / p)

    psi = F.aggregate("bins", F.lit(0.0), lambda acc, b: acc + term(b))
    return totals.select(
        "feature", F.col("r.t_n").alias("train_n"), F.col("r.l_n").alias("live_n"),
        F.col("r.t_mean").alias("train_mean"), F.col("r.l_mean").alias("live_mean"),
        F.col("r.t_std").alias("train_std"), F.col("r.l_std").alias("live_std"),
        psi.alias("psi"), (psi > psi_limit).alias("drifted"),
    )


def match_outcomes(predictions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Logged predictions joined to the outcomes that became known later."""
    known = outcomes.select("symbol", "event_time", "target_direction")
    return predictions.join(known, ["symbol", "event_time"])


def live_performance(
    matched: DataFrame, expected_accuracy: float, threshold: float = 0.5, rows: int = 50,
    slice_seconds: int = S.SLICE_INTRADAY,
) -> DataFrame:
    """Rolling accuracy and precision over each symbol's last ``rows`` matched predictions."""
    opened = S.open_chunks(matched, "symbol", "event_time", lookback=rows, slice_seconds=slice_seconds)
    frame = S.chunk_window("symbol").rowsBetween(-(rows - 1), 0)
    up, y = F.col("probability") > threshold, F.col("target_direction") == 1

    def rolled(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).over(frame)

    df = opened.withColumns(
        {
            "predictions": F.count(F.lit(1)).over(frame),
            "_right": rolled(up == y), "_hits": rolled(up & y), "_calls": rolled(up),
        }
    )
    df = df.withColumns(
        {
            "rolling_accuracy": F.try_divide(F.col("_right").cast("double"), F.col("predictions").cast("double")),
            "rolling_precision": F.try_divide(F.col("_hits").cast("double"), F.col("_calls").cast("double")),
        }
    ).withColumn("below_expected", F.col("rolling_accuracy") < expected_accuracy)
    return S.close_chunks(
        df, ["symbol", "event_time", "predictions", "rolling_accuracy", "rolling_precision", "below_expected"]
    )


def alerts(drift: DataFrame, performance: DataFrame, newest: DataFrame, stale_before) -> DataFrame:
    """One row per broken rule: a drifted feature, a symbol below expectation now, a stale symbol."""
    drifted = drift.where("drifted").select(
        F.lit("drift").alias("rule"), F.col("feature").alias("subject"), F.col("psi").alias("value")
    )
    now = latest_per_symbol(performance).where("below_expected").select(
        F.lit("performance").alias("rule"), F.col("symbol").alias("subject"), F.col("rolling_accuracy").alias("value")
    )
    stale = newest.where(F.col("event_time") < stale_before).select(
        F.lit("stale").alias("rule"), F.col("symbol").alias("subject"), F.lit(None).cast("double").alias("value")
    )
    return drifted.unionByName(now).unionByName(stale)
