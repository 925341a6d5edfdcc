"""Predictions meeting their outcomes while both are still arriving."""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barloom.operators.monitor import EMPTY_SHARE, PSI_LIMIT
from barloom.operators.quality import bin_of, feature_histogram, unpivot


def match_outcomes_stream(
    predictions: DataFrame, outcomes: DataFrame, horizon: str = "1 hour", threshold: float = 0.5
) -> DataFrame:
    """Stream-stream join on the key.

    An outcome is known one horizon after its bar, so predictions wait that long:
    the state holds only the keys of about one horizon on each side.
    """
    p = predictions.withWatermark("event_time", horizon).select("symbol", "event_time", "probability")
    o = outcomes.withWatermark("event_time", horizon).select("symbol", "event_time", "target_direction")
    return p.join(o, ["symbol", "event_time"]).withColumn(
        "is_right", (F.col("probability") > threshold) == (F.col("target_direction") == 1)
    )


def accuracy_alerts_stream(
    matched: DataFrame, expected_accuracy: float, window: str = "6 hours", delay: str = "1 hour"
) -> DataFrame:
    """One row per symbol and closed window whose share of right predictions is below the expectation.

    ``matched`` has symbol, event_time and is_right. The state holds one count per symbol and open window.
    """
    per_window = matched.withWatermark("event_time", delay).groupBy("symbol", F.window("event_time", window).alias("w")).agg(
        F.count(F.lit(1)).alias("predictions"), F.count_if("is_right").alias("right")
    )
    accuracy = F.col("right") / F.col("predictions")
    return per_window.where(accuracy < expected_accuracy).select(
        F.lit("performance").alias("rule"), F.col("symbol").alias("subject"), F.col("w.end").alias("window_end"),
        "predictions", accuracy.alias("value"),
    )


def rolling_performance_stream(
    matched: DataFrame, expected_accuracy: float, threshold: float = 0.5, rows: int = 50
) -> DataFrame:
    """Rolling accuracy and precision over each symbol's last ``rows`` matched predictions, row by row as they arrive.

    The state of a symbol is its last ``rows`` verdicts, one character each, whatever the length of the stream. Rows of a batch
    are taken in the order of their time; a row that arrives in a later batch than younger ones counts when it arrives.
    """
    out = (
        "symbol string, event_time timestamp, predictions long, rolling_accuracy double, rolling_precision double, "
        "below_expected boolean"
    )

    def roll(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(batches)).sort_values("event_time", kind="stable")
        before = state.get[0] if state.exists else ""
        # one character a row: 0 wrong, 1 right; 2 more when up was predicted
        codes = new["is_right"].to_numpy(bool) + 2 * new["is_up"].to_numpy(bool)
        held = np.concatenate([np.frombuffer(before.encode(), np.uint8) - 48, codes]).astype(int)
        right, calls = held % 2, held // 2
        hits = right * calls
        ends = np.arange(len(held) - len(codes), len(held)) + 1
        starts = np.maximum(ends - rows, 0)
        in_frame = [(lambda c: c[ends] - c[starts])(np.concatenate([[0], np.cumsum(x)])) for x in (right, hits, calls)]
        n = ends - starts
        accuracy = in_frame[0] / n
        precision = np.divide(in_frame[1], in_frame[2], out=np.full(len(n), np.nan), where=in_frame[2] > 0)
        state.update(("".join(map(str, held[-rows:])),))
        yield pd.DataFrame({
            "symbol": key[0], "event_time": new["event_time"].to_numpy(), "predictions": n, "rolling_accuracy": accuracy,
            "rolling_precision": pd.Series(precision).astype(object).where(precision == precision, None),
            "below_expected": accuracy < expected_accuracy,
        })

    seen = matched.select("symbol", "event_time", "is_right", (F.col("probability") > threshold).alias("is_up"))
    return seen.groupBy("symbol").applyInPandasWithState(
        roll, out, "verdicts string", "append", GroupStateTimeout.NoTimeout
    )


def stale_alerts_stream(rows: DataFrame, silence: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """One row per symbol and silence: no row of it came for ``silence`` of event time after its newest one.

    The state of a symbol is the time of its newest row, with a timer on event time; when the watermark (newest time of
    all symbols less ``delay``) passes the timer, the alert goes out and the state goes. A row after that starts anew.
    """
    out = "rule string, subject string, last_seen timestamp, silent_until timestamp"
    seconds = pd.Timedelta(silence).total_seconds()

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            last = state.get[0]
            state.remove()
            yield pd.DataFrame({
                "rule": ["stale"], "subject": [key[0]], "last_seen": [pd.Timestamp(last, unit="us")],
                "silent_until": [pd.Timestamp(last, unit="us") + pd.Timedelta(seconds=seconds)],
            })
            return
        newest = max([int(pdf["micros"].max()) for pdf in batches] + ([state.get[0]] if state.exists else []))
        state.update((newest,))
        # a timer must lie after the watermark; one already passed fires with the next batch
        due = newest // 1_000 + int(seconds * 1_000)
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))

    timed = rows.withWatermark("event_time", delay).select("symbol", "event_time", F.unix_micros("event_time").alias("micros"))
    return timed.groupBy("symbol").applyInPandasWithState(watch, out, "newest long", "append", GroupStateTimeout.EventTimeTimeout)


def training_bins(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Fixed bins of a drift watch: per feature its training range and the share of each bin, one row per feature."""
    counts = feature_histogram(df, columns, bins).groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"), F.sum("n").alias("_all")
    )
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    ranges = unpivot(doubles, columns, "value").groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    share = F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)),
        lambda b: F.coalesce(F.try_element_at("_n", b), F.lit(0)) / F.col("_all"),
    )
    return ranges.join(counts, "feature").select("feature", "lo", "hi", share.alias("shares"))


def drift_alerts_stream(
    rows: DataFrame, trained: DataFrame, columns: Sequence[str], psi_limit: float = PSI_LIMIT, window: str = "1 day",
    delay: str = "1 hour", bins: int = 10,
) -> DataFrame:
    """One row per feature and closed window whose population stability index against ``training_bins`` is above the limit.

    The state is one histogram per feature and open window. ``trained`` has one row per feature.
    """
    values = unpivot(rows.withWatermark("event_time", delay).select(
        "event_time", *[F.col(c).cast("double").alias(c) for c in columns]), columns, "value", ["event_time"])
    placed = values.where(F.col("value").isNotNull()).join(F.broadcast(trained), "feature")
    at = bin_of(F.col("value"), F.struct("lo", "hi"), bins)
    held = placed.groupBy("feature", F.window("event_time", window).alias("w")).agg(
        F.count(F.lit(1)).alias("rows"), F.first("shares").alias("shares"),
        F.array(*[F.count_if(at == b) for b in range(bins)]).alias("counts"),
    )
    floor = F.lit(EMPTY_SHARE)
    terms = F.zip_with(
        "shares", "counts", lambda p, n: (F.greatest(n / F.col("rows"), floor) - F.greatest(p, floor))
        * F.log(F.greatest(n / F.col("rows"), floor) / F.greatest(p, floor)))
    psi = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
    return held.select(
        F.lit("drift").alias("rule"), F.col("feature").alias("subject"), F.col("w.end").alias("window_end"), "rows", psi.alias("value")
    ).where(F.col("value") > psi_limit)
