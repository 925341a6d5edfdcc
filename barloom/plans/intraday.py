"""Intraday technical features: momentum, volatility, trend, volume, breakout, RSI.

Frames count rows, not minutes, and run across session breaks.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.functions import (
    above, gain, guarded_ratio, loss, pct_change, round_even, round_half_up, rsi_from_means,
)
from barloom.functions.expr import pct_of
from barloom.operators import series as S
from barloom.operators.ema import Ema
from barloom.sources import schemas

# EMA spans, breakout threshold in percent, RSI rows.
SPANS = {"ema_9": 9, "ema_20": 20, "ema_50": 50}
EMA = Ema("close_price", SPANS)
BREAKOUT_THRESHOLD = 0.10
RSI_ROWS = 14


def open_intraday(
    bars: DataFrame, ema: Ema | None = None, lookahead: int = 0, slice_seconds: int = S.SLICE_INTRADAY, lookback: int = 50
) -> DataFrame:
    typed = bars.withColumns(
        {**{p: F.col(p).cast("double") for p in schemas.PRICES}, "volume": F.col("volume").cast("long")}
    )
    return S.open_chunks(typed, "symbol", "event_time", lookback, lookahead, slice_seconds, ema=ema)


# Columns come in two levels of frames: those over stored columns, then those over
# columns derived from the first level.  One Window operator serves each level.


def first_frames(w: WindowSpec) -> dict[str, Column]:
    """Lags, averages and the prior 20-row range (current row excluded)."""
    return {
        **{f"previous_candle_{p}": S.previous(f"{p}_price", 1, w) for p in ("close", "high", "low")},
        "_close_3": S.previous("close_price", 3, w),
        "_close_12": S.previous("close_price", 12, w),
        "sma_9": S.rolling_mean(F.col("close_price"), 9, w),
        "sma_20": S.rolling_mean(F.col("close_price"), 20, w),
        "avg_volume_20": S.rolling_mean(F.col("volume"), 20, w),
        "rolling_high_20": S.prior_high("high_price", 20, w),
        "rolling_low_20": S.prior_low("low_price", 20, w),
    }


def first_columns() -> dict[str, Column]:
    """Returns, range, volume ratio, breakout strengths (4 digits), price changes by sign."""
    close, high, low = F.col("close_price"), F.col("rolling_high_20"), F.col("rolling_low_20")
    delta = close - F.col("previous_candle_close")
    return {
        "candle_return_pct": pct_change(close, F.col("previous_candle_close"), 2),
        "return_3_candle_pct": pct_change(close, F.col("_close_3"), 2),
        "return_12_candle_pct": pct_change(close, F.col("_close_12"), 2),
        "range_pct": pct_of(F.col("high_price") - F.col("low_price"), close, 2),
        "volume_ratio": guarded_ratio(F.col("volume").cast("double"), F.col("avg_volume_20"), 4),
        "breakout_strength_pct": pct_change(close, high, 4),
        "breakdown_strength_pct": pct_of(low - close, low, 4),
        "_gain": gain(delta),
        "_loss": loss(delta),
    }


def second_frames(w: WindowSpec) -> dict[str, Column]:
    """Deviation of the already rounded percent return; means of gains and losses."""
    return {
        "_deviation": S.rolling_stddev(F.col("candle_return_pct"), 20, w),
        "_mean_gain": S.rolling_mean(F.col("_gain"), RSI_ROWS, w),
        "_mean_loss": S.rolling_mean(F.col("_loss"), RSI_ROWS, w),
    }


def second_columns() -> dict[str, Column]:
    """Volatility, flags on the rounded strengths, and RSI once 14 rows are there."""
    return {
        "rolling_volatility_20": round_half_up(F.col("_deviation"), 2),
        "breakout_above_high": above(F.col("breakout_strength_pct"), BREAKOUT_THRESHOLD),
        "breakdown_below_low": above(F.col("breakdown_strength_pct"), BREAKOUT_THRESHOLD),
        "rsi_14": F.when(
            F.col(S.RN) >= RSI_ROWS, rsi_from_means(F.col("_mean_gain"), F.col("_mean_loss"))
        ),
    }


def with_frames(df: DataFrame, w: WindowSpec, more_frames: Mapping[str, Column] | None = None) -> DataFrame:
    """Everything but EMAs and final rounding; ``more_frames`` over stored columns join the first level."""
    df = df.withColumns({**first_frames(w), **(more_frames or {})}).withColumns(first_columns())
    df = df.withColumns(second_frames(w)).withColumns(second_columns())
    return df.drop("_close_3", "_close_12", "_gain", "_loss", "_deviation", "_mean_gain", "_mean_loss")


def with_trend(df: DataFrame) -> DataFrame:
    """EMAs at 2 digits, spread and EMA distances from them; SMA distances from raw averages. Opened with ``EMA``."""
    df = df.withColumns({c: round_even(F.col(c), 2) for c in SPANS})
    close = F.col("close_price")

    def distance(average: str):
        return pct_change(close, F.col(average), 2, rounding=round_even)

    return df.withColumns(
        {
            "ema_spread": round_even(F.col("ema_20") - F.col("ema_50"), 4),
            **{f"close_vs_ema{n}_pct": distance(f"ema_{n}") for n in (9, 20, 50)},
        }
    )


def with_sma_distance(df: DataFrame) -> DataFrame:
    close = F.col("close_price")
    return df.withColumns(
        {
            f"close_vs_sma{n}_pct": pct_change(close, F.col(f"sma_{n}"), 2, rounding=round_even)
            for n in (9, 20)
        }
    )


def round_features(df: DataFrame) -> DataFrame:
    digits = {
        "sma_9": 2, "sma_20": 2, "avg_volume_20": 2, "rolling_high_20": 2, "rolling_low_20": 2,
        "volume_ratio": 4, "rolling_volatility_20": 4, "ema_spread": 4,
    }
    return df.withColumns({c: round_half_up(F.col(c), d) for c, d in digits.items()})


def feature_stages(opened: DataFrame, more_frames: Mapping[str, Column] | None = None) -> DataFrame:
    """All feature columns on an opened-chunks frame with the averages of ``EMA``."""
    df = with_frames(opened, S.chunk_window("symbol"), more_frames)
    return round_features(with_sma_distance(with_trend(df)))


def intraday_features(bars: DataFrame, slice_seconds: int = S.SLICE_INTRADAY) -> DataFrame:
    """All intraday features, one row per bar; use shorter slices for denser bars."""
    df = feature_stages(open_intraday(bars, EMA, slice_seconds=slice_seconds))
    return schemas.conform(S.close_chunks(df), schemas.INTRADAY_FEATURES)
