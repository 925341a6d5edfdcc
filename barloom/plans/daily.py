"""Daily technical features, in two dialects.

``partial``: windows average what exists from the first row, EMAs start at the
first close, columns are rounded; 23 columns, written as a full refresh.
``strict``: windows are NULL until full, EMAs use adjusted weights, nothing is
rounded; 16 columns, written as a partial-column upsert.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.functions import pct_change, round_even, round_half_up, safe_ratio
from barloom.functions.expr import pct_of
from barloom.operators import series as S
from barloom.operators.ema import Ema
from barloom.sources import schemas

# EMA spans.
SPANS = {"ema_20": 20, "ema_50": 50}
EMA = Ema("close_price", SPANS)
ADJUSTED_EMA = Ema("close_price", SPANS, adjust=True)


def open_daily(bars: DataFrame, ema: Ema | None = None, slice_seconds: int = S.SLICE_DAILY, lookback: int = 50) -> DataFrame:
    typed = bars.withColumns({p: F.col(p).cast("double") for p in schemas.PRICES})
    return S.open_chunks(typed, "symbol", "event_date", lookback, slice_seconds=slice_seconds, ema=ema)


def with_previous_day(df: DataFrame, w: WindowSpec) -> DataFrame:
    return df.withColumns(
        {f"previous_day_{p}": S.previous(f"{p}_price", 1, w) for p in ("high", "low", "close")}
    )


def with_day_moves(df: DataFrame, digits: int | None = 2) -> DataFrame:
    prev = F.col("previous_day_close")
    return df.withColumns(
        {
            "gap_pct": pct_change(F.col("open_price"), prev, digits),
            "daily_return_pct": pct_change(F.col("close_price"), prev, digits),
            "range_pct": pct_of(F.col("high_price") - F.col("low_price"), F.col("close_price"), digits),
        }
    )


def with_n_day_returns(df: DataFrame, w: WindowSpec, days=(5, 20)) -> DataFrame:
    close = F.col("close_price")
    return df.withColumns(
        {f"return_{n}d_pct": pct_change(close, S.previous("close_price", n, w), 2) for n in days}
    )


def with_volatility(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Sample deviation of the raw daily return over 20 rows, in percent."""
    raw = safe_ratio(F.col("close_price") - F.col("previous_day_close"), F.col("previous_day_close"))
    return (
        df.withColumn("_raw_return", raw)
        .withColumn(
            "rolling_volatility_20",
            round_half_up(S.rolling_stddev(F.col("_raw_return"), 20, w) * F.lit(100.0), 2),
        )
        .drop("_raw_return")
    )


def with_averages(df: DataFrame, w: WindowSpec, warmup: str) -> DataFrame:
    close, volume = F.col("close_price"), F.col("volume")
    return df.withColumns(
        {
            "sma_20": S.rolling_mean(close, 20, w, warmup),
            "sma_50": S.rolling_mean(close, 50, w, warmup),
            "avg_volume_20": S.rolling_mean(volume, 20, w, warmup),
        }
    ).withColumn("volume_ratio", safe_ratio(volume.cast("double"), F.col("avg_volume_20")))


def with_sma_distance(df: DataFrame) -> DataFrame:
    """Distances use the averages before they are rounded."""
    close = F.col("close_price")
    return df.withColumns(
        {f"close_vs_sma{n}_pct": pct_change(close, F.col(f"sma_{n}"), 2) for n in (20, 50)}
    )


def round_averages(df: DataFrame) -> DataFrame:
    digits = {"sma_20": 2, "sma_50": 2, "avg_volume_20": 2, "volume_ratio": 4}
    return df.withColumns({c: round_half_up(F.col(c), d) for c, d in digits.items()})


def with_rounded_ema(df: DataFrame) -> DataFrame:
    """EMAs at 2 digits; spread and distances come from the rounded values. Opened with ``EMA``."""
    df = df.withColumns({c: round_even(F.col(c), 2) for c in SPANS})
    close = F.col("close_price")
    return df.withColumns(
        {
            "ema_spread": round_even(F.col("ema_20") - F.col("ema_50"), 2),
            **{
                f"close_vs_ema{n}_pct": pct_change(close, F.col(f"ema_{n}"), 2, rounding=round_even)
                for n in (20, 50)
            },
        }
    )


def with_adjusted_ema(df: DataFrame) -> DataFrame:
    """The spread of the averages. Opened with ``ADJUSTED_EMA``."""
    return df.withColumn("ema_spread", F.col("ema_20") - F.col("ema_50"))


def daily_features(bars: DataFrame, warmup: str = "partial", slice_seconds: int = S.SLICE_DAILY) -> DataFrame:
    """All daily features of one dialect, one row per bar; use shorter slices for denser bars."""
    w = S.chunk_window("symbol")
    df = with_previous_day(open_daily(bars, EMA if warmup == "partial" else ADJUSTED_EMA, slice_seconds), w)
    if warmup == "partial":
        df = with_volatility(with_n_day_returns(with_day_moves(df), w), w)
        df = with_sma_distance(with_averages(df, w, "partial"))
        df = round_averages(with_rounded_ema(df))
        contract = schemas.DAILY_FEATURES
    elif warmup == "strict":
        df = with_averages(with_day_moves(df, None), w, "strict")
        df = with_adjusted_ema(df)
        contract = schemas.DAILY_FEATURES_STRICT
    else:
        raise ValueError(f"warmup must be 'partial' or 'strict', not {warmup!r}")
    return schemas.conform(S.close_chunks(df), contract)
