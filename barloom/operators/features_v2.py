"""Second-round candidate features on top of the intraday set."""
from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.functions import round_half_up, safe_ratio
from barloom.operators import series as S

NAMES = (
    "rsi_regime", "ema_cross_up", "ema_cross_down", "vol_adjusted_return", "session_part", "day_of_week",
)


def with_features_v2(df: DataFrame, w: WindowSpec) -> DataFrame:
    """RSI regime, EMA 9/20 crossings, return per volatility, part of session, day of week (1 = Sunday)."""
    gap = F.col("ema_9") - F.col("ema_20")
    rsi = F.col("rsi_14")
    minute = F.hour("event_time") * 60 + F.minute("event_time")
    df = df.withColumn("_gap", gap).withColumn("_gap_before", S.previous("_gap", 1, w))
    return df.withColumns(
        {
            "rsi_regime": F.when(rsi < 30, "oversold").when(rsi > 70, "overbought").when(rsi.isNotNull(), "neutral"),
            "ema_cross_up": F.coalesce((F.col("_gap") > 0) & (F.col("_gap_before") <= 0), F.lit(False)),
            "ema_cross_down": F.coalesce((F.col("_gap") < 0) & (F.col("_gap_before") >= 0), F.lit(False)),
            "vol_adjusted_return": round_half_up(
                safe_ratio(F.col("candle_return_pct"), F.col("rolling_volatility_20")), 4
            ),
            "session_part": F.when(minute < 10 * 60 + 30, "open").when(minute < 14 * 60, "mid").otherwise("close"),
            "day_of_week": F.dayofweek("event_time"),
        }
    ).drop("_gap", "_gap_before")
