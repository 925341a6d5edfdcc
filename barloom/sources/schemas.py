"""Table contracts: one StructType per table, in write order.

Fixed values: table names, column names and their order are what readers of the
tables rely on.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _D, _L, _B, _I = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.IntegerType()
_TS, _DT = T.TimestampNTZType(), T.DateType()

PRICES = ("open_price", "high_price", "low_price", "close_price")


def _struct(*fields: tuple[str, T.DataType], key: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in key) for n, t in fields])


def _doubles(*names: str) -> list[tuple[str, T.DataType]]:
    return [(n, _D) for n in names]


INTRADAY_KEY = ("symbol", "event_time")
DAILY_KEY = ("symbol", "event_date")

CANDLES_INTRADAY = _struct(
    ("symbol", _S), ("exchange", _S), *_doubles(*PRICES), ("volume", _L), ("event_time", _TS), ("ingestion_time", _TS),
    key=INTRADAY_KEY,
)
CANDLES_DAILY = _struct(
    ("symbol", _S), *_doubles(*PRICES), ("volume", _L), ("event_date", _DT), ("ingestion_time", _TS),
    key=DAILY_KEY,
)
DAILY_FEATURES = _struct(
    ("symbol", _S), ("event_date", _DT),
    *_doubles(
        "close_price", "previous_day_high", "previous_day_low", "previous_day_close",
        "gap_pct", "daily_return_pct", "return_5d_pct", "return_20d_pct",
        "range_pct", "rolling_volatility_20",
        "sma_20", "sma_50", "ema_20", "ema_50", "ema_spread",
        "close_vs_sma20_pct", "close_vs_sma50_pct", "close_vs_ema20_pct", "close_vs_ema50_pct",
        "avg_volume_20", "volume_ratio",
    ),
    key=DAILY_KEY,
)
DAILY_FEATURES_STRICT = _struct(
    ("symbol", _S), ("event_date", _DT),
    *_doubles(
        "close_price", "previous_day_high", "previous_day_low", "previous_day_close",
        "gap_pct", "daily_return_pct", "range_pct",
        "sma_20", "sma_50", "ema_20", "ema_50", "ema_spread",
        "avg_volume_20", "volume_ratio",
    ),
    key=DAILY_KEY,
)
INTRADAY_FEATURES = _struct(
    ("symbol", _S), ("event_time", _TS),
    *_doubles(
        "close_price", "high_price", "low_price",
        "previous_candle_close", "previous_candle_high", "previous_candle_low",
        "candle_return_pct", "return_3_candle_pct", "return_12_candle_pct",
        "range_pct", "rolling_volatility_20",
        "sma_9", "sma_20", "ema_9", "ema_20", "ema_50", "ema_spread",
        "close_vs_sma9_pct", "close_vs_sma20_pct",
        "close_vs_ema9_pct", "close_vs_ema20_pct", "close_vs_ema50_pct",
        "avg_volume_20", "volume_ratio",
        "rolling_high_20", "rolling_low_20", "breakout_strength_pct", "breakdown_strength_pct",
    ),
    ("breakout_above_high", _B), ("breakdown_below_low", _B), ("rsi_14", _D),
    key=INTRADAY_KEY,
)
_LABELS = (
    *_doubles(
        "future_close_12", "future_high_12", "future_low_12",
        "future_return_1h_pct", "future_high_return_1h_pct", "future_low_return_1h_pct",
    ),
)
LABELS = _struct(
    ("symbol", _S), ("event_time", _TS), *_doubles("close_price", "high_price", "low_price"), *_LABELS,
    ("target_direction", _I), ("reward_risk_ratio", _D),
    key=INTRADAY_KEY,
)
_NOT_IN_DATASET = ("breakout_strength_pct", "breakdown_strength_pct")
MODEL_DATASET = T.StructType(
    [f for f in INTRADAY_FEATURES.fields if f.name not in _NOT_IN_DATASET]
    + [T.StructField(n, t) for n, t in (*_LABELS, ("reward_risk_ratio", _D), ("target_direction", _I))]
)
NEWS = _struct(
    ("symbol", _S), ("published_at", _TS), ("title", _S), ("body", _S), ("url", _S), ("source", _S),
    key=("url",),
)
BAR_MESSAGE = T.StructType(
    [
        T.StructField("symbol", _S), T.StructField("exchange", _S),
        *[T.StructField(p, _D) for p in PRICES],
        T.StructField("volume", _L), T.StructField("event_time", _S), T.StructField("ingestion_time", _S),
    ]
)
# A raw tick as the tick topic carries it.
TICK_MESSAGE = T.StructType(
    [
        T.StructField("symbol", _S), T.StructField("price", _D), T.StructField("volume", _L),
        T.StructField("exchange", _S), T.StructField("event_time", _S),
    ]
)

TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "market_candles_1m": (CANDLES_INTRADAY, INTRADAY_KEY),
    "market_candles_5m": (CANDLES_INTRADAY, INTRADAY_KEY),
    "market_candles_daily": (CANDLES_DAILY, DAILY_KEY),
    "daily_market_features": (DAILY_FEATURES, DAILY_KEY),
    "intraday_market_features": (INTRADAY_FEATURES, INTRADAY_KEY),
    "intraday_training_dataset": (LABELS, INTRADAY_KEY),
    "intraday_model_dataset": (MODEL_DATASET, INTRADAY_KEY),
    "news_articles": (NEWS, ("url",)),
}

# Columns that look forward; never model inputs.
FORWARD_LOOKING = tuple(n for n, _ in _LABELS) + ("reward_risk_ratio", "target_direction")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the contract: its columns, order and types.  Missing columns are an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
