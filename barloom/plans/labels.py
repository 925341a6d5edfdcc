"""Forward-looking labels and the model dataset."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.functions import direction_label, pct_change, reward_risk, round_half_up
from barloom.operators import series as S
from barloom.plans import intraday
from barloom.sources import schemas

# Fixed value: rows ahead.
HORIZON = 12


def future_frames(w: WindowSpec, horizon: int = HORIZON) -> dict[str, Column]:
    """Close of the row ``horizon`` ahead, highest high and lowest low on the way, at 2 digits."""
    return {
        "future_close_12": round_half_up(S.following("close_price", horizon, w), 2),
        "future_high_12": round_half_up(S.future_high("high_price", horizon, w), 2),
        "future_low_12": round_half_up(S.future_low("low_price", horizon, w), 2),
    }


def with_label_columns(df: DataFrame) -> DataFrame:
    """Returns from the rounded future prices, then direction and reward/risk from the returns."""
    close = F.col("close_price")
    df = df.withColumns(
        {
            f"future_{n}return_1h_pct": pct_change(F.col(f"future_{p}_12"), close, 4)
            for p, n in (("close", ""), ("high", "high_"), ("low", "low_"))
        }
    )
    return df.withColumns(
        {
            "target_direction": direction_label(F.col("future_return_1h_pct")),
            "reward_risk_ratio": reward_risk(
                F.col("future_high_return_1h_pct"), F.col("future_low_return_1h_pct")
            ),
        }
    )


def feature_and_label_stages(opened: DataFrame) -> DataFrame:
    """Features and labels of every row; labels are NULL or partial where the series ends."""
    frames = future_frames(S.chunk_window("symbol"))
    return with_label_columns(intraday.feature_stages(opened, frames))


def _with_full_horizon(df: DataFrame) -> DataFrame:
    return df.where(F.col("future_close_12").isNotNull())


def labels(features: DataFrame, slice_seconds: int = S.SLICE_INTRADAY) -> DataFrame:
    """Labels of every row that has a full horizon ahead; reads five columns only. Denser bars take shorter slices."""
    needed = features.select("symbol", "event_time", "close_price", "high_price", "low_price")
    opened = S.open_chunks(needed, "symbol", "event_time", lookback=0, lookahead=HORIZON, slice_seconds=slice_seconds)
    df = with_label_columns(opened.withColumns(future_frames(S.chunk_window("symbol"))))
    return schemas.conform(_with_full_horizon(S.close_chunks(df)), schemas.LABELS)


def join_model_dataset(features: DataFrame, label_rows: DataFrame) -> DataFrame:
    """Stored features joined to stored labels on the key."""
    label_cols = [c for c in label_rows.columns if c not in features.columns]
    joined = features.join(
        label_rows.select("symbol", "event_time", *label_cols), ["symbol", "event_time"], "inner"
    )
    return schemas.conform(joined, schemas.MODEL_DATASET)


def model_dataset(bars: DataFrame, slice_seconds: int = S.SLICE_INTRADAY) -> DataFrame:
    """The same rows in one pass: labels sit beside the features, no self-join."""
    opened = intraday.open_intraday(bars, intraday.EMA, HORIZON, slice_seconds)
    df = feature_and_label_stages(opened)
    return schemas.conform(_with_full_horizon(S.close_chunks(df)), schemas.MODEL_DATASET)
