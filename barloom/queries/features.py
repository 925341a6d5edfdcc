"""Queries over the feature, label and dataset plans."""
from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import round_half_up
from barloom.operators import series as S
from barloom.plans import daily, intraday, labels
from barloom.queries import sql as Q
from barloom.queries.registry import query
from barloom.sources import fixtures as X
from barloom.sources.tables import stored

D, T = "event_date", "event_time"


def W():
    return S.chunk_window("symbol")


# --- oracle text ------------------------------------------------------------

_prev_day = ", ".join(f"lag({p}_price) OVER w AS previous_day_{p}" for p in ("high", "low", "close"))
_daily_base = f"""base AS (
  SELECT *, {_prev_day}, lag(close_price, 5) OVER w AS c5, lag(close_price, 20) OVER w AS c20,
         {Q.mean('close_price', 'w20')} AS m20, {Q.mean('close_price', 'w50')} AS m50,
         {Q.mean('volume', 'w20')} AS v20, count(*) OVER w20 AS n20, count(*) OVER w50 AS n50
  FROM numbered {Q.windows(D)}),
moved AS (
  SELECT *, {Q.pct('open_price', 'previous_day_close')} AS gap, {Q.pct('close_price', 'previous_day_close')} AS ret,
         (close_price - previous_day_close) / nullif(previous_day_close, 0) AS raw,
         (high_price - low_price) / nullif(close_price, 0) * 100.0 AS rng
  FROM base),
vol AS (SELECT *, stddev_samp(raw) OVER w20 * 100.0 AS sd FROM moved {Q.windows(D)})"""

_daily = {
    "close_price": "close_price",
    **{f"previous_day_{p}": f"previous_day_{p}" for p in ("high", "low", "close")},
    "gap_pct": Q.half_up("gap", 2),
    "daily_return_pct": Q.half_up("ret", 2),
    "return_5d_pct": Q.half_up(Q.pct("close_price", "c5"), 2),
    "return_20d_pct": Q.half_up(Q.pct("close_price", "c20"), 2),
    "range_pct": Q.half_up("rng", 2),
    "rolling_volatility_20": Q.half_up("sd", 2),
    "sma_20": Q.half_up("m20", 2),
    "sma_50": Q.half_up("m50", 2),
    "close_vs_sma20_pct": Q.half_up(Q.pct("close_price", "m20"), 2),
    "close_vs_sma50_pct": Q.half_up(Q.pct("close_price", "m50"), 2),
    "avg_volume_20": Q.half_up("v20", 2),
    "volume_ratio": Q.half_up("volume / nullif(v20, 0)", 4),
}


def _pick(exprs: dict[str, str], *names: str) -> str:
    return ", ".join(f"{exprs[n]} AS {n}" for n in names)


def _daily_sql(*names: str) -> str:
    return f"WITH {Q.BARS_DAILY}, {Q.numbered(D)}, {_daily_base} SELECT symbol, event_date, {_pick(_daily, *names)} FROM vol"


_daily_ema = f"""rounded AS (
  SELECT symbol, rn, {Q.even('e20', 2)} AS ema_20, {Q.even('e50', 2)} AS ema_50 FROM ema)"""
_daily_ema_out = {
    "ema_20": "ema_20",
    "ema_50": "ema_50",
    "ema_spread": Q.even("ema_20 - ema_50", 2),
    "close_vs_ema20_pct": Q.even(Q.pct("close_price", "ema_20"), 2),
    "close_vs_ema50_pct": Q.even(Q.pct("close_price", "ema_50"), 2),
}
_ema_names = tuple(_daily_ema_out)

_intraday_base = f"""base AS (
  SELECT *, {", ".join(f"lag({p}_price) OVER w AS previous_candle_{p}" for p in ("close", "high", "low"))},
         lag(close_price, 3) OVER w AS c3, lag(close_price, 12) OVER w AS c12,
         {Q.mean('close_price', 'w9')} AS m9, {Q.mean('close_price', 'w20')} AS m20,
         {Q.mean('volume', 'w20')} AS v20,
         max(high_price) OVER prior AS rolling_high_20, min(low_price) OVER prior AS rolling_low_20,
         close_price - lag(close_price) OVER w AS delta
  FROM numbered {Q.windows(T)}),
moved AS (
  SELECT *, {Q.half_up(Q.pct('close_price', 'previous_candle_close'), 2)} AS candle_return_pct,
         {Q.half_up(Q.pct('close_price', 'rolling_high_20'), 4)} AS breakout_strength_pct,
         {Q.half_up('(rolling_low_20 - close_price) / nullif(rolling_low_20, 0) * 100.0', 4)} AS breakdown_strength_pct,
         greatest(coalesce(delta, 0.0), 0.0) AS g, greatest(-coalesce(delta, 0.0), 0.0) AS l
  FROM base),
vol AS (
  SELECT *, stddev_samp(candle_return_pct) OVER w20 AS sd, {Q.mean('g', 'w14')} AS ag, {Q.mean('l', 'w14')} AS al
  FROM moved {Q.windows(T)})"""
_intraday = {
    **{c: c for c in ("close_price", "high_price", "low_price", "previous_candle_close", "previous_candle_high",
                      "previous_candle_low", "candle_return_pct", "breakout_strength_pct", "breakdown_strength_pct",
                      "rolling_high_20", "rolling_low_20")},
    "return_3_candle_pct": Q.half_up(Q.pct("close_price", "c3"), 2),
    "return_12_candle_pct": Q.half_up(Q.pct("close_price", "c12"), 2),
    "range_pct": Q.half_up("(high_price - low_price) / nullif(close_price, 0) * 100.0", 2),
    "rolling_volatility_20": Q.half_up("sd", 2),
    "sma_9": Q.half_up("m9", 2),
    "sma_20": Q.half_up("m20", 2),
    "close_vs_sma9_pct": Q.even(Q.pct("close_price", "m9"), 2),
    "close_vs_sma20_pct": Q.even(Q.pct("close_price", "m20"), 2),
    "avg_volume_20": Q.half_up("v20", 2),
    "volume_ratio": f"CASE WHEN v20 <> 0 THEN {Q.half_up('volume / nullif(v20, 0)', 4)} END",
    "breakout_above_high": "coalesce(breakout_strength_pct > 0.10, FALSE)",
    "breakdown_below_low": "coalesce(breakdown_strength_pct > 0.10, FALSE)",
    "rsi_14": "CASE WHEN rn < 14 THEN NULL WHEN al = 0 THEN CASE WHEN ag > 0 THEN 100.0 END ELSE "
              + Q.even("100.0 - 100.0 / (1.0 + ag / nullif(al, 0))", 2) + " END",
    "ema_9": "ema_9", "ema_20": "ema_20", "ema_50": "ema_50",
    "ema_spread": Q.half_up(Q.even("ema_20 - ema_50", 4), 4),
    **{f"close_vs_ema{n}_pct": Q.even(Q.pct("close_price", f"ema_{n}"), 2) for n in (9, 20, 50)},
}
_intraday_ema = f"""rounded AS (
  SELECT symbol, rn, {", ".join(f"{Q.even(f'e{s}', 2)} AS ema_{s}" for s in (9, 20, 50))} FROM ema)"""
_intraday_no_ema = (
    f"WITH {Q.BARS_5M}, {Q.numbered(T)}, {_intraday_base} SELECT symbol, event_time, {{cols}} FROM vol"
)
INTRADAY_CTES = f"{Q.BARS_5M}, {Q.numbered(T)}, {Q.ema_cte((9, 20, 50))}, {_intraday_ema}, {_intraday_base}"
INTRADAY_COLS = tuple(f.name for f in intraday.schemas.INTRADAY_FEATURES.fields[2:])
FEATURES_CTE = (
    f"{INTRADAY_CTES}, features AS (SELECT symbol, event_time, {_pick(_intraday, *INTRADAY_COLS)} "
    "FROM vol JOIN rounded USING (symbol, rn))"
)

_label_base = f"""future AS (
  SELECT symbol, event_time, close_price, high_price, low_price,
         {Q.half_up('lead(close_price, 12) OVER w', 2)} AS future_close_12,
         {Q.half_up('max(high_price) OVER ahead', 2)} AS future_high_12,
         {Q.half_up('min(low_price) OVER ahead', 2)} AS future_low_12
  FROM bars {Q.windows(T)}),
returns AS (
  SELECT *, {", ".join(
      f"{Q.half_up(Q.pct(f'future_{p}_12', 'close_price'), 4)} AS future_{n}return_1h_pct"
      for p, n in (("close", ""), ("high", "high_"), ("low", "low_")))}
  FROM future WHERE future_close_12 IS NOT NULL),
labels_ AS (
  SELECT *, CAST(CASE WHEN future_return_1h_pct > 0.1 THEN 1 ELSE 0 END AS INTEGER) AS target_direction,
         CASE WHEN future_low_return_1h_pct <> 0 THEN
           {Q.half_up('abs(future_high_return_1h_pct / nullif(future_low_return_1h_pct, 0))', 4)} END AS reward_risk_ratio
  FROM returns)"""
_label_cols = ", ".join(f.name for f in intraday.schemas.LABELS.fields)
_dataset_cols = ", ".join(
    f"l.{f.name}" if f.name in intraday.schemas.FORWARD_LOOKING else f"f.{f.name}"
    for f in intraday.schemas.MODEL_DATASET.fields
)
DATASET_CTE = (
    f"{FEATURES_CTE}, {_label_base}, dataset AS (SELECT {_dataset_cols} FROM features f "
    "JOIN labels_ l ON f.symbol = l.symbol AND f.event_time = l.event_time)"
)

# --- daily ------------------------------------------------------------------


@query("daily_prev_gap_return", _daily_sql(
    "previous_day_high", "previous_day_low", "previous_day_close", "gap_pct", "daily_return_pct", "range_pct"))
def daily_prev_gap_return(spark, sf_dir):
    df = daily.with_day_moves(daily.with_previous_day(daily.open_daily(stored(X.bars_daily(spark, sf_dir))), W()))
    return S.close_chunks(df, ["symbol", D, "previous_day_high", "previous_day_low", "previous_day_close",
                               "gap_pct", "daily_return_pct", "range_pct"])


@query("daily_sma_partial", _daily_sql("sma_20", "sma_50", "close_vs_sma20_pct", "close_vs_sma50_pct"))
def daily_sma_partial(spark, sf_dir):
    df = daily.with_averages(daily.open_daily(stored(X.bars_daily(spark, sf_dir))), W(), "partial")
    df = daily.round_averages(daily.with_sma_distance(df))
    return S.close_chunks(df, ["symbol", D, "sma_20", "sma_50", "close_vs_sma20_pct", "close_vs_sma50_pct"])


@query("daily_sma_strict", f"""WITH {Q.BARS_DAILY}, {Q.numbered(D)}, {_daily_base}
  SELECT symbol, event_date, CASE WHEN n20 = 20 THEN m20 END AS sma_20, CASE WHEN n50 = 50 THEN m50 END AS sma_50 FROM vol""")
def daily_sma_strict(spark, sf_dir):
    df = daily.with_averages(daily.open_daily(stored(X.bars_daily(spark, sf_dir))), W(), "strict")
    return S.close_chunks(df, ["symbol", D, "sma_20", "sma_50"])


@query("daily_volume_ratio", _daily_sql("avg_volume_20", "volume_ratio"))
def daily_volume_ratio(spark, sf_dir):
    df = daily.with_averages(daily.open_daily(stored(X.bars_daily(spark, sf_dir))), W(), "partial")
    return S.close_chunks(daily.round_averages(df), ["symbol", D, "avg_volume_20", "volume_ratio"])


@query("daily_returns_5_20", _daily_sql("return_5d_pct", "return_20d_pct"))
def daily_returns_5_20(spark, sf_dir):
    df = daily.with_n_day_returns(daily.open_daily(stored(X.bars_daily(spark, sf_dir))), W())
    return S.close_chunks(df, ["symbol", D, "return_5d_pct", "return_20d_pct"])


@query("daily_volatility", _daily_sql("rolling_volatility_20"))
def daily_volatility(spark, sf_dir):
    df = daily.with_previous_day(daily.open_daily(stored(X.bars_daily(spark, sf_dir))), W())
    return S.close_chunks(daily.with_volatility(df, W()), ["symbol", D, "rolling_volatility_20"])


@query("daily_ema", f"""WITH RECURSIVE {Q.BARS_DAILY}, {Q.gapped(D)}, {Q.ema_cte((20, 50))}, {_daily_ema}
  SELECT symbol, event_date, {_pick(_daily_ema_out, *_ema_names)} FROM numbered JOIN rounded USING (symbol, rn)""")
def daily_ema(spark, sf_dir):
    df = daily.open_daily(X.with_gaps(stored(X.bars_daily(spark, sf_dir)), D), daily.EMA)
    return S.close_chunks(daily.with_rounded_ema(df), ["symbol", D, *_ema_names])


_adjusted = {
    "ema_20": Q.even("n20 / nullif(d20, 0)", 2), "ema_50": Q.even("n50 / nullif(d50, 0)", 2),
    "ema_spread": Q.even("n20 / nullif(d20, 0) - n50 / nullif(d50, 0)", 2),
}


def _two_digits(df, *names):
    """Unrounded recurrences differ in the last bits between engines; compare at 2 digits."""
    return df.withColumns({c: daily.round_even(F.col(c), 2) for c in names})


@query("daily_ema_adjusted", f"""WITH RECURSIVE {Q.BARS_DAILY}, {Q.gapped(D)}, {Q.ema_cte((20, 50), adjust=True)}
  SELECT symbol, event_date, {_pick(_adjusted, *_adjusted)} FROM numbered JOIN ema USING (symbol, rn)""")
def daily_ema_adjusted(spark, sf_dir):
    df = daily.with_adjusted_ema(daily.open_daily(X.with_gaps(stored(X.bars_daily(spark, sf_dir)), D), daily.ADJUSTED_EMA))
    return _two_digits(S.close_chunks(df, ["symbol", D, *_adjusted]), *_adjusted)


_full_daily = tuple(f.name for f in daily.schemas.DAILY_FEATURES.fields[2:])


@query("daily_features_full", f"""WITH RECURSIVE {Q.BARS_DAILY}, {Q.numbered(D)}, {Q.ema_cte((20, 50))}, {_daily_ema},
  {_daily_base}
  SELECT symbol, event_date, {_pick({**_daily, **_daily_ema_out}, *_full_daily)}
  FROM vol JOIN rounded USING (symbol, rn)""")
def daily_features_full(spark, sf_dir):
    return daily.daily_features(stored(X.bars_daily(spark, sf_dir)))


_strict_daily = {
    "close_price": "v.close_price",
    **{f"previous_day_{p}": f"previous_day_{p}" for p in ("high", "low", "close")},
    "gap_pct": "gap", "daily_return_pct": "ret", "range_pct": "rng",
    "sma_20": "CASE WHEN v.n20 = 20 THEN m20 END", "sma_50": "CASE WHEN v.n50 = 50 THEN m50 END",
    **{k: x.replace("n20", "e.n20").replace("n50", "e.n50") for k, x in _adjusted.items()},
    "avg_volume_20": "CASE WHEN v.n20 = 20 THEN v20 END",
    "volume_ratio": "CASE WHEN v.n20 = 20 THEN v.volume / nullif(v20, 0) END",
}


@query("daily_features_strict", f"""WITH RECURSIVE {Q.BARS_DAILY}, {Q.numbered(D)}, {Q.ema_cte((20, 50), adjust=True)},
  {_daily_base}
  SELECT symbol, event_date, {_pick(_strict_daily, *_strict_daily)}
  FROM vol v JOIN ema e USING (symbol, rn)""")
def daily_features_strict(spark, sf_dir):
    return _two_digits(daily.daily_features(stored(X.bars_daily(spark, sf_dir)), "strict"), *_adjusted)


# --- intraday ---------------------------------------------------------------


def _intraday_query(name, stages, *names):
    @query(name, _intraday_no_ema.format(cols=_pick(_intraday, *names)))
    def run(spark, sf_dir):
        df = stages(intraday.open_intraday(stored(X.bars_5m(spark, sf_dir))))
        return S.close_chunks(df, ["symbol", T, *names])

    return run


def _frames(df):
    return intraday.with_frames(df, W())


def _averages(df):
    df = intraday.with_sma_distance(_frames(df))
    return df.withColumns({c: round_half_up(F.col(c), 2) for c in ("sma_9", "sma_20", "avg_volume_20")})


_intraday_query("intraday_momentum", _frames,
                "previous_candle_close", "previous_candle_high", "previous_candle_low",
                "candle_return_pct", "return_3_candle_pct", "return_12_candle_pct", "range_pct")
_intraday_query("intraday_volatility", _frames, "candle_return_pct", "rolling_volatility_20")
_intraday_query("intraday_breakout", _frames,
                "rolling_high_20", "rolling_low_20", "breakout_strength_pct", "breakdown_strength_pct",
                "breakout_above_high", "breakdown_below_low")
_intraday_query("intraday_rsi", _frames, "rsi_14")
_intraday_query("intraday_averages", _averages,
                "sma_9", "sma_20", "close_vs_sma9_pct", "close_vs_sma20_pct", "avg_volume_20", "volume_ratio")


_trend = ("ema_9", "ema_20", "ema_50", "ema_spread", "close_vs_ema9_pct", "close_vs_ema20_pct", "close_vs_ema50_pct")


@query("intraday_ema", f"""WITH RECURSIVE {Q.BARS_5M}, {Q.gapped(T)}, {Q.ema_cte((9, 20, 50))}, {_intraday_ema}
  SELECT symbol, event_time, {_pick(_intraday, *_trend)} FROM numbered JOIN rounded USING (symbol, rn)""")
def intraday_ema(spark, sf_dir):
    df = intraday.open_intraday(X.with_gaps(stored(X.bars_5m(spark, sf_dir)), T), intraday.EMA)
    return S.close_chunks(intraday.with_trend(df), ["symbol", T, *_trend])


@query("intraday_features_full", f"WITH RECURSIVE {FEATURES_CTE} SELECT * FROM features")
def intraday_features_full(spark, sf_dir):
    return intraday.intraday_features(stored(X.bars_5m(spark, sf_dir)))


@query("intraday_features_wide", f"WITH RECURSIVE {FEATURES_CTE} SELECT * FROM features".replace(Q.BARS_5M, Q.BARS_WIDE))
def intraday_features_wide(spark, sf_dir):
    """Breadth instead of depth: one series per user, a bar per event, hence short slices."""
    return intraday.intraday_features(stored(X.bars_wide(spark, sf_dir)), slice_seconds=60)


# --- labels and dataset -----------------------------------------------------


@query("labels_1h", f"WITH {Q.BARS_5M}, {_label_base} SELECT {_label_cols} FROM labels_")
def labels_1h(spark, sf_dir):
    return labels.labels(stored(X.bars_5m(spark, sf_dir)))


@query("model_dataset_join", f"WITH RECURSIVE {DATASET_CTE} SELECT * FROM dataset")
def model_dataset_join(spark, sf_dir):
    features = stored(intraday.intraday_features(stored(X.bars_5m(spark, sf_dir))))
    return labels.join_model_dataset(features, labels.labels(features))


@query("model_dataset_onepass", f"WITH RECURSIVE {DATASET_CTE} SELECT * FROM dataset")
def model_dataset_onepass(spark, sf_dir):
    return labels.model_dataset(stored(X.bars_5m(spark, sf_dir)))
