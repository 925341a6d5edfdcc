"""Feature plans against plain pandas and hand-computed edges."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import day_rows, minute_rows

from barloom.operators import series as S
from barloom.operators.ema import BLOCK_ROWS, Ema
from barloom.plans.daily import daily_features
from barloom.plans.intraday import intraday_features
from barloom.plans.labels import join_model_dataset, labels, model_dataset
from barloom.sources import fixtures as X


def walk(n, seed=1, start=100.0):
    rng = np.random.default_rng(seed)
    return np.round(np.maximum(start + rng.normal(0, 1, n).cumsum(), 5.0), 2)


def frame(df, key="event_time"):
    return df.toPandas().sort_values(["symbol", key]).reset_index(drop=True)


@pytest.mark.parametrize("n", [1, 2, 13, 14, 19, 20, 21, 50, 51])
def test_warm_up_edges(bars, n):
    out = frame(intraday_features(bars(minute_rows("A", walk(n)))))
    assert len(out) == n
    assert out["previous_candle_close"].notna().sum() == n - 1
    assert out["return_12_candle_pct"].notna().sum() == max(n - 12, 0)
    assert out["sma_20"].notna().all() and out["ema_50"].notna().all()
    assert out["rolling_volatility_20"].notna().sum() == max(n - 2, 0)
    assert out["rolling_high_20"].notna().sum() == n - 1
    assert out["rsi_14"].notna().sum() == max(n - 13, 0)


@pytest.mark.parametrize("n", [1, 19, 20, 49, 50, 60])
def test_strict_warm_up(days, n):
    out = frame(daily_features(days(day_rows("A", walk(n))), "strict"), "event_date")
    assert out["sma_20"].notna().sum() == max(n - 19, 0)
    assert out["sma_50"].notna().sum() == max(n - 49, 0)
    assert out["avg_volume_20"].notna().sum() == max(n - 19, 0)
    assert out["ema_50"].notna().all()


def test_strict_matches_pandas(days):
    closes = walk(400)
    out = frame(daily_features(days(day_rows("A", closes, range(1, 401))), "strict"), "event_date")
    c, v = pd.Series(closes), pd.Series(range(1, 401), dtype=float)
    np.testing.assert_allclose(out["ema_20"], c.ewm(span=20).mean(), rtol=1e-12)
    np.testing.assert_allclose(out["ema_50"], c.ewm(span=50).mean(), rtol=1e-12)
    np.testing.assert_allclose(out["sma_50"], c.rolling(50).mean(), rtol=1e-12)
    np.testing.assert_allclose(out["volume_ratio"], v / v.rolling(20).mean(), rtol=1e-12)
    np.testing.assert_allclose(out["gap_pct"], (c - c.shift()) / c.shift() * 100, rtol=1e-9, atol=1e-12)


def pandas_rsi(c):
    delta = c.diff()
    gain, loss = delta.where(delta > 0, 0), -delta.where(delta < 0, 0)
    rs = gain.rolling(14).mean() / loss.rolling(14).mean()
    return (100 - 100 / (1 + rs)).round(2)


def test_intraday_matches_pandas(bars):
    closes = walk(3_000, seed=3)
    out = frame(intraday_features(bars(minute_rows("A", closes))))
    c = pd.Series(closes)
    for span in (9, 20, 50):
        np.testing.assert_allclose(out[f"ema_{span}"], c.ewm(span=span, adjust=False).mean().round(2), atol=1e-9)
    e20, e50 = (c.ewm(span=s, adjust=False).mean().round(2) for s in (20, 50))
    np.testing.assert_allclose(out["ema_spread"], (e20 - e50).round(4), atol=1e-9)
    np.testing.assert_allclose(out["close_vs_ema20_pct"], ((c - e20) / e20 * 100).round(2), atol=1e-9)
    differs = (out["rsi_14"] - pandas_rsi(c)).abs() > 0.011
    assert not differs.any()
    assert out["rsi_14"].isna().equals(pandas_rsi(c).isna())


def test_rsi_flat_and_rising(bars):
    flat = minute_rows("F", [7.0] * 16)
    rising = minute_rows("R", range(1, 17))
    out = frame(intraday_features(bars(flat, rising)))
    assert out[out.symbol == "F"]["rsi_14"].isna().all()
    r = out[out.symbol == "R"]["rsi_14"].tolist()
    assert np.isnan(r[:13]).all() and r[13:] == [100.0] * 3


def test_zero_volume_and_zero_close(bars):
    rows = minute_rows("Z", [0.0] * 25, [0] * 25)
    out = frame(intraday_features(bars(rows)))
    for c in ("volume_ratio", "candle_return_pct", "range_pct", "close_vs_sma20_pct", "breakout_strength_pct"):
        assert out[c].isna().all()
    assert not out["breakout_above_high"].any()


def test_thresholds_are_strict(bars):
    # 1000 -> 1001 is a strength of exactly 0.10, 1000 -> 1001.1 is above it
    at = frame(intraday_features(bars(minute_rows("A", [1000.0, 1001.0]), minute_rows("B", [1000.0, 1001.1]))))
    assert at["breakout_strength_pct"].tolist()[1] == 0.10
    assert at["breakout_above_high"].tolist() == [False, False, False, True]
    lab = frame(labels(bars(minute_rows("A", [1000.0] * 12 + [1001.0]), minute_rows("B", [1000.0] * 12 + [1001.1]))))
    assert lab["target_direction"].tolist() == [0, 1]
    assert lab["reward_risk_ratio"].isna().all()


def test_labels_need_the_full_horizon(bars):
    assert labels(bars(minute_rows("A", walk(12)))).count() == 0
    out = frame(labels(bars(minute_rows("A", walk(40)), minute_rows("B", walk(13, 5)))))
    assert (out["symbol"] == "A").sum() == 28 and (out["symbol"] == "B").sum() == 1


def test_symbols_do_not_mix_and_order_does_not_matter(bars, spark):
    a, b = minute_rows("A", walk(120, 1)), minute_rows("B", walk(120, 2))
    alone = frame(intraday_features(bars(a)))
    mixed = [r for pair in zip(b, a) for r in pair]
    np.random.default_rng(0).shuffle(mixed)
    together = frame(intraday_features(bars(mixed)))
    pd.testing.assert_frame_equal(alone, together[together.symbol == "A"].reset_index(drop=True))


def test_onepass_equals_join(spark, sf_dir):
    bars = X.bars_5m(spark, sf_dir)
    features = intraday_features(bars)
    joined = join_model_dataset(features, labels(features))
    onepass = model_dataset(bars)
    assert joined.schema == onepass.schema
    assert joined.exceptAll(onepass).count() == 0 and onepass.exceptAll(joined).count() == 0


@pytest.mark.parametrize("chunk_rows,slice_seconds", [(1_024, 3_600), (1_024, 7 * 86_400), (2_048, 60)])
def test_chunks_equal_whole_series(bars, chunk_rows, slice_seconds):
    """Frames, lags, leads and EMAs cut into chunks give what one window over the series gives."""
    gaps = minute_rows("A", walk(2_600, 4)) + minute_rows("A", walk(1_500, 5), start=pd.Timestamp("2024-06-01").to_pydatetime())
    df = bars(gaps, minute_rows("B", walk(700, 6)))
    opened = S.open_chunks(
        df, "symbol", "event_time", 50, 12, slice_seconds=slice_seconds, chunk_rows=chunk_rows,
        ema=Ema("close_price", {"e": 50}),
    )
    w = S.chunk_window("symbol")

    def stages(frame_, win):
        return frame_.withColumns(
            {
                "back": F.lag("close_price", 20).over(win), "ahead": F.lead("close_price", 12).over(win),
                "mean": F.avg("close_price").over(win.rowsBetween(-49, 0)),
                "high": F.max("high_price").over(win.rowsBetween(-20, -1)),
                "low": F.min("low_price").over(win.rowsBetween(1, 12)),
            }
        )

    from pyspark.sql import Window

    got = frame(S.close_chunks(stages(opened, w), keep_rn=True))
    want = frame(stages(df, Window.partitionBy("symbol").orderBy("event_time")))
    pd.testing.assert_frame_equal(got[want.columns.tolist()], want)
    assert got.groupby("symbol")["_rn"].apply(list).tolist() == [list(range(1, 4_101)), list(range(1, 701))]
    e = want.groupby("symbol")["close_price"].transform(lambda s: s.ewm(span=50, adjust=False).mean())
    np.testing.assert_allclose(got["e"], e, rtol=1e-12)


def averages(df, ema, slice_seconds):
    return frame(S.index_series(df, "symbol", "event_time", slice_seconds, ema))


def gappy(n, seed):
    """A walk with missing values: at the start, alone, in runs, in one run over many slices, at the end."""
    rng = np.random.default_rng(seed)
    closes = walk(n, seed)
    closes[rng.random(n) < 0.1] = np.nan
    closes[:5] = np.nan
    closes[n // 3:n // 3 + 400] = np.nan
    closes[n // 2 + 1:n // 2 + 40:2] = np.nan
    closes[-7:] = np.nan
    return closes


def close_rows(symbol, closes):
    return [
        (s, t, o, h, l, None if np.isnan(c) and i % 2 else c, v)  # missing as NULL or as NaN
        for i, (s, t, o, h, l, c, v) in enumerate(minute_rows(symbol, closes))
    ]


@pytest.mark.parametrize("adjust", [False, True])
@pytest.mark.parametrize("slice_seconds", [3_600, 7 * 86_400])
def test_ema_spans(bars, adjust, slice_seconds):
    spans = {f"e{s}": s for s in (1, 2, 5, 9, 50, 200, 2_000, 50_000)}
    series = {"A": walk(4_500, 7), "B": gappy(4_500, 8), "C": np.full(30, np.nan), "D": np.array([np.nan, 4.0]), "E": np.array([3.0])}
    df = bars(*[close_rows(s, c) for s, c in series.items()])
    got = averages(df, Ema("close_price", spans, adjust), slice_seconds)
    assert not [c for c in got.columns if c.startswith("_") and c != "_rn"]
    for symbol, closes in series.items():
        rows = got[got.symbol == symbol]
        assert rows["_rn"].tolist() == list(range(1, len(closes) + 1))
        for name, span in spans.items():
            want = pd.Series(closes).ewm(span=span, adjust=adjust).mean()
            np.testing.assert_allclose(rows[name], want, rtol=1e-11, err_msg=f"{symbol} {name}")


@pytest.mark.parametrize("adjust", [False, True])
def test_ema_after_a_very_long_gap(bars, adjust):
    """What came before is forgotten to the last bit, and until then the average is repeated."""
    closes = np.concatenate([[5.0, 7.0], np.full(9_000, np.nan), [100.0, 50.0]])
    got = averages(bars(close_rows("A", closes)), Ema("close_price", {"e": 9}, adjust), 86_400)["e"]
    np.testing.assert_allclose(got, pd.Series(closes).ewm(span=9, adjust=adjust).mean(), rtol=1e-12)


def test_plans_take_missing_closes(bars, days):
    """The public plans take NULL closes; the averages go on as in pandas."""
    closes = np.array([10.0, 11.0, np.nan, 13.0, 14.0])
    want = pd.Series(closes).ewm(span=9, adjust=False).mean().round(2)
    got = frame(intraday_features(bars(close_rows("A", closes))))
    np.testing.assert_allclose(got["ema_9"], want)
    strict = frame(daily_features(days([(r[0], d[1], *r[2:]) for r, d in zip(close_rows("A", closes), day_rows("A", closes))]), "strict"), "event_date")
    np.testing.assert_allclose(strict["ema_20"], pd.Series(closes).ewm(span=20).mean(), rtol=1e-12)


def test_ema_has_no_python_worker_and_one_sort_per_chunk(bars):
    df = intraday_features(bars(minute_rows("A", walk(30))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    after_chunks = plan.split("Generate")[0]
    assert after_chunks.count("Exchange hashpartitioning(symbol") == 1
    assert after_chunks.count("Sort [") == 1
    assert Ema("close_price", {"e": 50}).block_rows == BLOCK_ROWS == 1_024
    with pytest.raises(ValueError):
        Ema("close_price", {"e": 0})


def test_truncating_the_future_changes_no_feature(spark, sf_dir):
    from barloom.queries import QUERIES
    from barloom.sources.schemas import FORWARD_LOOKING

    report = QUERIES["leakage_audit"](spark, sf_dir).toPandas()
    changed = set(report[report.looks_forward]["column_name"])
    assert (report["rows_compared"] > 0).all()
    assert changed and changed <= set(FORWARD_LOOKING)
    assert {"future_close_12", "future_high_12"} <= changed
