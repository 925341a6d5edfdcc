"""Splits, metrics, as-of joins, vectors, sentiment and models on small inputs."""
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import evaluate as E
from barloom.operators import learn as L
from barloom.operators import monitor as Mo
from barloom.operators import news as N
from barloom.operators import quality as Qu
from barloom.operators import vectors as V
from barloom.operators.backtest import equity_curve
from barloom.operators.scan import asof_join, ordered_prefix
from barloom.operators.splits import expanding_folds, time_split
from barloom.queries import learning as G


def at(minutes):
    return datetime(2024, 1, 1) + timedelta(minutes=minutes)


def test_ordered_prefix_over_many_ranges(spark):
    rng = np.random.default_rng(2)
    values = np.where(rng.random(3_000) < 0.4, 0.5, np.round(rng.random(3_000), 3))  # a third on one value
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    out = ordered_prefix(df, "v", {"n": F.lit(1)}, cuts=16).toPandas().sort_values("v")
    want = [(values < v).sum() for v in out["v"]]
    assert out["n_below"].tolist() == want and out["n"].sum() == 3_000


def test_ordered_prefix_over_times_and_nothing(spark):
    times = [datetime(2024, 1, 1, 0, 0, 0, 7 * i + 1) for i in range(500)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    out = ordered_prefix(df, "t", {"n": F.lit(1)}, cuts=8).orderBy("t").collect()
    assert [r.n_below for r in out] == list(range(500)) and {r.n_total for r in out} == {500}
    assert ordered_prefix(df.limit(0), "t", {"n": F.lit(1)}).count() == 0


def test_metrics_by_brute_force(spark):
    rng = np.random.default_rng(5)
    score, y = np.round(rng.random(400), 1), rng.integers(0, 2, 400)
    df = spark.createDataFrame([(float(s), int(t)) for s, t in zip(score, y)], "s double, target_direction int")
    m = E.classification_metrics(df, "s").first()
    p, q = score[y == 1], score[y == 0]
    auc = ((p[:, None] > q[None, :]) + 0.5 * (p[:, None] == q[None, :])).mean()
    assert m.roc_auc == pytest.approx(auc, abs=1e-12)
    assert (m.tp, m.fp) == (((score > 0.5) & (y == 1)).sum(), ((score > 0.5) & (y == 0)).sum())
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ev = BinaryClassificationEvaluator(labelCol="target_direction", rawPredictionCol="s", numBins=0)
    assert m.roc_auc == pytest.approx(ev.evaluate(df), abs=1e-9)
    best = E.choose_threshold(df, "s", min_recall=0.5).first()
    assert best.recall >= 0.5
    curve = E.precision_recall_curve(df, "s").toPandas()
    assert best.precision == curve[curve.recall >= 0.5].precision.max()


def test_time_split_is_strict_and_keeps_ties_together(spark):
    df = spark.createDataFrame([(s, at(i)) for i in range(50) for s in "AB"], "symbol string, event_time timestamp_ntz")
    out = time_split(df).toPandas()
    train, test = out[out.split == "train"], out[out.split == "test"]
    assert train.event_time.max() < test.event_time.min() and len(train) == 80
    for k, tr, te in expanding_folds(df, 4):
        assert tr.agg(F.max("event_time")).first()[0] < te.agg(F.min("event_time")).first()[0]


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("slice_seconds", [60, 600, 86_400])
def test_asof_by_brute_force(spark, strict, slice_seconds):
    rng = np.random.default_rng(1)
    left = [("A" if rng.random() < 0.7 else "B", at(int(m)), i) for i, m in enumerate(rng.choice(300, 80, replace=False))]
    right = [("A", at(int(m)), float(m)) for m in rng.choice(300, 25, replace=False)]
    l = spark.createDataFrame(left, "symbol string, t timestamp_ntz, i int")
    r = spark.createDataFrame(right, "symbol string, t timestamp_ntz, v double")
    got = {x.i: x.v for x in asof_join(l, r, "symbol", "t", ["v"], strict, slice_seconds).collect()}
    want = {}
    for s, t, i in left:
        hits = [(u, v) for q, u, v in right if q == s and (u < t if strict else u <= t)]
        want[i] = max(hits)[1] if hits else None
    assert got == want


def test_equity_by_brute_force(spark):
    rng = np.random.default_rng(9)
    ret = np.round(rng.normal(0, 1, 500), 4)
    score = rng.random(500)
    rows = [("A", at(7 * i), float(score[i]), float(ret[i])) for i in range(500)]
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp_ntz, s double, future_return_1h_pct double")
    out = equity_curve(df, "s", 0.5).toPandas().sort_values("event_time")
    eq = np.cumsum(np.where(score > 0.5, ret - 0.05, 0.0))
    np.testing.assert_allclose(out["equity"], eq, atol=1e-9)
    np.testing.assert_allclose(out["drawdown_pct"], np.maximum(np.maximum.accumulate(eq), 0) - eq, atol=1e-9)


def topk_by_hand(store, asked, k):
    """(query, id) pairs by rank; vectors of length zero have similarity 0."""
    unit = lambda v: np.asarray(v, float) / (np.linalg.norm(v) or 1.0)
    out = {}
    for q, v in asked:
        if v is not None:
            ranked = sorted((-round(float(unit(v) @ unit(w)), 12), i) for i, w in store if w is not None)
            out[q] = [i for _, i in ranked[:k]]
    return out


def ranked_ids(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: r.place):
        found.setdefault(r.query_id, []).append(r.vec_id)
    return found


@pytest.fixture(scope="module")
def directions():
    """Two dense bundles of directions, one of which holds most rows, and scattered ones; zero and missing vectors."""
    draw = np.random.default_rng(9)
    bundle = [draw.normal(size=8) for _ in range(2)]
    rows = [b + 0.2 * draw.normal(size=8) for b, n in zip(bundle, (400, 100)) for _ in range(n)] + [draw.normal(size=8) for _ in range(100)]
    store = [(i, v.tolist()) for i, v in enumerate(rows)] + [(600, [0.0] * 8), (601, None), (602, rows[3].tolist())]
    asked = [(f"q{i}", v) for i, v in store[::40]] + [("none", None)]
    return store, asked


STORE_SCHEMA, ASKED_SCHEMA = "vec_id long, embedding array<double>", "query_id string, embedding array<double>"


@pytest.mark.parametrize("store_block,query_block", [(100_000, 100_000), (50, 4), (7, 1_000)])
def test_topk_by_brute_force(spark, directions, store_block, query_block):
    store, asked = (spark.createDataFrame(rows, schema) for rows, schema in zip(directions, (STORE_SCHEMA, ASKED_SCHEMA)))
    got = ranked_ids(V.vector_topk(store.repartition(7), asked, 4, store_block=store_block, query_block=query_block))
    assert got == topk_by_hand(*directions, 4)
    assert V.vector_topk(store, asked.limit(0), 4).count() == 0
    assert V.vector_topk(store.limit(0), asked, 4).count() == 0


def test_index_search(spark, directions, tmp_path):
    store, asked = (spark.createDataFrame(rows, schema) for rows, schema in zip(directions, (STORE_SCHEMA, ASKED_SCHEMA)))
    index = V.build_index(store.repartition(5), str(tmp_path / "all"), k=4)
    held = {r.vec_id for r in index.lists.collect()}
    assert held == {i for i, v in directions[0] if v is not None}, "every row with a vector is in a list"
    assert len(index.centres) == 24 and index.probes < len(index.centres)
    want = topk_by_hand(*directions, 4)
    for blocks in ({}, {"store_block": 20, "query_block": 2}):
        got = ranked_ids(V.search_index(index, asked, 4, **blocks))
        hits = sum(len(set(want[q]) & set(got[q])) for q in want)
        assert hits >= 0.9 * sum(map(len, want.values()))
    # reading every list is the exact search
    assert ranked_ids(V.search_index(index, asked, 4, probes=24, store_block=100)) == want
    small = V.build_index(store, str(tmp_path / "sample"), k=4, sample_rows=80)
    assert len(small.centres) == 10 and small.lists.count() == len(held)
    empty = V.build_index(store.limit(0), str(tmp_path / "none"))
    assert V.search_index(empty, asked, 4).count() == 0
    measured = V.recall_of(V.search_index(index, asked, 4), V.vector_topk(store, asked, 4)).collect()
    assert len(measured) == len(want) and all(0 <= r.hits <= r.wanted == 4 for r in measured)


def test_sentiment_and_url_dedupe(spark):
    df = spark.createDataFrame(
        [(1, "A", at(5), "t", "Profit surge! A record RALLY", "u1", "s"), (2, "A", at(1), "t", "crash and fraud", "u1", "s"),
         (3, "B", at(0), "t", "nothing known", "u2", "s")],
        "doc_id int, symbol string, published_at timestamp_ntz, title string, body string, url string, source string",
    )
    kept = {r.url: r.doc_id for r in N.ingest_news(df).collect()}
    assert kept == {"u1": 2, "u2": 3}
    got = {r.doc_id: (r.sentiment_score, r.sentiment_label) for r in N.score_sentiment(df).collect()}
    assert got == {1: (0.75, "positive"), 2: (-1.0, "negative"), 3: (0.0, "neutral")}


def test_drift_and_alerts_fire_on_bad_data(spark):
    rng = np.random.default_rng(4)
    rows = [("A", at(i), float(rng.normal()), float(rng.normal() + (3 if i >= 800 else 0))) for i in range(1_000)]
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp_ntz, same double, moved double")
    drift = Mo.drift_report(df, ["same", "moved"], F.col("event_time") < F.lit(at(800)).cast("timestamp_ntz"))
    flags = {r.feature: r.drifted for r in drift.collect()}
    assert flags == {"same": False, "moved": True}
    matched = df.select("symbol", "event_time", F.lit(0.9).alias("probability"), F.lit(0).alias("target_direction"))
    perf = Mo.live_performance(matched, expected_accuracy=0.5)
    rules = {(r.rule, r.subject) for r in Mo.alerts(
        drift, perf, Mo.latest_per_symbol(df.select("symbol", "event_time")), F.lit(at(5_000)).cast("timestamp_ntz")).collect()}
    assert rules == {("drift", "moved"), ("performance", "A"), ("stale", "A")}


def test_model_learns_and_reloads(spark, tmp_path):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 2))
    rows = [(float(a), float(b), int(a + 0.3 * rng.normal() > 0)) for a, b in x]
    df = spark.createDataFrame(rows, "a double, b double, target_direction int")
    model = L.train_baseline(df, ["a", "b"], "logistic", {"maxIter": 10}, save_to=str(tmp_path / "m"))
    assert L.roc_auc(model, df, ["a", "b"]) > 0.9
    from pyspark.ml import PipelineModel

    again = L.score(PipelineModel.load(str(tmp_path / "m")), df, ["a", "b"])
    assert again.exceptAll(L.score(model, df, ["a", "b"])).count() == 0
    trees = L.train_baseline(df, ["a", "b"], "trees", {"maxIter": 3, "maxDepth": 3})
    lost = {r.feature: r.accuracy_lost for r in L.feature_importance(trees, df, ["a", "b"], key=["a", "b"]).collect()}
    assert lost["a"] > 0.2 > abs(lost["b"])


def test_tuning_reports_every_setting_and_fold(spark, sf_dir):
    out = L.tune_params(G.stored_dataset(spark, sf_dir), G.COLUMNS, (0.0, 0.1), folds=3).toPandas()
    assert len(out) == 4 and out["roc_auc"].between(0, 1).all()
    with pytest.raises(ValueError):
        L.tune_params(G.stored_dataset(spark, sf_dir), G.COLUMNS, (0.0, 0.1), max_trials=1)


def test_certificate_and_coefficients(spark):
    """The gradient of the fit is that of numpy, near 0 at the optimum and not before it."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 2)) * [1.0, 50.0] + [3.0, -100.0]
    y = (x[:, 0] - 3 + rng.normal(size=800) > 0.5).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, target_direction int")
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    z = np.c_[np.ones(800), (x - x.mean(0)) / x.std(0, ddof=1)]
    for iterations, bound in ((100, 1e-4), (1, None)):
        model = L.train_baseline(df, ["a", "b"], "logistic", {"maxIter": iterations, "tol": 1e-10})
        got = {r.term: r for r in L.optimality(model, df, ["a", "b"]).collect()}
        beta = np.array([got[t].coefficient for t in ("intercept", "a", "b")])
        want = (weight * (1 / (1 + np.exp(-z @ beta)) - y)) @ z / weight.sum()
        np.testing.assert_allclose([got[t].gradient for t in ("intercept", "a", "b")], want, atol=1e-9)
        assert got["a"].n == 800 and got["a"].n_up == y.sum() and got["b"].mean == pytest.approx(x[:, 1].mean())
        assert np.abs(want).max() < bound if bound else np.abs(want).max() > 1e-3
    with pytest.raises(ValueError):
        L.optimality(L.train_baseline(df, ["a", "b"], "logistic", {"regParam": 0.1}), df, ["a", "b"])


def test_signals_follow_the_stored_coefficients(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 2))
    rows = [("ABC"[i % 3], at(i), float(a), float(b), int(a > b)) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp_ntz, a double, b double, target_direction int")
    model = L.train_baseline(df, ["a", "b"], "logistic", {"maxIter": 20})
    got = {r.symbol: r for r in L.batch_score(model, df.drop("target_direction"), ["a", "b"], 0.4).collect()}
    beta, z = model.stages[-1].coefficients.toArray(), (x - x.mean(0)) / x.std(0, ddof=1)
    assert set(got) == set("ABC")
    for i in (297, 298, 299):
        p = 1 / (1 + np.exp(-(z[i] @ beta + model.stages[-1].intercept)))
        r = got["ABC"[i % 3]]
        assert r.as_of == at(i) and r.probability == pytest.approx(p) and r.direction == ("up" if p > 0.4 else "not_up")


def test_pruning_drops_noise_and_keeps_what_counts(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 4))
    y = (x[:, 0] + 0.8 * x[:, 1] + 0.3 * rng.normal(size=900) > 0).astype(int)
    rows = [("A", at(i), *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp_ntz, a double, b double, c double, d double, target_direction int")
    got = {r.feature: r for r in L.prune_features(df, list("abcd"), max_lost=0.01).collect()}
    assert [f for f in "abcd" if got[f].kept] == ["a", "b"]
    assert {got[f].step for f in "cd"} == {1, 2} and got["b"].accuracy_lost > 0.1 and got["c"].accuracy_lost <= 0.01
    alone = L.prune_features(df, ["a"]).collect()
    assert [(r.feature, r.kept, r.accuracy_lost) for r in alone] == [("a", True, None)]
    loose = L.prune_features(df, ["a", "b"], max_lost=1.0, folds=2).collect()  # any loss is allowed: one is left
    assert [(r.step, r.kept) for r in loose] == [(1, False), (2, True)]


def test_quantile_sketches_merge_and_tell_their_error(spark):
    """Ties, a constant, missing values and NaN, groups of unequal size; merged parts beside numpy's ranks."""
    rng = np.random.default_rng(6)
    n = 20_000
    a, b = rng.lognormal(size=n), np.where(rng.random(n) < 0.4, 1.0, rng.random(n))
    rows = [(int(i % 10 == 0), i % 7, float(p), float(q), None if i % 3 else 5.0, float("nan")) for i, (p, q) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "y int, part int, a double, b double, c double, d double").repartition(5)
    merged = Qu.merge_sketches(Qu.quantile_sketches(df, list("abcd"), ("y", "part")), ("y",))
    found = Qu.quantile_rank_error(df, Qu.sketched_quantiles(merged, by=("y",)), list("abcd"), ("y",)).toPandas()
    assert set(found["feature"]) == set("abc") and len(found) == 3 * 2 * len(Qu.CHANCES)
    y = np.arange(n) % 10 == 0
    for r in found.itertuples():
        if r.feature == "c":
            assert r.value == 5.0 and r.rank_error == 0
            continue
        v = {"a": a, "b": b}[r.feature][y == bool(r.y)]
        want = max((v < r.value).mean() - r.chance, r.chance - (v <= r.value).mean(), 0)
        assert r.n == len(v) and r.rank_error == pytest.approx(want, abs=1e-12) and r.rank_error < 0.02


def test_medians_of_all_columns_in_one_pass(spark):
    """Ties, even and odd counts, missing and equal values, a column without values; one order over all columns."""
    rng = np.random.default_rng(12)
    cols = {"a": rng.normal(size=501), "b": rng.integers(0, 3, 501).astype(float), "c": np.full(501, 4.0), "d": np.full(501, np.nan),
            "e": np.where(rng.random(501) < 0.5, np.nan, rng.normal(size=501)), "f": np.r_[np.full(499, np.nan), -1.0, 2.0]}
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in zip(*cols.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {r.feature: r["median"] for r in Qu.exact_medians(df, list(cols)).collect()}
    want = {c: float(np.nanmedian(v)) for c, v in cols.items() if not np.isnan(v).all()}
    assert got == want
    filled = Qu.handle_missing(df, list(cols), "median").toPandas()
    for c, v in cols.items():
        np.testing.assert_allclose(np.sort(filled[c].astype(float)), np.sort(np.where(np.isnan(v), want.get(c, np.nan), v)))
