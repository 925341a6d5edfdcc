"""Queries over data quality, evaluation, backtests, monitoring, news and vectors.

The score under evaluation is RSI / 100, so that every number can be checked in SQL.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import evaluate as E
from barloom.operators import monitor as Mo
from barloom.operators import news as N
from barloom.operators import quality as Qu
from barloom.operators import series as S
from barloom.operators import splits as Sp
from barloom.operators import vectors as V
from barloom.operators.backtest import backtest_signals, equity_curve
from barloom.operators.features_v2 import NAMES as V2_NAMES
from barloom.operators.features_v2 import with_features_v2
from barloom.plans import intraday
from barloom.plans.jobs import run_jobs
from barloom.plans.labels import feature_and_label_stages, future_frames, model_dataset, with_label_columns
from barloom.queries import sql as Q
from barloom.queries.features import DATASET_CTE, FEATURES_CTE
from barloom.queries.ingest import candles
from barloom.queries.registry import query
from barloom.sources import fixtures as X
from barloom.sources import schemas, tables
from barloom.sources.tables import stored
from barloom.streaming.live import (
    accuracy_alerts_stream, drift_alerts_stream, match_outcomes_stream, rolling_performance_stream, stale_alerts_stream, training_bins,
)

_R = f"WITH RECURSIVE {DATASET_CTE}"
_SCORED = f"{_R}, scored AS (SELECT *, rsi_14 / 100.0 AS score FROM dataset)"


def dataset(spark, sf_dir):
    return model_dataset(stored(X.bars_5m(spark, sf_dir)))


def scored(spark, sf_dir):
    return dataset(spark, sf_dir).withColumn("score", F.col("rsi_14") / 100.0)


def stored_scored(spark, sf_dir):
    return stored(scored(spark, sf_dir).select("symbol", "event_time", "score", "target_direction"))


def _rounded(df, digits, *names):
    return df.withColumns({c: F.round(F.col(c), digits) for c in names})


def _r(x, d):
    return Q.half_up(x, d)


_DATA_COLS = tuple(f.name for f in schemas.MODEL_DATASET.fields)
_DOUBLES = tuple(
    f.name for f in schemas.MODEL_DATASET.fields
    if f.dataType.typeName() == "double" and f.name not in schemas.FORWARD_LOOKING
)

# --- quality ----------------------------------------------------------------

_nulls = ", ".join(f"count(*) FILTER ({c} IS NULL) AS nulls_{c}" for c in _DATA_COLS if c not in ("symbol", "event_time"))


@query("quality_report", f"""{_R} SELECT symbol, count(*) AS row_count, min(event_time) AS first_time,
  max(event_time) AS last_time, count(*) - count(DISTINCT event_time) AS duplicate_keys, {_nulls},
  count(*) FILTER (target_direction = 1) AS n_up, {_r('avg(target_direction)', 4)} AS up_share
  FROM dataset GROUP BY symbol""")
def quality_report(spark, sf_dir):
    return Qu.quality_report(dataset(spark, sf_dir))


@query("quality_duplicates", f"""WITH {Q.TICKS}
  SELECT symbol, count(*) AS row_count, min(minute) AS first_time, max(minute) AS last_time,
         count(*) - count(DISTINCT minute) AS duplicate_keys, count(*) FILTER (price IS NULL) AS nulls_price
  FROM (SELECT *, date_trunc('hour', event_time) AS minute FROM ticks) GROUP BY symbol""")
def quality_duplicates(spark, sf_dir):
    """Ticks keyed by the hour, a key that repeats."""
    t = X.ticks(spark, sf_dir)
    hourly = t.select("symbol", F.window("event_time", "1 hour").start.alias("event_time"), "price")
    return Qu.quality_report(hourly, label=None)


_FACTS = f"""count(*) AS rows, min(event_time) AS first_time, max(event_time) AS last_time,
  count(*) FILTER (target_direction = 1) AS n_up, count(*) FILTER (target_direction = 0) AS n_not_up,
  {_r('avg(target_direction)', 4)} AS up_share"""


@query("snapshot_facts", f"{_R} SELECT {_FACTS} FROM dataset")
def snapshot_facts(spark, sf_dir):
    return tables.snapshot_facts(dataset(spark, sf_dir))


@query("export_snapshot", f"{_R} SELECT {_FACTS}, count(*) AS rows_as_written FROM dataset")
def export_snapshot(spark, sf_dir):
    """Frozen copy of the dataset: the facts of its sidecar, and how many reloaded rows equal those that were frozen."""
    rows = stored(dataset(spark, sf_dir))
    path = tables.export_snapshot(rows, tables.scratch_dir(spark, "snapshot"), "20240131")
    facts = spark.read.schema(tables.snapshot_facts(rows).schema).json(f"{path}.json")
    same = spark.read.parquet(f"{path}.parquet").intersectAll(rows).agg(F.count(F.lit(1))).scalar()
    return facts.withColumn("rows_as_written", same)


@query("feature_contract", f"""{_R} SELECT symbol, event_time, {", ".join(
    c for c in _DATA_COLS if c not in ("symbol", "event_time", *schemas.FORWARD_LOOKING))}, target_direction FROM dataset""")
def feature_contract(spark, sf_dir):
    return Qu.feature_contract(dataset(spark, sf_dir))


def _all_columns(bars):
    """Features and labels of every bar, also those whose horizon is not complete."""
    opened = intraday.open_intraday(bars, intraday.EMA, 12)
    return S.close_chunks(feature_and_label_stages(opened), list(_DATA_COLS))


_AUDITED = [f"('{c}', {str(c in schemas.FORWARD_LOOKING).upper()})" for c in _DATA_COLS if c not in ("symbol", "event_time")]


@query("leakage_audit", f"""WITH {Q.BARS_5M}
  SELECT column_name, (SELECT count(*) FROM bars WHERE event_time <= TIMESTAMP '2024-01-20 00:00:00') AS rows_compared,
         looks_forward FROM (VALUES {", ".join(_AUDITED)}) c(column_name, looks_forward)""")
def leakage_audit(spark, sf_dir):
    """Only label columns may change when the bars after the cut are taken away."""
    bars = stored(X.bars_5m(spark, sf_dir))
    audit = Qu.leakage_audit(_all_columns, bars, F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return audit.select("column_name", "rows_compared", "looks_forward")


_profile = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS n, count(*) FILTER ({c} IS NULL) AS n_null, {_r(f'avg({c})', 4)} AS mean,
    {_r(f'stddev_samp({c})', 4)} AS stddev, min({c}) AS min, max({c}) AS max,
    {_r(f'corr({c}, target_direction)', 4)} AS label_corr, coalesce(min({c}) = max({c}), TRUE) AS is_constant,
    count(*) FILTER ({c} IS NULL) * 2 > count(*) AS mostly_null FROM dataset""" for c in _DOUBLES
)


@query("feature_profile", f"{_R} {_profile}")
def feature_profile(spark, sf_dir):
    return _rounded(Qu.feature_profile(dataset(spark, sf_dir), _DOUBLES), 4, "mean", "stddev", "label_corr")


_HIST = _DOUBLES


def _bin(value, lo, hi, bins=10):
    # a range of one value is bin 0
    return f"greatest(least(coalesce(CAST(floor(({value} - {lo}) / nullif({hi} - {lo}, 0) * {float(bins)}) AS INTEGER), 0), {bins - 1}), 0)"


@query("feature_histogram", f"""{_R} {" UNION ALL ".join(f'''
  SELECT '{c}' AS feature, {_bin(c, 'lo', 'hi')} AS bin, count(*) AS n
  FROM dataset, (SELECT min({c}) AS lo, max({c}) AS hi FROM dataset) WHERE {c} IS NOT NULL GROUP BY 2''' for c in _HIST)}""")
def feature_histogram(spark, sf_dir):
    return Qu.feature_histogram(stored(dataset(spark, sf_dir).select(*_HIST)), _HIST)


RANK_ERROR = 0.02


def _quantiles(spark, sf_dir):
    rows = stored(dataset(spark, sf_dir).select("target_direction", F.to_date("event_time").alias("day"), *_DOUBLES))
    daily = Qu.quantile_sketches(rows, _DOUBLES, ("target_direction", "day"))
    estimates = stored(Qu.sketched_quantiles(Qu.merge_sketches(daily, ("target_direction",)), by=("target_direction",)))
    return Qu.quantile_rank_error(rows, estimates, _DOUBLES, ("target_direction",))


_chances = ", ".join(f"{x}::DOUBLE" for x in Qu.CHANCES)


@query("feature_quantiles", f"""{_R} {" UNION ALL ".join(f'''
  SELECT '{c}' AS feature, target_direction, count({c}) AS n, unnest([{_chances}]) AS chance, TRUE AS rank_fits
  FROM dataset GROUP BY target_direction HAVING count({c}) > 0''' for c in _DOUBLES)}""")
def feature_quantiles(spark, sf_dir):
    """Distribution of every feature per class from merged daily sketches; ranks are checked against the rows."""
    found = _quantiles(spark, sf_dir)
    return found.select("feature", "target_direction", "n", "chance", (F.col("rank_error") < RANK_ERROR).alias("rank_fits"))


@query("feature_distributions")
def feature_distributions(spark, sf_dir):
    """The estimated quantiles themselves, with their error beside exact ranks."""
    return _quantiles(spark, sf_dir)


_CORR = _DOUBLES


@query("correlation_matrix", f"""{_R} {" UNION ALL ".join(f'''
  SELECT '{a}' AS feature_a, '{b}' AS feature_b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n,
         {_r(f"nullif(corr({a}, {b}), 'nan'::DOUBLE)", 4)} AS corr,
         coalesce(abs(nullif(corr({a}, {b}), 'nan'::DOUBLE)) >= 0.95, FALSE) AS redundant FROM dataset'''
  for i, a in enumerate(_CORR) for b in _CORR[i + 1:])}""")
def correlation_matrix(spark, sf_dir):
    return _rounded(Qu.correlation_matrix(stored(dataset(spark, sf_dir).select(*_CORR)), _CORR), 4, "corr")


_WARM = ("rsi_14", "return_12_candle_pct", "rolling_volatility_20")


@query("missing_drop", f"""{_R} SELECT symbol, event_time, {", ".join(_WARM)} FROM dataset
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _WARM)}""")
def missing_drop(spark, sf_dir):
    return Qu.handle_missing(dataset(spark, sf_dir), _WARM).select("symbol", "event_time", *_WARM)


@query("missing_mean", f"""{_R} SELECT symbol, event_time, {", ".join(
    _r(f"coalesce({c}, avg({c}) OVER ())", 4) + f" AS {c}" for c in _WARM)} FROM dataset""")
def missing_mean(spark, sf_dir):
    rows = stored(dataset(spark, sf_dir).select("symbol", "event_time", *_WARM))
    filled = Qu.handle_missing(rows, _WARM, "mean")
    return _rounded(filled, 4, *_WARM)


@query("missing_median", f"""{_R} SELECT symbol, event_time, {", ".join(
    _r(f"coalesce({c}, (SELECT median({c}) FROM dataset))", 4) + f" AS {c}" for c in _DOUBLES)} FROM dataset""")
def missing_median(spark, sf_dir):
    """Every double feature filled by its median."""
    rows = stored(dataset(spark, sf_dir).select("symbol", "event_time", *_DOUBLES))
    return _rounded(Qu.handle_missing(rows, _DOUBLES, "median"), 4, *_DOUBLES)


@query("features_v2", f"""WITH RECURSIVE {FEATURES_CTE}, gaps AS (
    SELECT *, ema_9 - ema_20 AS gap, lag(ema_9 - ema_20) OVER (PARTITION BY symbol ORDER BY event_time) AS gap_before,
           hour(event_time) * 60 + minute(event_time) AS m FROM features)
  SELECT symbol, event_time,
    CASE WHEN rsi_14 < 30 THEN 'oversold' WHEN rsi_14 > 70 THEN 'overbought' WHEN rsi_14 IS NOT NULL THEN 'neutral' END
      AS rsi_regime,
    coalesce(gap > 0 AND gap_before <= 0, FALSE) AS ema_cross_up,
    coalesce(gap < 0 AND gap_before >= 0, FALSE) AS ema_cross_down,
    {_r('candle_return_pct / nullif(rolling_volatility_20, 0)', 4)} AS vol_adjusted_return,
    CASE WHEN m < 630 THEN 'open' WHEN m < 840 THEN 'mid' ELSE 'close' END AS session_part,
    CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week FROM gaps""")
def features_v2(spark, sf_dir):
    opened = intraday.open_intraday(stored(X.bars_5m(spark, sf_dir)), intraday.EMA)
    df = with_features_v2(intraday.feature_stages(opened), S.chunk_window("symbol"))
    return S.close_chunks(df, ["symbol", "event_time", *V2_NAMES])


# --- splits -----------------------------------------------------------------

_TIMES = "times AS (SELECT event_time, row_number() OVER (ORDER BY event_time) AS r FROM (SELECT DISTINCT event_time FROM bars))"


@query("time_split", f"""WITH {Q.BARS_5M}, {_TIMES}
  SELECT symbol, event_time, CASE WHEN r <= floor((SELECT count(*) FROM times) * 0.8) THEN 'train' ELSE 'test' END AS split
  FROM bars JOIN times USING (event_time)""")
def time_split(spark, sf_dir):
    return Sp.time_split(X.bars_5m(spark, sf_dir).select("symbol", "event_time"))


@query("time_split_per_symbol", f"""WITH {Q.BARS_5M}
  SELECT symbol, event_time, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY event_time)
    <= floor(count(*) OVER (PARTITION BY symbol) * 0.8) THEN 'train' ELSE 'test' END AS split FROM bars""")
def time_split_per_symbol(spark, sf_dir):
    return Sp.time_split_per_symbol(X.bars_5m(spark, sf_dir).select("symbol", "event_time"))


@query("time_buckets", f"""WITH {Q.BARS_5M},
  times AS (SELECT event_time, ntile(7) OVER (ORDER BY event_time) - 1 AS fold FROM (SELECT DISTINCT event_time FROM bars))
  SELECT symbol, event_time, CAST(fold AS INTEGER) AS fold FROM bars JOIN times USING (event_time)""")
def time_buckets(spark, sf_dir):
    return Sp.time_buckets(X.bars_5m(spark, sf_dir).select("symbol", "event_time"), 7)


# --- evaluation -------------------------------------------------------------


@query("naive_baselines", f"""{_R} SELECT count(*) AS n, count(*) FILTER (target_direction = 1) AS n_up,
  {_r('greatest(avg(target_direction), 1 - avg(target_direction))', 6)} AS majority_accuracy,
  {_r("avg(CASE WHEN coalesce(candle_return_pct > 0, FALSE) = (target_direction = 1) THEN 1.0::DOUBLE ELSE 0.0 END)", 6)}
    AS last_candle_accuracy FROM dataset""")
def naive_baselines(spark, sf_dir):
    return _rounded(E.naive_baselines(dataset(spark, sf_dir)), 6, "majority_accuracy", "last_candle_accuracy")


_ORDERED = """ranked AS (SELECT *, avg(r) OVER (PARTITION BY score) AS tied_rank FROM
    (SELECT *, row_number() OVER (ORDER BY score) AS r FROM usable)),
  at_score AS (SELECT score, sum(y) AS p, sum(1 - y) AS q FROM usable GROUP BY score),
  curve AS (SELECT score, p, q, sum(p) OVER (ORDER BY score DESC) AS tp_, sum(q) OVER (ORDER BY score DESC) AS fp_,
            sum(p) OVER () AS n_pos FROM at_score)"""
_RANKED = f"""{_SCORED}, usable AS (SELECT score, target_direction AS y FROM scored WHERE score IS NOT NULL),
  {_ORDERED}"""
_METRICS = f"""counts AS (
  SELECT count(*) FILTER (score > 0.5 AND y = 1) AS tp, count(*) FILTER (score > 0.5 AND y = 0) AS fp,
         count(*) FILTER (score <= 0.5 AND y = 1) AS fn, count(*) FILTER (score <= 0.5 AND y = 0) AS tn,
         count(*) FILTER (score > 0.7 AND y = 1) AS sp, count(*) FILTER (score > 0.7) AS sn FROM usable)
  SELECT tp, fp, fn, tn, {_r('(tp + tn)::DOUBLE / (tp + fp + fn + tn)', 6)} AS accuracy,
    {_r('tp::DOUBLE / nullif(tp + fp, 0)', 6)} AS precision, {_r('tp::DOUBLE / nullif(tp + fn, 0)', 6)} AS recall,
    {_r('2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0)', 6)} AS f1,
    (SELECT {_r('(sum(CASE WHEN y = 1 THEN tied_rank END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y))::DOUBLE', 6)}
       FROM ranked) AS roc_auc,
    (SELECT {_r('sum(p * (tp_::DOUBLE / (tp_ + fp_))) / max(n_pos)', 6)} FROM curve) AS pr_auc,
    {_r('sp::DOUBLE / nullif(sn, 0)', 6)} AS confident_precision FROM counts"""
_METRIC_NAMES = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "confident_precision")


@query("classification_metrics", f"{_RANKED}, {_METRICS}")
def classification_metrics(spark, sf_dir):
    m = E.classification_metrics(stored_scored(spark, sf_dir), "score")
    return _rounded(m, 6, *_METRIC_NAMES)


@query("document_label_metrics", f"""WITH usable AS (
    SELECT round(least(d.n_chars / 5000.0::DOUBLE, 1.0), 3) AS score, l.quality AS y
    FROM labels l JOIN documents d USING (doc_id)), {_ORDERED}, {_METRICS}""")
def document_label_metrics(spark, sf_dir):
    """The same metrics on stored labels, scored by text length."""
    d = X.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    rows = X.table(spark, sf_dir, "labels").join(d, "doc_id").withColumn(
        "score", F.round(F.least(F.col("n_chars") / 5000.0, F.lit(1.0)), 3)
    )
    return _rounded(E.classification_metrics(rows, "score", "quality"), 6, *_METRIC_NAMES)


@query("precision_recall_curve", f"""{_RANKED} SELECT score AS threshold,
  {_r('tp_::DOUBLE / (tp_ + fp_)', 6)} AS precision, {_r('tp_::DOUBLE / n_pos', 6)} AS recall FROM curve""")
def precision_recall_curve(spark, sf_dir):
    return _rounded(E.precision_recall_curve(stored_scored(spark, sf_dir), "score"), 6, "precision", "recall")


@query("choose_threshold", f"""{_RANKED}, pr AS (
    SELECT score AS threshold, tp_::DOUBLE / (tp_ + fp_) AS precision, tp_::DOUBLE / n_pos AS recall FROM curve)
  SELECT threshold, {_r('precision', 6)} AS precision, {_r('recall', 6)} AS recall FROM pr WHERE recall >= 0.3
  ORDER BY pr.precision DESC, pr.recall DESC, threshold DESC LIMIT 1""")
def choose_threshold(spark, sf_dir):
    return _rounded(E.choose_threshold(stored_scored(spark, sf_dir), "score"), 6, "precision", "recall")


@query("class_weights", f"""{_R} SELECT target_direction, count(*) AS n,
  {_r('(SELECT count(*) FROM dataset)::DOUBLE / (count(*) * 2)', 6)} AS weight FROM dataset GROUP BY 1""")
def class_weights(spark, sf_dir):
    return _rounded(E.class_weights(dataset(spark, sf_dir)), 6, "weight")


_THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)
_FOLDS = f"""{_SCORED}, usable AS (SELECT * FROM scored WHERE score IS NOT NULL),
  times AS (SELECT event_time, ntile(5) OVER (ORDER BY event_time) - 1 AS fold FROM (SELECT DISTINCT event_time FROM usable)),
  folds AS (
    SELECT threshold, CAST(fold AS INTEGER) AS fold, count(*) AS n, min(event_time) AS test_start,
      avg(CASE WHEN (score > threshold) = (target_direction = 1) THEN 1.0::DOUBLE ELSE 0.0 END) AS accuracy,
      count(*) FILTER (score > threshold AND target_direction = 1)::DOUBLE
        / nullif(count(*) FILTER (score > threshold), 0) AS precision
    FROM usable JOIN times USING (event_time), (SELECT unnest([{", ".join(f"{t}::DOUBLE" for t in _THRESHOLDS)}]) AS threshold)
    WHERE fold >= 1 GROUP BY ALL),
  runs AS (SELECT threshold, count(*) AS folds, {_r('avg(accuracy)', 6)} AS mean, {_r('stddev_samp(accuracy)', 6)} AS std
           FROM folds GROUP BY 1)"""


def _folds(spark, sf_dir):
    return E.walk_forward(stored_scored(spark, sf_dir), "score", _THRESHOLDS)


def _runs(spark, sf_dir):
    return _rounded(E.summarize_folds(_folds(spark, sf_dir)), 6, "mean", "std")


def _log(spark, sf_dir):
    return E.experiment_rows(_runs(spark, sf_dir), "threshold", "rsi-", "accuracy")


@query("walk_forward", f"""{_FOLDS} SELECT threshold, fold, n, test_start, {_r('accuracy', 6)} AS accuracy,
  {_r('precision', 6)} AS precision FROM folds""")
def walk_forward(spark, sf_dir):
    return _rounded(_folds(spark, sf_dir), 6, "accuracy", "precision")


@query("walk_forward_summary", f"{_FOLDS} SELECT * FROM runs")
def walk_forward_summary(spark, sf_dir):
    return _runs(spark, sf_dir)


@query("experiment_log", f"""{_FOLDS} SELECT 'rsi-' || CAST(threshold AS VARCHAR) AS run_id, 'accuracy' AS metric,
  folds, mean, std, {_r('(SELECT max(mean) FROM runs) - mean', 6)} AS behind_best FROM runs""")
def experiment_log(spark, sf_dir):
    """Runs appended to the log, read back and compared with the best."""
    root = tables.scratch_dir(spark, "experiments")
    E.log_experiments(_log(spark, sf_dir), root)
    stored = spark.read.schema(
        "run_id string, params string, metric string, folds long, mean double, std double"
    ).parquet(f"{root}/experiment_log")
    return _rounded(E.compare_experiments(stored, "accuracy").drop("params"), 6, "behind_best")


@query("promote_if_better", f"""{_FOLDS} SELECT 'rsi-0.5' AS champion, c.mean AS champion_mean, 'rsi-' || CAST(b.threshold AS VARCHAR)
    AS challenger, b.mean AS challenger_mean, b.mean > c.mean AS promoted
  FROM (SELECT * FROM runs WHERE threshold = 0.5) c,
       (SELECT * FROM runs WHERE threshold <> 0.5 ORDER BY mean DESC, threshold DESC LIMIT 1) b""")
def promote_if_better(spark, sf_dir):
    return E.promote_if_better(_log(spark, sf_dir), "rsi-0.5", "accuracy")


# --- backtest ---------------------------------------------------------------

_EQUITY = f"""{_SCORED}, traded AS (
    SELECT *, coalesce(score > 0.6, FALSE) AS traded,
           CASE WHEN coalesce(score > 0.6, FALSE) THEN future_return_1h_pct - 0.05 ELSE 0.0 END AS net FROM scored),
  curve AS (SELECT *, sum(net) OVER (PARTITION BY symbol ORDER BY event_time) AS eq FROM traded),
  peaks AS (SELECT *, greatest(max(eq) OVER (PARTITION BY symbol ORDER BY event_time), 0.0) AS pk FROM curve)"""


@query("equity_curve", f"""{_EQUITY} SELECT symbol, event_time, traded, {_r('net', 4)} AS net_return_pct,
  {_r('eq', 4)} AS equity, {_r('pk', 4)} AS peak, {_r('pk - eq', 4)} AS drawdown_pct FROM peaks""")
def equity_curve_query(spark, sf_dir):
    curve = equity_curve(stored(scored(spark, sf_dir)), "score", 0.6)
    cols = ("net_return_pct", "equity", "peak", "drawdown_pct")
    return _rounded(curve.select("symbol", "event_time", "traded", *cols), 4, *cols)


@query("backtest_signals", f"""{_EQUITY} SELECT symbol, count(*) FILTER (traded) AS trades,
  {_r('count(*) FILTER (traded AND net > 0)::DOUBLE / nullif(count(*) FILTER (traded), 0)', 6)} AS win_rate,
  {_r('avg(net) FILTER (traded AND net > 0)', 6)} AS avg_win_pct,
  {_r('avg(net) FILTER (traded AND net <= 0)', 6)} AS avg_loss_pct,
  {_r('avg(reward_risk_ratio) FILTER (traded)', 6)} AS avg_reward_risk,
  {_r('sum(net)', 4)} AS total_return_pct, {_r('max(pk - eq)', 4)} AS max_drawdown_pct,
  {_r('(arg_max(close_price, event_time) - arg_min(close_price, event_time)) / arg_min(close_price, event_time) * 100.0', 4)}
    AS buy_and_hold_pct FROM peaks GROUP BY symbol""")
def backtest(spark, sf_dir):
    # Means of 4-digit returns can lie halfway between 4-digit values; 6 digits do not split such ties.
    report = backtest_signals(stored(scored(spark, sf_dir)), "score", 0.6)
    report = _rounded(report, 6, "win_rate", "avg_win_pct", "avg_loss_pct", "avg_reward_risk")
    return _rounded(report, 4, "total_return_pct", "max_drawdown_pct", "buy_and_hold_pct")


# --- monitoring -------------------------------------------------------------

_CUT = "2024-01-24 00:00:00"
_DRIFT = _DOUBLES


def _drift_sql(c):
    share = "greatest(coalesce({n}::DOUBLE / nullif({t}, 0), 0), 0.0001)"
    p, q = share.format(n="t_n", t="sum(t_n) OVER ()"), share.format(n="l_n", t="sum(l_n) OVER ()")
    return f"""SELECT '{c}' AS feature, count({c}) FILTER (tr) AS train_n, count({c}) FILTER (NOT tr) AS live_n,
    {_r(f'avg({c}) FILTER (tr)', 4)} AS train_mean, {_r(f'avg({c}) FILTER (NOT tr)', 4)} AS live_mean,
    {_r(f'stddev_samp({c}) FILTER (tr)', 4)} AS train_std, {_r(f'stddev_samp({c}) FILTER (NOT tr)', 4)} AS live_std,
    (SELECT {_r('sum((q - p) * ln(q / p))', 6)} FROM (SELECT {p} AS p, {q} AS q FROM (
       SELECT {_bin(c, 'lo', 'hi')} AS bin, count(*) FILTER (tr) AS t_n, count(*) FILTER (NOT tr) AS l_n
       FROM marked, (SELECT min({c}) AS lo, max({c}) AS hi FROM marked WHERE tr) WHERE {c} IS NOT NULL GROUP BY 1))) AS psi
    FROM marked"""


_DRIFT_CTE = f"""{_SCORED}, marked AS (SELECT *, event_time < TIMESTAMP '{_CUT}' AS tr FROM scored),
  drift AS ({" UNION ALL ".join(_drift_sql(c) for c in _DRIFT)})"""


def _cut():
    return F.lit(_CUT).cast("timestamp_ntz")


def _drift(rows, limit=Mo.PSI_LIMIT):
    return Mo.drift_report(rows, _DRIFT, F.col("event_time") < _cut(), psi_limit=limit)


@query("drift_report", f"{_DRIFT_CTE} SELECT *, psi > 0.2 AS drifted FROM drift")
def drift_report(spark, sf_dir):
    return _rounded(
        _rounded(_drift(stored(dataset(spark, sf_dir))), 4, "train_mean", "live_mean", "train_std", "live_std"), 6, "psi"
    )


_PERF = f"""predictions AS (SELECT symbol, event_time, rsi_14 / 100.0 AS probability FROM features WHERE rsi_14 IS NOT NULL),
  matched AS (SELECT p.*, target_direction AS y FROM predictions p JOIN labels_ l
              ON p.symbol = l.symbol AND p.event_time = l.event_time),
  rolled AS (
    SELECT symbol, event_time, count(*) OVER f AS predictions,
           sum(CASE WHEN (probability > 0.5) = (y = 1) THEN 1 ELSE 0 END) OVER f AS n_right,
           sum(CASE WHEN probability > 0.5 AND y = 1 THEN 1 ELSE 0 END) OVER f AS hits,
           sum(CASE WHEN probability > 0.5 THEN 1 ELSE 0 END) OVER f AS calls
    FROM matched WINDOW f AS (PARTITION BY symbol ORDER BY event_time ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)),
  performance AS (
    SELECT symbol, event_time, predictions, {_r('n_right::DOUBLE / predictions', 6)} AS rolling_accuracy,
           {_r('hits::DOUBLE / nullif(calls, 0)', 6)} AS rolling_precision,
           n_right::DOUBLE / predictions < 0.5 AS below_expected FROM rolled)"""


def _logged(rows):
    """Predictions as a model would have logged them, from stored rows of the model dataset."""
    return rows.where(F.col("rsi_14").isNotNull()).select(
        "symbol", "event_time", (F.col("rsi_14") / 100.0).alias("probability")
    )


def _performance(rows):
    return Mo.live_performance(Mo.match_outcomes(_logged(rows), rows), expected_accuracy=0.5)


@query("live_performance", f"WITH RECURSIVE {DATASET_CTE}, {_PERF} SELECT * FROM performance")
def live_performance(spark, sf_dir):
    rows = stored(dataset(spark, sf_dir).select("symbol", "event_time", "rsi_14", "target_direction"))
    return _rounded(_performance(rows), 6, "rolling_accuracy", "rolling_precision")


@query("alerts", f"""{_DRIFT_CTE}, {_PERF},
  current_ AS (SELECT * FROM performance QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC) = 1),
  newest AS (SELECT symbol, max(event_time) AS event_time FROM bars GROUP BY 1)
  SELECT 'drift' AS rule, feature AS subject, psi AS value FROM drift WHERE psi > 0.001
  UNION ALL SELECT 'performance', symbol, rolling_accuracy FROM current_ WHERE below_expected
  UNION ALL SELECT 'stale', symbol, NULL FROM newest WHERE event_time < TIMESTAMP '2024-01-30 23:30:00'""")
def alerts(spark, sf_dir):
    """Rules over stored tables, as a monitoring job reads them."""
    held = stored(dataset(spark, sf_dir))
    bars = X.bars_5m(spark, sf_dir).select("symbol", "event_time")
    rows = Mo.alerts(
        _drift(held, limit=0.001), _performance(held), Mo.latest_per_symbol(bars),
        F.lit("2024-01-30 23:30:00").cast("timestamp_ntz"),
    )
    return _rounded(rows, 6, "value")


def _streamed(rows, name, plan, *inputs):
    """Files of ``rows`` (and further ``inputs``) read as streams, through ``plan`` into files, read back."""
    spark = rows.sparkSession
    work = tables.scratch_dir(spark, name)
    streams = []
    for i, df in enumerate((rows, *inputs)):
        df = df.withColumn("event_time", F.col("event_time").cast("timestamp"))
        df.write.parquet(f"{work}/in-{i}")
        streams.append(spark.readStream.schema(df.schema).parquet(f"{work}/in-{i}"))
    out = plan(*streams)
    writer = out.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{work}/out")


@query("outcomes_stream", f"""WITH RECURSIVE {DATASET_CTE}, {_PERF}
  SELECT symbol, event_time, (probability > 0.5) = (y = 1) AS is_right FROM matched""")
def outcomes_stream(spark, sf_dir):
    """Logged predictions and outcomes as two streams that meet on the key."""
    rows = stored(dataset(spark, sf_dir).select("symbol", "event_time", "rsi_14", "target_direction"))
    met = _streamed(_logged(rows), "outcomes-stream", match_outcomes_stream, rows.select("symbol", "event_time", "target_direction"))
    return met.select("symbol", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "is_right")


@query("alerts_stream", f"""WITH RECURSIVE {DATASET_CTE}, {_PERF},
  six AS (SELECT symbol, time_bucket(INTERVAL 6 HOURS, event_time, TIMESTAMP '1970-01-01') + INTERVAL 6 HOURS AS window_end, count(*) AS n,
                 count(*) FILTER ((probability > 0.5) = (y = 1)) AS n_right FROM matched GROUP BY 1, 2)
  SELECT 'performance' AS rule, symbol AS subject, window_end, n AS predictions, {_r('n_right::DOUBLE / n', 6)} AS value FROM six
  WHERE n_right::DOUBLE / n < 0.45 AND window_end <= (SELECT max(event_time) FROM matched) - INTERVAL 1 HOUR""")
def alerts_stream(spark, sf_dir):
    """Closed windows of a stream of matched predictions in which a symbol was right too seldom."""
    rows = stored(dataset(spark, sf_dir).select("symbol", "event_time", "rsi_14", "target_direction"))
    right = (F.col("probability") > 0.5) == (F.col("target_direction") == 1)
    matched = Mo.match_outcomes(_logged(rows), rows).select("symbol", "event_time", right.alias("is_right"))
    found = _streamed(matched, "alerts-stream", lambda s: accuracy_alerts_stream(s, 0.45))
    return _rounded(found.withColumn("window_end", F.col("window_end").cast("timestamp_ntz")), 6, "value")


@query("performance_stream", f"""WITH RECURSIVE {DATASET_CTE}, {_PERF} SELECT * FROM performance""")
def performance_stream(spark, sf_dir):
    """Rolling performance kept as state of a stream of matched predictions."""
    rows = stored(dataset(spark, sf_dir).select("symbol", "event_time", "rsi_14", "target_direction"))
    right = (F.col("probability") > 0.5) == (F.col("target_direction") == 1)
    matched = Mo.match_outcomes(_logged(rows), rows).select("symbol", "event_time", "probability", right.alias("is_right"))
    found = _streamed(matched, "performance-stream", lambda s: rolling_performance_stream(s, 0.5))
    found = found.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    return _rounded(found, 6, "rolling_accuracy", "rolling_precision")


@query("stale_stream", f"""WITH {Q.BARS_5M}, cut_ AS (
    SELECT * FROM bars WHERE symbol <> 'error' OR event_time < TIMESTAMP '2024-01-20 00:00:00')
  SELECT 'stale' AS rule, symbol AS subject, max(event_time) AS last_seen, max(event_time) + INTERVAL 6 HOURS AS silent_until
  FROM cut_ GROUP BY symbol
  HAVING max(event_time) + INTERVAL 6 HOURS <= (SELECT max(event_time) FROM cut_) - INTERVAL 10 MINUTES""")
def stale_stream(spark, sf_dir):
    """Symbols that fell silent in a stream of bars; one series ends ten days early."""
    bars = X.bars_5m(spark, sf_dir).select("symbol", "event_time")
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    found = _streamed(bars.where((F.col("symbol") != "error") | (F.col("event_time") < cut)), "stale-stream",
                      lambda s: stale_alerts_stream(s, "6 hours"))
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("last_seen", "silent_until")})


_WATCHED = ("candle_return_pct", "volume_ratio", "rsi_14")


def _watch_sql(c):
    return f"""SELECT '{c}' AS feature, w, sum(n) AS n, sum((q - p) * ln(q / p)) AS psi FROM (
    SELECT w, n, greatest(t_n::DOUBLE / t_all, 0.0001) AS p, greatest(n::DOUBLE / sum(n) OVER (PARTITION BY w), 0.0001) AS q
    FROM (SELECT w, b AS bin, coalesce(l.n, 0) AS n, coalesce(t.n, 0) AS t_n, t_all FROM
      (SELECT DISTINCT w FROM live), (SELECT unnest(range(10)) AS b), (SELECT count({c}) AS t_all FROM held WHERE tr)
      LEFT JOIN (SELECT w AS lw, {{bin}} AS lb, count(*) AS n FROM live, r_{c} WHERE {c} IS NOT NULL GROUP BY 1, 2) l ON lw = w AND lb = b
      LEFT JOIN (SELECT {{bin}} AS tb, count(*) AS n FROM held, r_{c} WHERE tr AND {c} IS NOT NULL GROUP BY 1) t ON tb = b))
    GROUP BY w""".format(bin=_bin(c, "lo", "hi"))


@query("drift_stream", f"""{_R}, held AS (
    SELECT *, event_time < TIMESTAMP '{_CUT}' AS tr, date_trunc('day', event_time) + INTERVAL 1 DAY AS w FROM dataset),
  live AS (SELECT * FROM held WHERE NOT tr),
  {", ".join(f"r_{c} AS (SELECT min({c}) AS lo, max({c}) AS hi FROM held WHERE tr)" for c in _WATCHED)},
  psis AS ({" UNION ALL ".join(_watch_sql(c) for c in _WATCHED)})
  SELECT 'drift' AS rule, feature AS subject, w AS window_end, CAST(n AS BIGINT) AS rows, {_r('psi', 6)} AS value FROM psis
  WHERE psi > 0.01 AND w <= (SELECT max(event_time) FROM live) - INTERVAL 1 HOUR""")
def drift_stream(spark, sf_dir):
    """Days of a stream whose feature values lie otherwise than in training."""
    rows = stored(dataset(spark, sf_dir).select("event_time", *_WATCHED))
    trained = stored(training_bins(rows.where(F.col("event_time") < _cut()), _WATCHED))
    found = _streamed(rows.where(F.col("event_time") >= _cut()), "drift-stream", lambda s: drift_alerts_stream(s, trained, _WATCHED, 0.01))
    return _rounded(found.withColumn("window_end", F.col("window_end").cast("timestamp_ntz")), 6, "value")


@query("refresh_run", f"""WITH {Q.BARS_5M}, daily AS (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) FROM orders),
  full_ AS (SELECT greatest(count(*) - 12, 0) AS n FROM bars GROUP BY symbol)
  SELECT 'daily_market_features' AS table_name, count(*) AS row_count FROM daily
  UNION ALL SELECT 'intraday_market_features', count(*) FROM bars
  UNION ALL SELECT 'intraday_training_dataset', CAST(sum(n) AS BIGINT) FROM full_
  UNION ALL SELECT 'intraday_model_dataset', CAST(sum(n) AS BIGINT) FROM full_""")
def refresh_run(spark, sf_dir):
    """Stored candles through all jobs in order; rows written per table."""
    root = f"{tables.scratch_dir(spark, 'refresh-run')}/tables"
    daily = X.bars_daily(spark, sf_dir).withColumn("ingestion_time", F.lit(None).cast("timestamp_ntz"))
    tables.refresh_table(daily, root, "market_candles_daily", schemas.CANDLES_DAILY)
    tables.refresh_table(candles(spark, sf_dir), root, "market_candles_5m", schemas.CANDLES_INTRADAY)
    return run_jobs(spark, root, "20240131")


# --- news -------------------------------------------------------------------

# A lexicon of words that occur in the generated documents.
_WORDS = {
    "the": 0.25, "and": 0.5, "that": 1.0, "with": 0.75, "der": 0.5, "que": 0.5, "le": 0.25, "on": 0.75,
    "of": -0.5, "to": -0.75, "is": -1.0, "was": -1.0, "die": -0.75, "de": -0.5, "en": -0.25, "as": -1.0,
}
_ARTICLES = f"""{Q.NEWS}, lexicon(word, weight) AS (VALUES {", ".join(f"('{w}', {x}::DOUBLE)" for w, x in _WORDS.items())}),
  articles AS (SELECT * FROM news QUALIFY row_number() OVER (PARTITION BY url ORDER BY published_at, doc_id) = 1),
  words AS (SELECT doc_id, unnest(string_split_regex(lower(body), '[^a-z]+')) AS word FROM articles),
  matched AS (SELECT doc_id, sum(weight) AS total, count(*) AS n FROM words JOIN lexicon USING (word) GROUP BY 1),
  scored_news AS (SELECT a.*, coalesce({_r('total / n', 4)}, 0.0) AS sentiment_score, CAST(coalesce(n, 0) AS INTEGER) AS matched_words
                  FROM articles a LEFT JOIN matched USING (doc_id))"""


def articles(spark, sf_dir):
    return N.ingest_news(X.news(spark, sf_dir))


def scored_news(spark, sf_dir):
    return N.score_sentiment(articles(spark, sf_dir), lexicon=_WORDS)


@query("ingest_news", f"WITH {_ARTICLES} SELECT symbol, published_at, title, body, url, source, doc_id FROM articles")
def ingest_news(spark, sf_dir):
    return articles(spark, sf_dir)


@query("news_stream", f"WITH {Q.NEWS} SELECT DISTINCT url FROM news")
def news_stream(spark, sf_dir):
    """The news as a stream of which one article per URL passes."""
    rows = X.news(spark, sf_dir).withColumn("published_at", F.col("published_at").cast("timestamp")).drop("title", "body")
    work = tables.scratch_dir(spark, "news-stream")
    rows.write.parquet(f"{work}/in")
    kept = N.dedupe_news_stream(spark.readStream.schema(rows.schema).parquet(f"{work}/in"), "31 days")
    writer = kept.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{work}/out").select("url")


@query("score_sentiment", f"""WITH {_ARTICLES} SELECT doc_id, url, sentiment_score, matched_words,
  CASE WHEN sentiment_score > 0.05 THEN 'positive' WHEN sentiment_score < -0.05 THEN 'negative' ELSE 'neutral' END
    AS sentiment_label FROM scored_news""")
def score_sentiment(spark, sf_dir):
    return scored_news(spark, sf_dir).select("doc_id", "url", "sentiment_score", "matched_words", "sentiment_label")


@query("symbol_sentiment", f"""WITH {_ARTICLES}, buckets AS (
    SELECT symbol, time_bucket(INTERVAL 1 HOUR, published_at) + INTERVAL 1 HOUR AS bucket_end,
           sum(CAST(sentiment_score AS DECIMAL(10,4))) AS s, count(*) AS n FROM scored_news GROUP BY 1, 2)
  SELECT symbol, bucket_end, CAST(sum(n) OVER day_ AS BIGINT) AS articles,
         {_r('CAST(sum(s) OVER day_ AS DOUBLE) / CAST(sum(n) OVER day_ AS DOUBLE)', 6)} AS mean_sentiment FROM buckets
  WINDOW day_ AS (PARTITION BY symbol ORDER BY bucket_end
                  RANGE BETWEEN INTERVAL 86399 SECONDS PRECEDING AND CURRENT ROW)""")
def symbol_sentiment(spark, sf_dir):
    return _rounded(N.symbol_sentiment(scored_news(spark, sf_dir)), 6, "mean_sentiment")


_ASOF = f"""{Q.BARS_5M}, {_ARTICLES},
  instants AS (SELECT symbol, published_at, avg(sentiment_score) AS s FROM scored_news GROUP BY 1, 2),
  attached AS (SELECT b.symbol, b.event_time, b.close_price, i.s AS sentiment_score, i.published_at AS sentiment_time
               FROM bars b ASOF LEFT JOIN instants i ON b.symbol = i.symbol AND b.event_time > i.published_at)"""


@query("sentiment_asof", f"""WITH {_ASOF} SELECT symbol, event_time, close_price, {_r('sentiment_score', 6)} AS sentiment_score,
  sentiment_time FROM attached""")
def sentiment_asof(spark, sf_dir):
    bars = X.bars_5m(spark, sf_dir).select("symbol", "event_time", "close_price")
    return _rounded(N.join_sentiment_asof(bars, scored_news(spark, sf_dir)), 6, "sentiment_score")


@query("sentiment_lift", f"""WITH RECURSIVE {DATASET_CTE}, {_ARTICLES},
  instants AS (SELECT symbol, published_at, avg(sentiment_score) AS s FROM scored_news GROUP BY 1, 2),
  attached AS (SELECT d.rsi_14 / 100.0 AS score, d.target_direction AS y, i.s
               FROM dataset d ASOF LEFT JOIN instants i ON d.symbol = i.symbol AND d.event_time > i.published_at
               WHERE d.rsi_14 IS NOT NULL)
  SELECT count(*) AS n, count(s) AS with_sentiment,
    {_r('avg(CASE WHEN (score > 0.5) = (y = 1) THEN 1.0::DOUBLE ELSE 0.0 END)', 6)} AS accuracy_without,
    {_r('avg(CASE WHEN (score + 0.2 * coalesce(s, 0) > 0.5) = (y = 1) THEN 1.0::DOUBLE ELSE 0.0 END)', 6)} AS accuracy_with
  FROM attached""")
def sentiment_lift(spark, sf_dir):
    """Accuracy of the score alone and shifted by the sentiment known at the time."""
    rows = scored(spark, sf_dir).where(F.col("score").isNotNull())
    both = N.join_sentiment_asof(rows, scored_news(spark, sf_dir))
    y = F.col("target_direction") == 1
    shifted = F.col("score") + F.lit(0.2) * F.coalesce("sentiment_score", F.lit(0.0))

    def accuracy(s):
        return F.round(F.count_if((s > 0.5) == y) / F.count(F.lit(1)), 6)

    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count("sentiment_score").alias("with_sentiment"),
        accuracy(F.col("score")).alias("accuracy_without"), accuracy(shifted).alias("accuracy_with"),
    )


# --- vectors ----------------------------------------------------------------

_MEANS = """parts AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
    FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2),
  centers AS (SELECT label AS query_id, list(m ORDER BY i) AS center FROM parts GROUP BY 1)"""


def _centers(spark, sf_dir):
    e = X.table(spark, sf_dir, "embeddings")
    return V.mean_vectors(e, "label", "embedding").withColumnRenamed("label", "query_id")


@query("vector_topk", f"""WITH {_MEANS}, sims AS (
    SELECT CAST(query_id AS BIGINT) AS query_id, vec_id,
           list_cosine_similarity(CAST(embedding AS DOUBLE[]), center) AS s FROM embeddings, centers)
  SELECT query_id, vec_id, {_r('s', 6)} AS similarity, CAST(place AS INTEGER) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS place FROM sims) WHERE place <= 10""")
def vector_topk(spark, sf_dir):
    """The ten vectors closest to the mean vector of each label."""
    store = X.table(spark, sf_dir, "embeddings")
    return _rounded(V.vector_topk(store, _centers(spark, sf_dir), 10), 6, "similarity")


@query("vector_topk_index", """SELECT vec_id AS query_id, least(10, (SELECT count(*) FROM embeddings)) AS wanted,
    (SELECT count(*) FROM embeddings) AS rows_indexed, TRUE AS recall_at_least_90
  FROM embeddings WHERE vec_id % 100 = 0""")
def vector_topk_index(spark, sf_dir):
    """Ten neighbours of every hundredth vector through inverted lists, measured against the exact answer."""
    store = X.table(spark, sf_dir, "embeddings")
    asked = store.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    index = V.build_index(store, tables.scratch_dir(spark, "vector-index"))
    measured = stored(V.recall_of(V.search_index(index, asked, 10), V.vector_topk(store, asked, 10)))
    rows = index.lists.agg(F.count(F.lit(1))).scalar()
    share = measured.agg(F.sum("hits") / F.sum("wanted")).scalar()
    return measured.select("query_id", "wanted", rows.alias("rows_indexed"), (share >= 0.9).alias("recall_at_least_90"))


@query("retrieve_context", f"""WITH {Q.BARS_5M}, {_ARTICLES},
  joined AS (SELECT a.symbol, a.doc_id, a.url, a.published_at, CAST(e.embedding AS DOUBLE[]) AS v
             FROM articles a JOIN embeddings e ON a.doc_id = e.vec_id),
  parts AS (SELECT symbol, i, avg(v[i]) AS m FROM joined, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2),
  questions AS (SELECT symbol, list(m ORDER BY i) AS center FROM parts GROUP BY 1),
  asked AS (SELECT symbol, TIMESTAMP '2024-01-07 12:00:00' AS as_of, center FROM questions),
  sims AS (SELECT j.*, list_cosine_similarity(v, center) AS s FROM joined j JOIN asked q ON j.symbol = q.symbol
           AND j.published_at < q.as_of AND j.published_at >= q.as_of - INTERVAL 7 DAYS)
  SELECT symbol, CAST(place AS INTEGER) AS place, doc_id AS vec_id, url, published_at, {_r('s', 6)} AS similarity,
         s < 0.2 AS weak FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY s DESC, doc_id) AS place FROM sims) WHERE place <= 5""")
def retrieve_context(spark, sf_dir):
    """Recent articles closest to the average article of their symbol."""
    stored, e = articles(spark, sf_dir), X.table(spark, sf_dir, "embeddings")
    joined = stored.join(e.withColumnRenamed("vec_id", "doc_id"), "doc_id")
    questions = V.mean_vectors(joined, "symbol", "embedding").withColumn(
        "as_of", F.lit("2024-01-07 12:00:00").cast("timestamp_ntz")
    )
    return _rounded(V.retrieve_context(stored, e, questions), 6, "similarity")
