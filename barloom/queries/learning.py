"""Queries over model training, tuning, importance and scoring.

Fitted numbers have no SQL form. Queries with an oracle return what SQL can check: the rows that enter each fit, and whether
each fitted number lies where it must. ``logistic_coefficients``, ``pruned_features`` and ``signals`` return the numbers
themselves; the tests recompute them.
"""
from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators import evaluate as E
from barloom.operators import learn as L
from barloom.operators.news import join_sentiment_asof
from barloom.operators.splits import SPLIT, expanding_folds, time_split
from barloom.queries import sql as Q
from barloom.plans import intraday
from barloom.queries.analysis import dataset, scored_news
from barloom.queries.features import DATASET_CTE
from barloom.queries.registry import query
from barloom.sources import fixtures as X
from barloom.sources.tables import stored

COLUMNS = (
    "candle_return_pct", "return_3_candle_pct", "return_12_candle_pct", "range_pct", "rolling_volatility_20",
    "close_vs_sma20_pct", "close_vs_ema20_pct", "volume_ratio", "breakout_above_high", "breakdown_below_low", "rsi_14",
)


def stored_dataset(spark, sf_dir):
    return stored(dataset(spark, sf_dir))


def _halves(rows):
    split = stored(time_split(rows))
    return split.where(F.col(SPLIT) == "train").drop(SPLIT), split.where(F.col(SPLIT) == "test").drop(SPLIT)


def _split(spark, sf_dir):
    return _halves(stored_dataset(spark, sf_dir))


@query("encode_symbol", f"""WITH {Q.BARS_5M}, places AS (
    SELECT symbol, row_number() OVER (ORDER BY count(*) DESC, symbol) - 1 AS place FROM bars GROUP BY 1)
  SELECT symbol, event_time, CAST(place AS DOUBLE) AS symbol_index, CAST(place AS BIGINT) AS hot_slot,
         (SELECT count(*) FROM places) AS slots FROM bars JOIN places USING (symbol)""")
def encode_symbol(spark, sf_dir):
    coded = L.encode_symbol(X.bars_5m(spark, sf_dir).select("symbol", "event_time"))
    slots = vector_to_array("symbol_vec")
    return coded.select(
        "symbol", "event_time", "symbol_index", (F.array_position(slots, 1.0) - 1).alias("hot_slot"),
        F.size(slots).cast("long").alias("slots"),
    )


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in COLUMNS)
_TIMED = f"""WITH RECURSIVE {DATASET_CTE},
  times AS (SELECT event_time, row_number() OVER (ORDER BY event_time) AS r, count(*) OVER () AS n
            FROM (SELECT DISTINCT event_time FROM dataset)),
  halves AS (SELECT d.*, r <= floor(n * 0.8) AS in_train FROM dataset d JOIN times USING (event_time)),
  folds AS (SELECT event_time, ntile({{folds}}) OVER (ORDER BY event_time) - 1 AS fold
            FROM (SELECT DISTINCT event_time FROM {{rows}})),
  per_fold AS (SELECT fold, count(*) AS n FROM {{rows}} JOIN folds USING (event_time) WHERE {_COMPLETE} GROUP BY 1),
  expanding AS (SELECT CAST(fold AS INTEGER) AS fold, CAST(sum(n) OVER (ORDER BY fold) - n AS BIGINT) AS n_train, n AS n_test
                FROM per_fold)"""


def _within(c, low, high):
    return F.coalesce(F.col(c).between(low, high), F.lit(False)).alias(f"{c}_in_range")


def _complete(rows):
    return rows.na.drop(subset=list(COLUMNS)).count()


def _holdout(spark, sf_dir, kind, params):
    train, test = _split(spark, sf_dir)
    model = L.train_baseline(train, COLUMNS, kind, params)
    metrics = E.classification_metrics(L.score(model, test, COLUMNS), "p_up")
    return metrics.select(
        F.lit(kind).alias("model"), F.lit(_complete(train)).cast("long").alias("n_train"),
        F.lit(_complete(test)).cast("long").alias("n_test"),
        *[_within(c, 0.0, 1.0) for c in ("accuracy", "roc_auc", "pr_auc")],
    )


def _holdout_sql(kind):
    return f"""{_TIMED.format(folds=4, rows="dataset")} SELECT '{kind}' AS model, count(*) FILTER (in_train) AS n_train,
  count(*) FILTER (NOT in_train) AS n_test, TRUE AS accuracy_in_range, TRUE AS roc_auc_in_range, TRUE AS pr_auc_in_range
  FROM halves WHERE {_COMPLETE}"""


@query("train_logistic", _holdout_sql("logistic"))
def train_logistic(spark, sf_dir):
    """Holdout metrics of the scaled logistic regression."""
    return _holdout(spark, sf_dir, "logistic", {"maxIter": 30})


@query("train_trees", _holdout_sql("trees"))
def train_trees(spark, sf_dir):
    """Holdout metrics of the boosted trees."""
    return _holdout(spark, sf_dir, "trees", {"maxIter": 10, "maxDepth": 4})


@query("walk_forward_model", f"""{_TIMED.format(folds=4, rows="dataset")}
  SELECT fold, n_train, n_test, TRUE AS roc_auc_in_range, TRUE AS mean_auc_in_range, TRUE AS auc_spread_in_range
  FROM expanding WHERE fold > 0""")
def walk_forward_model(spark, sf_dir):
    """A model per expanding fold, its ROC-AUC on the next group of times, mean and spread over the folds."""
    rows = stored_dataset(spark, sf_dir)
    results = [
        (k, _complete(train), _complete(test),
         L.roc_auc(L.train_baseline(train, COLUMNS, "logistic", {"maxIter": 20}), test, COLUMNS))
        for k, train, test in expanding_folds(rows, 4)
    ]
    folds = spark.createDataFrame(results, "fold int, n_train long, n_test long, roc_auc double")
    over = folds.agg(F.avg("roc_auc").alias("mean_auc"), F.stddev_samp("roc_auc").alias("auc_spread"))
    return folds.join(F.broadcast(over)).select(  # one row
        "fold", "n_train", "n_test", _within("roc_auc", 0.0, 1.0), _within("mean_auc", 0.0, 1.0), _within("auc_spread", 0.0, 1.0)
    )


@query("tune_params", f"""{_TIMED.format(folds=3, rows="(SELECT * FROM halves WHERE in_train)")}
  SELECT fold, reg_param, TRUE AS roc_auc_in_range
  FROM expanding, (VALUES (0.0::DOUBLE), (0.1::DOUBLE)) g(reg_param) WHERE fold > 0""")
def tune_params(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return L.tune_params(train, COLUMNS, (0.0, 0.1), folds=3).select("fold", "reg_param", _within("roc_auc", 0.0, 1.0))


@query("feature_importance", f"""SELECT unnest([{", ".join(f"'{c}'" for c in COLUMNS)}]) AS feature,
  TRUE AS split_gain_in_range, TRUE AS accuracy_lost_in_range, TRUE AS gains_add_up, count(*) > 0 AS has_rows FROM events""")
def feature_importance(spark, sf_dir):
    """Importance of every input: each within its bounds, split gains adding up to 1."""
    train, test = _split(spark, sf_dir)
    model = L.train_baseline(train, COLUMNS, "trees", {"maxIter": 5, "maxDepth": 3})
    found = L.feature_importance(model, test, COLUMNS)
    total = F.sum("split_gain").over(Window.partitionBy())  # one row per input column
    return found.select(
        "feature", _within("split_gain", 0.0, 1.0), _within("accuracy_lost", -1.0, 1.0),
        (F.abs(total - 1) < 1e-6).alias("gains_add_up"), F.lit(test.count() > 0).alias("has_rows"),
    )


def _pruned(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return train, L.prune_features(train, COLUMNS, folds=3)


@query("prune_features", f"""{_TIMED.format(folds=3, rows="(SELECT * FROM halves WHERE in_train)")}
  SELECT unnest([{", ".join(f"'{c}'" for c in COLUMNS)}]) AS feature, CAST(n_train_rows AS BIGINT) AS n_train_rows, TRUE AS verdict_fits
  FROM (SELECT count(*) AS n_train_rows FROM halves WHERE in_train AND {_COMPLETE})""")
def prune_features(spark, sf_dir):
    """Every input was tried once or is the last one, and stays only where dropping it loses walk-forward accuracy."""
    train, found = _pruned(spark, sf_dir)
    fits = F.col("kept") == F.coalesce(F.col("accuracy_lost") > 0.0, F.lit(True))
    return found.select("feature", F.lit(_complete(train)).cast("long").alias("n_train_rows"), fits.alias("verdict_fits"))


@query("pruned_features")
def pruned_features(spark, sf_dir):
    """Inputs in the order tried, whether each stays, the accuracy lost without it and the accuracy reached."""
    return _pruned(spark, sf_dir)[1]


def _certificate(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    model = L.train_baseline(train, COLUMNS, "logistic", {"maxIter": 200, "tol": 1e-10})
    return L.optimality(model, train, COLUMNS)


GRADIENT_BOUND = 1e-3

_term = """SELECT '{c}' AS term, count(*) AS n, count(*) FILTER (target_direction = 1) AS n_up,
  round(avg(CAST({c} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, TRUE AS at_optimum FROM fit"""


@query("training_certificate", f"""{_TIMED.format(folds=4, rows="dataset")},
  fit AS (SELECT * FROM halves WHERE in_train AND {_COMPLETE})
  SELECT 'intercept' AS term, count(*) AS n, count(*) FILTER (target_direction = 1) AS n_up, CAST(NULL AS DOUBLE) AS mean,
         CAST(NULL AS DOUBLE) AS stddev, TRUE AS at_optimum FROM fit
  UNION ALL {" UNION ALL ".join(_term.format(c=c) for c in COLUMNS)}""")
def training_certificate(spark, sf_dir):
    """Rows, class totals and scaling of the logistic fit, and that the loss has no slope left in any term."""
    return _certificate(spark, sf_dir).select(
        "term", "n", "n_up", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"),
        (F.abs("gradient") < GRADIENT_BOUND).alias("at_optimum"),
    )


@query("logistic_coefficients")
def logistic_coefficients(spark, sf_dir):
    """Coefficient of every scaled input and the gradient of the weighted loss in it."""
    return _certificate(spark, sf_dir).select("term", "coefficient", "gradient")


@query("batch_score", f"""WITH RECURSIVE {DATASET_CTE},
  newest AS (SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC) = 1)
  SELECT symbol, event_time AS as_of, 0.5::DOUBLE AS threshold, TRUE AS probability_in_range, TRUE AS direction_fits
  FROM newest WHERE {_COMPLETE}""")
def batch_score(spark, sf_dir):
    """Signals on the newest feature row of every symbol, which has no label yet."""
    found = signals(spark, sf_dir)
    fits = (F.col("direction") == "up") == (F.col("probability") > F.col("threshold"))
    return found.select("symbol", "as_of", "threshold", _within("probability", 0.0, 1.0), fits.alias("direction_fits"))


@query("signals")
def signals(spark, sf_dir):
    """Direction and probability of the newest feature row of every symbol."""
    model = L.train_baseline(stored_dataset(spark, sf_dir), COLUMNS, "logistic", {"maxIter": 20})
    return L.batch_score(model, intraday.intraday_features(X.bars_5m(spark, sf_dir)), COLUMNS, threshold=0.5)


@query("sentiment_model_lift", f"""{_TIMED.format(folds=4, rows="dataset")}
  SELECT inputs, count(*) FILTER (in_train) AS n_train, count(*) FILTER (NOT in_train) AS n_test, TRUE AS roc_auc_in_range
  FROM halves, (VALUES ('without'), ('with')) v(inputs) WHERE {_COMPLETE} GROUP BY inputs""")
def sentiment_model_lift(spark, sf_dir):
    """Holdout ROC-AUC of the model without and with sentiment as an input."""
    news = scored_news(spark, sf_dir)
    rows = join_sentiment_asof(stored_dataset(spark, sf_dir), news).na.fill(0.0, ["sentiment_score"])
    train, test = _halves(rows)
    results = [
        (name, _complete(train), _complete(test), L.roc_auc(L.train_baseline(train, cols, "logistic", {"maxIter": 20}), test, cols))
        for name, cols in (("without", COLUMNS), ("with", (*COLUMNS, "sentiment_score")))
    ]
    found = spark.createDataFrame(results, "inputs string, n_train long, n_test long, roc_auc double")
    return found.select("inputs", "n_train", "n_test", _within("roc_auc", 0.0, 1.0))
