"""Model training, tuning, importance and scoring with Spark ML."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.evaluate import class_weights
from barloom.operators.monitor import latest_per_symbol
from barloom.operators.splits import expanding_folds
from barloom.sources.tables import scratch_dir, stored

LABEL, WEIGHT = "target_direction", "class_weight"
SEED = 7
PARALLEL_FITS = 4
DONOR_BITS = 12  # leading bits of the hash that cut its order into ranges


def encode_symbol(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Add ``symbol_index`` (most frequent first) and the one-hot vector ``symbol_vec``."""
    indexed = StringIndexer(inputCol=symbol, outputCol="symbol_index").fit(df).transform(df)
    return OneHotEncoder(inputCol="symbol_index", outputCol="symbol_vec", dropLast=False).fit(indexed).transform(indexed)


def with_class_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(WEIGHT))
    return df.join(F.broadcast(weights), label)  # one row per class


def _stages(columns: Sequence[str], kind: str, params: Mapping[str, object]):
    numeric = VectorAssembler(inputCols=list(columns), outputCol="raw_features", handleInvalid="skip")
    if kind == "logistic":
        scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
        model = LogisticRegression(labelCol=LABEL, weightCol=WEIGHT, featuresCol="features", **params)
        return [numeric, scaler, model]
    if kind == "trees":
        model = GBTClassifier(labelCol=LABEL, weightCol=WEIGHT, featuresCol="raw_features", seed=SEED, **params)
        return [numeric, model]
    raise ValueError(f"kind must be 'logistic' or 'trees', not {kind!r}")


def _typed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Flags as numbers; rows with a missing input are dropped."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns}).na.drop(subset=list(columns))


def train_baseline(
    train: DataFrame,
    columns: Sequence[str],
    kind: str = "logistic",
    params: Mapping[str, object] | None = None,
    save_to: str | None = None,
) -> PipelineModel:
    """Scaled logistic regression or boosted trees, classes weighted to equal totals.

    The fitted model is saved and the saved one returned: what is scored later is what
    was stored, and it carries no training summary tied to this session.
    """
    ready = with_class_weight(_typed(train, columns))
    model = Pipeline(stages=_stages(columns, kind, params or {})).fit(ready)
    path = save_to or scratch_dir(train.sparkSession, f"model-{kind}")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with ``p_up``, the probability of up."""
    out = model.transform(_typed(df, columns))
    return out.withColumn("p_up", vector_to_array("probability")[1]).drop(
        "raw_features", "features", "rawPrediction", "probability", "prediction"
    )


def roc_auc(model: PipelineModel, df: DataFrame, columns: Sequence[str]) -> float:
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction")
    return evaluator.evaluate(model.transform(_typed(df, columns)))


def feature_importance(
    model: PipelineModel, df: DataFrame, columns: Sequence[str], threshold: float = 0.5,
    key: Sequence[str] = ("symbol", "event_time"), bits: int = DONOR_BITS,
) -> DataFrame:
    """Split-gain importance of the trees beside permutation importance, ranked by the latter.

    Permutation importance is the accuracy lost when one column is replaced by that of
    another row: the one before it in the order of a hash of the unique ``key``.  The order is cut
    into 2**DONOR_BITS ranges, each of which hands its last row to the next; the number of ranges
    changes no donor.  Each row is scored once as is and once per column.
    """
    spark = df.sparkSession
    ready = _typed(df, columns).select(
        LABEL, *columns, F.xxhash64(*[F.col(k) for k in key], F.lit(SEED)).alias("_mix")
    )
    w = Window.partitionBy("_range").orderBy("_mix")
    ready = ready.withColumn("_range", F.shiftrightunsigned("_mix", 64 - bits))
    lasts = ready.groupBy("_range").agg(F.max_by(F.struct(*columns), "_mix").alias("_last"))
    carried = lasts.select("_range", F.lag("_last").over(Window.orderBy("_range")).alias("_carried"))
    donors = ready.join(F.broadcast(carried), "_range").withColumns(  # one row per range
        {f"_d_{c}": F.coalesce(F.lag(c, 1).over(w), F.col(f"_carried.{c}"), F.col(c)) for c in columns}
    )
    variants = donors.withColumn("_which", F.explode(F.array(F.lit(""), *[F.lit(c) for c in columns])))
    swapped = variants.select(
        LABEL, "_which",
        *[F.when(F.col("_which") == c, F.col(f"_d_{c}")).otherwise(F.col(c)).alias(c) for c in columns],
    )
    right = (F.col("p_up") > threshold) == (F.col(LABEL) == 1)
    by_variant = score(model, swapped, columns).groupBy("_which").agg(
        (F.count_if(right) / F.count(F.lit(1))).alias("accuracy")
    )
    base = by_variant.where(F.col("_which") == "").agg(F.max("accuracy")).scalar()
    gains = getattr(model.stages[-1], "featureImportances", None)
    gain_of = {c: float(gains[i]) if gains is not None else None for i, c in enumerate(columns)}
    gain_df = spark.createDataFrame(list(gain_of.items()), "feature string, split_gain double")
    return by_variant.where(F.col("_which") != "").select(
        F.col("_which").alias("feature"), (base - F.col("accuracy")).alias("accuracy_lost")
    ).join(F.broadcast(gain_df), "feature")


def _assembled(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Label, weight and scaled vector of train rows and label and vector of test rows, each made and written once."""
    ready = with_class_weight(_typed(train, columns))
    prepare = Pipeline(stages=_stages(columns, "logistic", {})[:-1]).fit(ready)
    fit_rows = stored(prepare.transform(ready).select(LABEL, WEIGHT, "features"))
    return fit_rows, stored(prepare.transform(_typed(test, columns)).select(LABEL, "features"))


def prune_features(
    df: DataFrame, columns: Sequence[str], max_lost: float = 0.0, folds: int = 3, parallel: int = PARALLEL_FITS
) -> DataFrame:
    """Backward elimination by walk-forward accuracy of the logistic model, one row per input in the order tried.

    Each step refits every expanding fold without the input of the least standardized coefficients among those not yet
    tried. The input goes if the accuracy over all test rows falls by at most ``max_lost`` (negative: it rose), and
    the refitted model is the next step's; otherwise it stays. ``accuracy_lost`` is what was lost when it was tried;
    an input that would be the last one is not tried. Inputs are tried once, so there are as many refits as
    inputs, on matrices written once per fold; the fits of a step run at the same time.
    """
    spark, names = df.sparkSession, list(columns)
    parts = [_assembled(train, test, names) for _, train, test in expanding_folds(df, folds)]

    def walk(kept: list[str]) -> tuple[float, dict[str, float]]:
        cut = VectorSlicer(inputCol="features", outputCol="kept_features", indices=[names.index(c) for c in kept])
        lr = LogisticRegression(labelCol=LABEL, weightCol=WEIGHT, featuresCol="kept_features", maxIter=20)

        def on_fold(part: tuple[DataFrame, DataFrame]):
            fit_rows, check_rows = part
            model = lr.fit(cut.transform(fit_rows))
            hit = F.col("prediction") == F.col(LABEL)
            right, n = model.transform(cut.transform(check_rows)).agg(F.count_if(hit), F.count(F.lit(1))).first()
            return right, n, np.abs(model.coefficients.toArray())

        right, n, sizes = zip(*pool.map(inheritable_thread_target(spark)(on_fold), parts))
        return sum(right) / max(sum(n), 1), dict(zip(kept, sum(sizes).tolist()))

    tried, kept, open_ = [], list(names), list(names)
    with ThreadPool(parallel) as pool:
        accuracy, sizes = walk(kept)
        while open_ and len(kept) > 1:
            least = min(open_, key=lambda c: sizes[c])
            open_.remove(least)
            without, sizes_without = walk([c for c in kept if c != least])
            lost = accuracy - without
            if lost <= max_lost:
                kept.remove(least)
                accuracy, sizes = without, sizes_without
            tried.append((len(tried) + 1, least, least in kept, lost, accuracy))
    tried += [(len(tried) + 1, c, True, None, accuracy) for c in open_]
    return spark.createDataFrame(tried, "step int, feature string, kept boolean, accuracy_lost double, accuracy double")


def tune_params(
    df: DataFrame, columns: Sequence[str], reg_params: Sequence[float] = (0.0, 0.01, 0.1), max_trials: int = 50,
    folds: int = 4, parallel: int = PARALLEL_FITS,
) -> DataFrame:
    """Grid search inside expanding folds; the caller keeps the last period out of ``df``.

    One row per setting and fold with its ROC-AUC. A fold's rows are weighted, scaled and assembled once; all settings
    are fitted on that matrix, ``parallel`` at a time.
    """
    spark = df.sparkSession
    lr = LogisticRegression(labelCol=LABEL, weightCol=WEIGHT, featuresCol="features", maxIter=20)
    grid = ParamGridBuilder().addGrid(lr.regParam, list(reg_params)).build()
    if len(grid) > max_trials:
        raise ValueError(f"{len(grid)} settings exceed the limit of {max_trials} trials")
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction")
    results = []
    with ThreadPool(parallel) as pool:
        for fold, train, test in expanding_folds(df, folds):
            fit_rows, check_rows = _assembled(train, test, columns)

            def trial(setting):
                found = evaluator.evaluate(lr.copy(setting).fit(fit_rows).transform(check_rows))
                return (fold, *[float(v) for v in setting.values()], found)

            results += pool.map(inheritable_thread_target(spark)(trial), grid)
    return spark.createDataFrame(results, "fold int, reg_param double, roc_auc double")


def optimality(model: PipelineModel, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Certificate of an unpenalized logistic fit: one row per term with its coefficient and the loss's gradient in it.

    ``mean`` and ``stddev`` are those that scale the input (NULL for the intercept), ``coefficient`` belongs to the scaled
    input, and ``gradient`` is that of the mean weighted log loss over ``train``. The loss is convex, so a
    gradient near 0 proves the fit. All of it comes from one aggregate over the rows.
    """
    scaler, fitted = model.stages[-2], model.stages[-1]
    if fitted.getRegParam():
        raise ValueError("the gradient of a penalized fit is not zero at its optimum")
    scored = score(model, with_class_weight(_typed(train, columns)), columns)
    miss = F.col(WEIGHT) * (F.col("p_up") - F.col(LABEL))
    mean, std = scaler.mean.toArray().tolist(), scaler.std.toArray().tolist()
    terms = [("intercept", F.lit(1.0), None, None, float(fitted.intercept))] + [
        (c, (F.col(c) - m) / F.lit(s) if s else F.lit(0.0), m, s, float(b))
        for c, m, s, b in zip(columns, mean, std, fitted.coefficients.toArray())
    ]
    sums = scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(LABEL) == 1).alias("n_up"), F.sum(WEIGHT).alias("_weight"),
        *[F.sum(miss * x).alias(f"_g{i}") for i, (_, x, *_) in enumerate(terms)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(term).alias("term"), F.lit(m).cast("double").alias("mean"), F.lit(s).cast("double").alias("stddev"),
            F.lit(b).alias("coefficient"), F.try_divide(f"_g{i}", "_weight").alias("gradient"),
        ) for i, (term, _, m, s, b) in enumerate(terms)
    ])
    return sums.select("n", "n_up", F.explode(rows).alias("_t")).select("_t.term", "n", "n_up", "_t.mean", "_t.stddev", "_t.coefficient", "_t.gradient")


def batch_score(
    model: PipelineModel, features: DataFrame, columns: Sequence[str], threshold: float, wanted: DataFrame | None = None
) -> DataFrame:
    """The current signal of every symbol: symbol, as_of, direction, probability, threshold."""
    newest = latest_per_symbol(features, wanted)
    return score(model, newest, columns).select(
        "symbol", F.col("event_time").alias("as_of"),
        F.when(F.col("p_up") > threshold, "up").otherwise("not_up").alias("direction"),
        F.col("p_up").alias("probability"), F.lit(threshold).alias("threshold"),
    )
