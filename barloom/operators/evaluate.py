"""Classification metrics, thresholds, walk-forward summaries and run comparison."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.scan import ordered_prefix
from barloom.operators.splits import FOLD, time_buckets


def _share(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def naive_baselines(df: DataFrame, label: str = "target_direction", last_return: str = "candle_return_pct") -> DataFrame:
    """Accuracy of always predicting the majority class, and of repeating the last move."""
    n = F.count(F.lit(1))
    up = F.count_if(F.col(label) == 1)
    predicted_up = F.coalesce(F.col(last_return) > 0, F.lit(False))
    right = F.count_if(predicted_up == (F.col(label) == 1))
    return df.agg(
        n.alias("n"), up.alias("n_up"),
        _share(F.greatest(up, n - up), n).alias("majority_accuracy"),
        _share(right, n).alias("last_candle_accuracy"),
    )


def score_table(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score: positives and negatives at it, above it and in total."""
    y = F.col(label) == 1
    usable = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return ordered_prefix(
        usable.withColumn("_down", -F.col(score)), "_down",
        {"pos": F.when(y, 1).otherwise(0), "neg": F.when(y, 0).otherwise(1)},
    ).select(
        (-F.col("_down")).alias("score"), "pos", "neg",
        F.col("pos_below").alias("pos_above"), F.col("neg_below").alias("neg_above"), "pos_total", "neg_total",
    )


def classification_metrics(
    df: DataFrame, score: str, label: str = "target_direction", threshold: float = 0.5, confident: float = 0.7
) -> DataFrame:
    """One row: confusion counts, accuracy, precision, recall, F1, ROC-AUC, PR-AUC, precision when confident.

    A row is predicted up when its score exceeds the threshold.  ROC-AUC counts ties half;
    PR-AUC is average precision over the distinct scores.
    """
    t = score_table(df, score, label)
    up, sure = F.col("score") > threshold, F.col("score") > confident
    pos, neg = F.col("pos"), F.col("neg")

    def total(cond: Column, c: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, c)), F.lit(0))

    at_or_above = F.col("pos_above") + pos
    precision_here = _share(at_or_above, at_or_above + F.col("neg_above") + neg)
    raw = t.agg(
        total(up, pos).alias("tp"), total(up, neg).alias("fp"),
        total(~up, pos).alias("fn"), total(~up, neg).alias("tn"),
        total(sure, pos).alias("_sure_pos"), total(sure, neg).alias("_sure_neg"),
        # pairs in which the positive scores higher, ties counted half
        F.sum(neg * (F.col("pos_above") + pos / 2.0)).alias("_ordered"),
        F.sum(pos * precision_here).alias("_ap"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n_pos, n_neg = tp + fn, fp + tn
    return raw.select(
        "tp", "fp", "fn", "tn",
        _share(tp + tn, n_pos + n_neg).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, n_pos).alias("recall"),
        _share(tp * 2, tp * 2 + fp + fn).alias("f1"),
        F.try_divide(F.col("_ordered"), n_pos.cast("double") * n_neg.cast("double")).alias("roc_auc"),
        F.try_divide(F.col("_ap"), n_pos.cast("double")).alias("pr_auc"),
        _share(F.col("_sure_pos"), F.col("_sure_pos") + F.col("_sure_neg")).alias("confident_precision"),
    )


def precision_recall_curve(df: DataFrame, score: str, label: str = "target_direction") -> DataFrame:
    """Precision and recall of predicting up at or above each distinct score."""
    t = score_table(df, score, label)
    caught = F.col("pos_above") + F.col("pos")
    flagged = caught + F.col("neg_above") + F.col("neg")
    return t.select(
        F.col("score").alias("threshold"), _share(caught, flagged).alias("precision"),
        _share(caught, F.col("pos_total")).alias("recall"),
    )


def choose_threshold(
    df: DataFrame, score: str, label: str = "target_direction", min_recall: float = 0.3
) -> DataFrame:
    """The threshold of highest precision among those reaching ``min_recall``.

    Ties go to the higher recall, then to the higher threshold.
    """
    curve = precision_recall_curve(df, score, label).where(F.col("recall") >= min_recall)
    best = F.max(F.struct("precision", "recall", "threshold")).alias("b")
    return curve.agg(best).select("b.threshold", "b.precision", "b.recall")


def class_weights(df: DataFrame, label: str = "target_direction") -> DataFrame:
    """Weight per class so that both classes weigh the same in total."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every_class = Window.partitionBy()  # one row per class
    total, classes = F.sum("n").over(every_class), F.count(F.lit(1)).over(every_class)
    return counts.withColumn("weight", _share(total, F.col("n") * classes))


def walk_forward(
    df: DataFrame, score: str, thresholds: Sequence[float], label: str = "target_direction", n: int = 5,
    ts: str = "event_time",
) -> DataFrame:
    """Per run (threshold) and fold: test rows, accuracy and precision on group ``fold``.

    Rows are counted once per fold for all thresholds; only the counts are unfolded into runs.
    """
    scored = time_buckets(df.where(F.col(score).isNotNull()), n, ts).where(F.col(FOLD) >= 1)
    y = F.col(label) == 1

    def run(threshold: float) -> Column:
        up = F.col(score) > threshold
        return F.struct(
            F.lit(float(threshold)).alias("threshold"),
            _share(F.count_if(up == y), F.count(F.lit(1))).alias("accuracy"),
            _share(F.count_if(up & y), F.count_if(up)).alias("precision"),
        )

    per_fold = scored.groupBy(FOLD).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("test_start"), F.array(*[run(t) for t in thresholds]).alias("runs")
    )
    return per_fold.select(FOLD, "n", "test_start", F.explode("runs").alias("run")).select(
        "run.threshold", FOLD, "n", "test_start", "run.accuracy", "run.precision"
    )


def summarize_folds(folds: DataFrame, run: str = "threshold", metric: str = "accuracy") -> DataFrame:
    """Mean and spread of a metric over the folds of each run."""
    return folds.groupBy(run).agg(
        F.count(F.lit(1)).alias("folds"), F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std")
    )


def experiment_rows(summary: DataFrame, run: str, run_prefix: str, metric: str) -> DataFrame:
    """Rows for the append-only run log."""
    return summary.select(
        F.concat(F.lit(run_prefix), F.col(run).cast("string")).alias("run_id"),
        F.to_json(F.struct(run)).alias("params"), F.lit(metric).alias("metric"), "folds", "mean", "std",
    )


def log_experiments(rows: DataFrame, root: str) -> None:
    rows.write.mode("append").parquet(f"{root}/experiment_log")


def compare_experiments(log: DataFrame, metric: str) -> DataFrame:
    """All runs of a metric beside the best mean logged so far."""
    of_metric = log.where(F.col("metric") == metric)
    best = of_metric.agg(F.max("mean")).scalar()
    return of_metric.withColumn("behind_best", best - F.col("mean"))


def promote_if_better(log: DataFrame, champion: str, metric: str) -> DataFrame:
    """One row: the best challenger takes over only with a strictly better mean."""
    rows = log.where(F.col("metric") == metric)
    ranked = F.struct("mean", "run_id")
    return rows.agg(
        F.max(F.when(F.col("run_id") == champion, F.col("mean"))).alias("champion_mean"),
        F.max(F.when(F.col("run_id") != champion, ranked)).alias("c"),
    ).select(
        F.lit(champion).alias("champion"), "champion_mean",
        F.col("c.run_id").alias("challenger"), F.col("c.mean").alias("challenger_mean"),
        F.coalesce(F.col("c.mean") > F.col("champion_mean"), F.col("c.mean").isNotNull()).alias("promoted"),
    )
