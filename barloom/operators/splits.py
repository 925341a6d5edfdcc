"""Time-ordered splits and folds; training rows always lie before test rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import series as S
from barloom.operators.scan import ordered_prefix
from barloom.sources.tables import scratch_dir

SPLIT, FOLD = "split", "fold"


def _ranked_times(df: DataFrame, ts: str) -> DataFrame:
    """Distinct times with ``n_below``, the number of earlier ones, and ``n_total`` of all."""
    return ordered_prefix(df.select(ts).distinct(), ts, {"n": F.lit(1)})


def _labelled(is_train: Column) -> Column:
    return F.when(is_train, F.lit("train")).otherwise(F.lit("test"))


def time_split(df: DataFrame, ts: str = "event_time", train_share: float = 0.8) -> DataFrame:
    """The earliest share of distinct times is train, the rest test, for all symbols alike."""
    in_train = F.col("n_below") < F.floor(F.col("n_total") * F.lit(train_share))
    cut = _ranked_times(df, ts).where(in_train).agg(F.max(ts)).scalar()
    return df.withColumn(SPLIT, _labelled(F.col(ts) <= cut))


def time_split_per_symbol(
    df: DataFrame, by: str = "symbol", ts: str = "event_time", train_share: float = 0.8,
    slice_seconds: int = S.SLICE_INTRADAY,
) -> DataFrame:
    """The earliest share of each symbol's rows is train."""
    totals = df.groupBy(by).agg(F.count(F.lit(1)).alias("_total"))
    indexed = S.attach(S.index_series(df, by, ts, slice_seconds), totals, by, ts)
    is_train = F.col(S.RN) <= F.floor(F.col("_total") * F.lit(train_share))
    return indexed.withColumn(SPLIT, _labelled(is_train)).drop(S.RN, "_total")


def time_buckets(df: DataFrame, n: int, ts: str = "event_time") -> DataFrame:
    """Add ``fold`` 0..n-1: equal groups of consecutive distinct times, larger groups first."""
    ranked = _ranked_times(df, ts)
    size, big = F.floor(F.col("n_total") / n), F.col("n_total") % n
    edge = big * (size + 1)
    r = F.col("n_below")
    bucket = F.when(r < edge, F.floor(r / (size + 1))).otherwise(big + F.floor(F.try_divide(r - edge, size)))
    starts = (
        ranked.groupBy(bucket.alias(FOLD)).agg(F.min(ts).alias("start"))
        .agg(F.array_sort(F.collect_list("start"))).scalar()
    )
    return (
        df.withColumn("_starts", starts)
        .withColumn(FOLD, F.size(F.filter("_starts", lambda s: s <= F.col(ts))) - 1)
        .drop("_starts")
    )


def expanding_folds(df: DataFrame, n: int, ts: str = "event_time"):
    """Yield (fold, train, test): train on all earlier groups, test on group ``fold``.

    The grouped rows are written once, partitioned by fold, so each fold reads only
    its own partitions.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "folds")
    time_buckets(df, n, ts).write.partitionBy(FOLD).parquet(path)
    stored = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(FOLD, T.IntegerType())])).parquet(path)
    for k in range(1, n):
        yield k, stored.where(F.col(FOLD) < k).drop(FOLD), stored.where(F.col(FOLD) == k).drop(FOLD)
