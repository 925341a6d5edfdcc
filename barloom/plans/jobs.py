"""The job chain: candles to features, labels, model dataset and snapshot, in order."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.plans.daily import daily_features
from barloom.plans.intraday import intraday_features
from barloom.plans.labels import join_model_dataset, labels
from barloom.sources import schemas, tables
from barloom.sources.bars import split_rejects


def usable_bars(spark: SparkSession, root: str, name: str, schema, key) -> DataFrame:
    """Stored bars with all keys and prices; the others are set aside in ``rejects/<name>`` with the reason."""
    usable, rejected = split_rejects(tables.read_table(spark, root, name, schema), key)
    rejected.write.mode("overwrite").parquet(f"{root}/rejects/{name}")
    return usable


def refresh_daily_features(spark: SparkSession, root: str, warmup: str = "partial") -> int:
    """Full refresh in the partial dialect; partial-column upsert in the strict one."""
    bars = usable_bars(spark, root, "market_candles_daily", schemas.CANDLES_DAILY, schemas.DAILY_KEY)
    features = daily_features(bars, warmup)
    name, schema = "daily_market_features", schemas.DAILY_FEATURES
    if warmup == "partial":
        return tables.refresh_table(features, root, name, schema)
    written = [f.name for f in schemas.DAILY_FEATURES_STRICT.fields if f.name not in schemas.DAILY_KEY]
    tables.upsert_table(features, root, name, schema, schemas.DAILY_KEY, written, sequence="event_date")
    return tables.read_table(spark, root, name, schema).count()


def refresh_intraday_features(spark: SparkSession, root: str) -> int:
    bars = usable_bars(spark, root, "market_candles_5m", schemas.CANDLES_INTRADAY, ("symbol", "event_time"))
    return tables.refresh_table(
        intraday_features(bars), root, "intraday_market_features", schemas.INTRADAY_FEATURES
    )


def refresh_labels(spark: SparkSession, root: str) -> int:
    stored = tables.read_table(spark, root, "intraday_market_features", schemas.INTRADAY_FEATURES)
    return tables.refresh_table(labels(stored), root, "intraday_training_dataset", schemas.LABELS)


def refresh_model_dataset(spark: SparkSession, root: str) -> int:
    features = tables.read_table(spark, root, "intraday_market_features", schemas.INTRADAY_FEATURES)
    label_rows = tables.read_table(spark, root, "intraday_training_dataset", schemas.LABELS)
    return tables.refresh_table(
        join_model_dataset(features, label_rows), root, "intraday_model_dataset", schemas.MODEL_DATASET
    )


def run_jobs(spark: SparkSession, root: str, day: str) -> DataFrame:
    """All jobs in dependency order over the stored candles; one audit row per table."""
    counts = [
        ("daily_market_features", refresh_daily_features(spark, root)),
        ("intraday_market_features", refresh_intraday_features(spark, root)),
        ("intraday_training_dataset", refresh_labels(spark, root)),
        ("intraday_model_dataset", refresh_model_dataset(spark, root)),
    ]
    dataset = tables.read_table(spark, root, "intraday_training_dataset", schemas.LABELS)
    tables.export_snapshot(dataset, root, day)
    return spark.createDataFrame(counts, "table_name string, row_count long")
