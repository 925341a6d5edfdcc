"""Incremental publishing: the finished bars a table does not have yet."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.series import attach
from barloom.sources.bars import round_prices
from barloom.sources.messages import TOPIC, encode_bars, write_files, write_topic


def drop_forming_bar(bars: DataFrame) -> DataFrame:
    """All but the newest bar of each symbol; a symbol with one bar yields nothing."""
    newest = bars.groupBy("symbol").agg(F.max("event_time").alias("_newest"))
    return attach(bars, newest, "symbol", "event_time").where(F.col("event_time") < F.col("_newest")).drop("_newest")


def high_water_marks(stored: DataFrame) -> DataFrame:
    return stored.groupBy("symbol").agg(F.max("event_time").alias("_mark"))


def newer_than_stored(bars: DataFrame, stored: DataFrame) -> DataFrame:
    """Bars strictly after the newest stored bar of their symbol; all of them if none is stored."""
    joined = attach(bars, high_water_marks(stored), "symbol", "event_time", "left")
    return joined.where(F.col("_mark").isNull() | (F.col("event_time") > F.col("_mark"))).drop("_mark")


def incremental_bars(bars: DataFrame, stored: DataFrame) -> DataFrame:
    """Finished bars beyond the mark; newest bar and mark of a symbol are attached together, in one join."""
    newest = bars.groupBy("symbol").agg(F.max("event_time").alias("_newest"))
    limits = newest.join(high_water_marks(stored), "symbol", "left")
    late = F.col("_mark").isNull() | (F.col("event_time") > F.col("_mark"))
    due = attach(bars, limits, "symbol", "event_time").where((F.col("event_time") < F.col("_newest")) & late)
    return round_prices(due.drop("_newest", "_mark"))


def publish_increment(bars: DataFrame, stored: DataFrame, path: str) -> None:
    """Append the missing finished bars to the message folder."""
    write_files(encode_bars(incremental_bars(bars, stored)), path)


def publish_increment_to_topic(bars: DataFrame, stored: DataFrame, servers: str, topic: str = TOPIC) -> None:
    write_topic(encode_bars(incremental_bars(bars, stored)), servers, topic)
