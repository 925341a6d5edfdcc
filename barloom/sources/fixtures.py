"""Bar, news and prediction views derived from the star-schema test tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per order priority and order date."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    return o.groupBy(
        F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("event_date")
    ).agg(
        F.min_by(price, "o_orderkey").alias("open_price"),
        F.max(price).alias("high_price"),
        F.min(price).alias("low_price"),
        F.max_by(price, "o_orderkey").alias("close_price"),
        F.count(F.lit(1)).alias("volume"),
    )


def ticks(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col(symbol).cast("string").alias("symbol"),
        F.col("ts").cast("timestamp_ntz").alias("event_time"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("volume"),
    )


def bars_from_ticks(tick_df: DataFrame, interval: str) -> DataFrame:
    """Open, high, low, close and volume of the ticks in each interval."""
    return (
        tick_df.groupBy("symbol", F.window("event_time", interval).alias("_w"))
        .agg(
            F.min_by("price", "event_time").alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", "event_time").alias("close_price"),
            F.sum("volume").alias("volume"),
        )
        .select(
            "symbol", F.col("_w.start").alias("event_time"),
            "open_price", "high_price", "low_price", "close_price", "volume",
        )
    )


def bars_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_ticks(ticks(spark, sf_dir), "5 minutes")


def with_gaps(bars: DataFrame, ts: str) -> DataFrame:
    """Bars of which two in a row lack a close: days 7 and 8 of a week of the month, or ten minutes of every 35."""
    at = F.col(ts)
    given = F.dayofmonth(at) % 7 >= 2 if ts == "event_date" else (F.hour(at) * 60 + F.minute(at)) % 35 >= 10
    return bars.withColumn("close_price", F.when(given, F.col("close_price")))


def bars_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many short series: every event is a bar of its user."""
    t = ticks(spark, sf_dir, "user_id")
    p = F.col("price")
    return t.select(
        "symbol", "event_time",
        p.alias("open_price"), p.alias("high_price"), p.alias("low_price"), p.alias("close_price"), "volume",
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as news: two documents share a URL, times are spread over the month of the bars."""
    d = table(spark, sf_dir, "documents")
    # The five series names of the events table, in doc_id order.
    symbols = F.array(*[F.lit(s) for s in ("click", "error", "purchase", "signup", "view")])
    # 7,919 shares no factor with the seconds of 30 days: every second comes up before one comes up again
    second = (F.col("doc_id") * 7_919) % (30 * 86_400)
    return d.select(
        "doc_id",
        F.element_at(symbols, (F.col("doc_id") % 5 + 1).cast("int")).alias("symbol"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), second.cast("decimal(18,6)"))).alias("published_at"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("body"),
        F.concat(F.lit("https://news/"), F.floor(F.col("doc_id") / 2).cast("string")).alias("url"),
        "source",
    )
