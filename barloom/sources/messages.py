"""Bar messages: JSON text in, candle rows out, and back."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import iso_to_ist, to_iso_ist
from barloom.sources.bars import EXCHANGE, round_prices
from barloom.sources.schemas import BAR_MESSAGE, CANDLES_INTRADAY, PRICES

TOPIC = "market_candles_1m"
_RAW = "_raw"


def encode_bars(bars: DataFrame) -> DataFrame:
    """One ``value`` column of JSON text per bar; times carry the +05:30 offset."""
    columns = set(bars.columns)
    exchange = F.col("exchange") if "exchange" in columns else F.lit(EXCHANGE)
    stamp = F.col("ingestion_time") if "ingestion_time" in columns else F.localtimestamp()
    body = round_prices(bars).select(
        "symbol", exchange.alias("exchange"), *PRICES, "volume",
        to_iso_ist(F.col("event_time")).alias("event_time"),
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingestion_time"),
    )
    return body.select(F.to_json(F.struct(*BAR_MESSAGE.fieldNames()), {"ignoreNullFields": "false"}).alias("value"))


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Decode every message; ``_bad`` marks those that are malformed or lack a key or price."""
    schema = T.StructType([*BAR_MESSAGE.fields, T.StructField(_RAW, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW}
    text = F.col(value).cast("string")
    rest = [c for c in raw.columns if c != value]
    parsed = raw.select(*rest, text.alias("_text"), F.from_json(text, schema, options).alias("m"))
    rows = parsed.select(
        *rest, "_text", F.col(f"m.{_RAW}").alias(_RAW), "m.symbol", "m.exchange",
        *[F.col(f"m.{p}") for p in PRICES], "m.volume",
        iso_to_ist(F.col("m.event_time")).alias("event_time"),
        iso_to_ist(F.col("m.ingestion_time")).alias("ingestion_time"),
    )
    required = ("symbol", "event_time", *PRICES)
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    return rows.withColumn("_bad", F.col(_RAW).isNotNull() | missing)


def decode_bars(raw: DataFrame, value: str = "value") -> DataFrame:
    """Usable candle rows, plus any arrival columns the source supplied."""
    ours = CANDLES_INTRADAY.fieldNames()
    rest = [c for c in raw.columns if c != value and c not in ours]
    return parse_messages(raw, value).where(~F.col("_bad")).select(*ours, *rest)


def rejected(raw: DataFrame, value: str = "value") -> DataFrame:
    return parse_messages(raw, value).where(F.col("_bad")).select(F.col("_text").alias("value"))


def stream_topic(spark: SparkSession, servers: str, topic: str = TOPIC, options: Mapping[str, str] | None = None) -> DataFrame:
    """Kafka source, from the latest offsets; needs the Kafka connector on the class path."""
    source = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "latest").options(**(options or {})).load()
    )
    return source.select("value", "timestamp", "partition", "offset")


def stream_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same messages as lines of text files."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def write_topic(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_files(messages: DataFrame, path: str) -> None:
    messages.write.mode("append").text(path)
