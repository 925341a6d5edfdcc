"""Turning landed vendor files into candle rows."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import IST, iso_to_ist
from barloom.sources import schemas

EXCHANGE = "NSE"
# The tracked universe.
UNIVERSE = ("RELIANCE.NS", "TCS.NS", "INFY.NS", "HDFCBANK.NS", "ICICIBANK.NS")
# History each interval covers.
HISTORY_DAYS = {"1m": 8, "5m": 60, "1d": 5 * 365}


def read_landed(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    """Landed vendor files, several per directory; the schema is given, never inferred."""
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True) if fmt == "csv" else reader.format(fmt).load(path)


def flatten_headers(df: DataFrame) -> DataFrame:
    """Keep the first level of two-level headers such as ``Close.TCS``."""
    return df.toDF(*[c.split(".", 1)[0] for c in df.columns])


def in_universe(df: DataFrame, symbols: Sequence[str] = UNIVERSE) -> DataFrame:
    return df.where(F.col("symbol").isin(*symbols))


def local_time(df: DataFrame, column: str) -> Column:
    """A vendor time column as naive IST: instants are converted, naive values are IST already."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return iso_to_ist(F.col(column))
    if isinstance(kind, T.TimestampType):
        return F.convert_timezone(None, F.lit(IST), F.col(column).cast("timestamp_ntz"))
    return F.col(column).cast("timestamp_ntz")


def round_prices(df: DataFrame, digits: int = 2) -> DataFrame:
    """Live bars carry 2-digit prices and whole volumes."""
    return df.withColumns(
        {**{p: F.round(F.col(p).cast("double"), digits) for p in schemas.PRICES},
         "volume": F.col("volume").cast("long")}
    )


def normalize_bars(
    vendor: DataFrame, interval: str, time_column: str = "Datetime", exchange: str = EXCHANGE
) -> DataFrame:
    """Vendor frame (symbol, time, Open, High, Low, Close, Volume) -> candle rows.

    ``1m`` and ``5m`` give intraday candles keyed by naive IST time, ``1d`` gives
    daily candles keyed by date.  Prices are not rounded; only 1m rows are stamped.
    """
    if interval not in HISTORY_DAYS:
        raise ValueError(f"interval must be one of {sorted(HISTORY_DAYS)}, not {interval!r}")
    df = flatten_headers(vendor)
    prices = [F.col(p.split("_")[0].capitalize()).cast("double").alias(p) for p in schemas.PRICES]
    volume = F.col("Volume").cast("long").alias("volume")
    if interval == "1d":
        rows = df.select(
            "symbol", *prices, volume, F.to_date(F.col(time_column)).alias("event_date"),
            F.lit(None).cast("timestamp_ntz").alias("ingestion_time"),
        )
        return schemas.conform(rows, schemas.CANDLES_DAILY)
    stamp = F.localtimestamp() if interval == "1m" else F.lit(None)
    rows = df.select(
        "symbol", F.lit(exchange).alias("exchange"), *prices, volume,
        local_time(df, time_column).alias("event_time"), stamp.cast("timestamp_ntz").alias("ingestion_time"),
    )
    return schemas.conform(rows, schemas.CANDLES_INTRADAY)


def within_history(bars: DataFrame, interval: str, as_of: Column, ts: str = "event_time") -> DataFrame:
    """Bars of the window that a loader asks for: ``HISTORY_DAYS`` of the interval up to ``as_of``."""
    return bars.where((F.col(ts) > as_of - F.make_dt_interval(F.lit(HISTORY_DAYS[interval]))) & (F.col(ts) <= as_of))


def split_rejects(bars: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows with a reason): keys and prices must be present."""
    reason = F.concat_ws(
        ", ", *[F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in (*key, *schemas.PRICES)]
    )
    marked = bars.withColumn("reject_reason", reason)
    return (
        marked.where(F.col("reject_reason") == "").drop("reject_reason"),
        marked.where(F.col("reject_reason") != ""),
    )
