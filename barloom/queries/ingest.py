"""Queries over sources, upserts and streams."""
from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators.monitor import latest_per_symbol
from barloom.queries import sql as Q
from barloom.queries.registry import query
from barloom.sources import bars as B
from barloom.sources import fixtures as X
from barloom.sources import messages as M
from barloom.sources import schemas, tables
from barloom.sources.upsert import BACKFILL_UPDATES, LIVE_UPDATES, merge_upsert
from barloom.streaming.ingest import ingest_bars
from barloom.streaming.publish import high_water_marks, incremental_bars, publish_increment

# The bars table in two overlapping halves; the newer one carries corrected prices.
OLD_END, NEW_START = "2024-01-20 00:00:00", "2024-01-12 00:00:00"
NOW = "2024-02-01 00:00:00"
_KEY = schemas.INTRADAY_KEY


def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


def candles(spark, sf_dir):
    return X.bars_5m(spark, sf_dir).select(
        "symbol", F.lit("NSE").alias("exchange"), *schemas.PRICES, "volume", "event_time",
        F.col("event_time").alias("ingestion_time"),
    )


def stored_half(spark, sf_dir):
    return candles(spark, sf_dir).where(F.col("event_time") < _ts(OLD_END))


def corrected_half(spark, sf_dir):
    df = candles(spark, sf_dir).where(F.col("event_time") >= _ts(NEW_START))
    return df.withColumns(
        {
            "exchange": F.lit("BSE"), "close_price": F.col("close_price") + 1.0,
            "ingestion_time": F.col("ingestion_time") + F.expr("INTERVAL 1 HOUR"),
        }
    )


_halves = f"""{Q.BARS_5M},
candles AS (SELECT symbol, 'NSE' AS exchange, open_price, high_price, low_price, close_price, volume, event_time,
                   event_time AS ingestion_time FROM bars),
old AS (SELECT * FROM candles WHERE event_time < TIMESTAMP '{OLD_END}'),
new AS (SELECT * REPLACE ('BSE' AS exchange, close_price + 1.0 AS close_price,
                          ingestion_time + INTERVAL 1 HOUR AS ingestion_time)
        FROM candles WHERE event_time >= TIMESTAMP '{NEW_START}')"""


def _upsert_sql(exchange: str, touched: str = f"TIMESTAMP '{NOW}'") -> str:
    price = ", ".join(
        f"CASE WHEN n.symbol IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}"
        for c in ("open_price", "high_price", "low_price", "close_price", "volume")
    )
    return f"""WITH {_halves}
    SELECT coalesce(o.symbol, n.symbol) AS symbol, {exchange} AS exchange, {price},
           coalesce(o.event_time, n.event_time) AS event_time,
           CASE WHEN o.symbol IS NULL THEN n.ingestion_time WHEN n.symbol IS NULL THEN o.ingestion_time
                ELSE {touched} END AS ingestion_time
    FROM old o FULL OUTER JOIN new n ON o.symbol = n.symbol AND o.event_time = n.event_time"""


@query("high_water_mark", f"WITH {_halves} SELECT symbol, max(event_time) AS mark FROM old GROUP BY 1")
def high_water_mark(spark, sf_dir):
    return high_water_marks(stored_half(spark, sf_dir)).withColumnRenamed("_mark", "mark")


@query("incremental_bars", f"""WITH {_halves},
  marks AS (SELECT symbol, max(event_time) AS mark FROM old GROUP BY 1),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC) AS back FROM candles)
  SELECT r.symbol, exchange, open_price, high_price, low_price, close_price, volume, event_time, ingestion_time
  FROM ranked r LEFT JOIN marks m ON r.symbol = m.symbol WHERE back > 1 AND (mark IS NULL OR event_time > mark)""")
def incremental(spark, sf_dir):
    return incremental_bars(candles(spark, sf_dir), stored_half(spark, sf_dir))


@query("upsert_full", _upsert_sql("CASE WHEN n.symbol IS NOT NULL THEN n.exchange ELSE o.exchange END"))
def upsert_full(spark, sf_dir):
    """The live writer: a conflict replaces the exchange too."""
    return merge_upsert(
        stored_half(spark, sf_dir), corrected_half(spark, sf_dir), _KEY, LIVE_UPDATES, "ingestion_time",
        touch="ingestion_time", now=_ts(NOW),
    )


@query("upsert_backfill", _upsert_sql("coalesce(o.exchange, n.exchange)"))
def upsert_backfill(spark, sf_dir):
    """The 1-minute backfill: the stored exchange stays."""
    return merge_upsert(
        stored_half(spark, sf_dir), corrected_half(spark, sf_dir), _KEY, BACKFILL_UPDATES, "ingestion_time",
        touch="ingestion_time", now=_ts(NOW),
    )


@query("upsert_prices_only", _upsert_sql("coalesce(o.exchange, n.exchange)", touched="o.ingestion_time"))
def upsert_prices_only(spark, sf_dir):
    """The 5-minute backfill: nothing but prices and volume."""
    return merge_upsert(
        stored_half(spark, sf_dir), corrected_half(spark, sf_dir), _KEY, BACKFILL_UPDATES, "ingestion_time"
    )


@query("upsert_daily", f"""WITH {Q.BARS_DAILY},
  old AS (SELECT * FROM bars WHERE event_date < DATE '1998-01-01'),
  new AS (SELECT * REPLACE (close_price + 1.0 AS close_price) FROM bars WHERE event_date >= DATE '1996-01-01')
  SELECT coalesce(o.symbol, n.symbol) AS symbol, coalesce(o.event_date, n.event_date) AS event_date,
         coalesce(n.open_price, o.open_price) AS open_price, coalesce(n.high_price, o.high_price) AS high_price,
         coalesce(n.low_price, o.low_price) AS low_price, coalesce(n.close_price, o.close_price) AS close_price,
         coalesce(n.volume, o.volume) AS volume
  FROM old o FULL OUTER JOIN new n ON o.symbol = n.symbol AND o.event_date = n.event_date""")
def upsert_daily(spark, sf_dir):
    bars = X.bars_daily(spark, sf_dir)
    old = bars.where(F.col("event_date") < F.lit("1998-01-01").cast("date"))
    new = bars.where(F.col("event_date") >= F.lit("1996-01-01").cast("date")).withColumn(
        "close_price", F.col("close_price") + 1.0
    )
    return merge_upsert(old, new, schemas.DAILY_KEY, BACKFILL_UPDATES, "event_date")


@query("upsert_partial", f"""WITH {_halves},
  target AS (SELECT symbol, event_time, close_price, volume AS kept_volume FROM old),
  source AS (SELECT symbol, event_time, CASE WHEN volume > 50 THEN close_price END AS close_price FROM new)
  SELECT coalesce(t.symbol, s.symbol) AS symbol, coalesce(t.event_time, s.event_time) AS event_time,
         CASE WHEN s.symbol IS NOT NULL THEN s.close_price ELSE t.close_price END AS close_price, kept_volume
  FROM target t FULL OUTER JOIN source s ON t.symbol = s.symbol AND t.event_time = s.event_time""")
def upsert_partial(spark, sf_dir):
    """Source without all target columns and with NULLs: NULLs replace, absent columns stay."""
    target = stored_half(spark, sf_dir).select("symbol", "event_time", "close_price", F.col("volume").alias("kept_volume"))
    source = corrected_half(spark, sf_dir).select(
        "symbol", "event_time", F.when(F.col("volume") > 50, F.col("close_price")).alias("close_price")
    )
    return merge_upsert(target, source, _KEY, ["close_price"], "event_time")


@query("upsert_last_arrival", f"""WITH {Q.BARS_5M},
  per_key AS (SELECT symbol, CAST(event_time AS DATE) AS event_date, arg_max(close_price, event_time) AS close_price,
                     arg_min(open_price, event_time) AS open_price, count(*) AS n FROM bars GROUP BY 1, 2)
  SELECT symbol, event_date, close_price, open_price,
         CASE WHEN n > 1 THEN TIMESTAMP '{NOW}' END AS touched_at FROM per_key""")
def upsert_last_arrival(spark, sf_dir):
    """Many source rows per key into an empty table: the first inserts, the last one wins updates."""
    source = X.bars_5m(spark, sf_dir).select(
        "symbol", F.to_date("event_time").alias("event_date"), "close_price", "open_price", "event_time",
        F.lit(None).cast("timestamp_ntz").alias("touched_at"),
    )
    target = source.drop("event_time").limit(0)
    return merge_upsert(
        target, source, schemas.DAILY_KEY, ["close_price"], "event_time", touch="touched_at", now=_ts(NOW)
    )


@query("json_roundtrip", f"""WITH {_halves}
  SELECT symbol, exchange, open_price, high_price, low_price, close_price, volume, event_time, ingestion_time
  FROM candles""")
def json_roundtrip(spark, sf_dir):
    return M.decode_bars(M.encode_bars(candles(spark, sf_dir)))


@query("json_messages", f"""WITH {_halves} SELECT
  strftime(event_time, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS event_time,
  symbol, round(close_price, 2) AS close_price, volume FROM candles""")
def json_messages(spark, sf_dir):
    """The text on the wire, read back without the decoder."""
    text = M.encode_bars(candles(spark, sf_dir))
    field = lambda n: F.get_json_object("value", f"$.{n}")
    return text.select(
        field("event_time").alias("event_time"), field("symbol").alias("symbol"),
        field("close_price").cast("double").alias("close_price"), field("volume").cast("long").alias("volume"),
    )


@query("json_rejects", f"""WITH {_halves} SELECT symbol, count(*) AS rejected FROM candles
  WHERE volume > 100 GROUP BY 1""")
def json_rejects(spark, sf_dir):
    """Messages that lost their last character are set aside; the others go on."""
    text = M.encode_bars(candles(spark, sf_dir))
    cut = F.when(
        F.get_json_object("value", "$.volume").cast("long") > 100, F.expr("left(value, length(value) - 1)")
    ).otherwise(F.col("value"))
    bad = M.rejected(text.select(cut.alias("value")))
    return bad.select(F.regexp_extract("value", '"symbol":"([^"]+)"', 1).alias("symbol")).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rejected")
    )


@query("normalize_bars_5m", f"""WITH {Q.BARS_5M}
  SELECT symbol, 'NSE' AS exchange, open_price, high_price, low_price, close_price, volume,
         event_time + INTERVAL 330 MINUTE AS event_time, CAST(NULL AS TIMESTAMP) AS ingestion_time FROM bars""")
def normalize_bars_5m(spark, sf_dir):
    """Vendor frame with two-level headers and UTC instants -> naive IST candles."""
    bars = X.bars_5m(spark, sf_dir)
    vendor = bars.select(
        "symbol", F.concat(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("Datetime"),
        *[F.col(p).alias(f"{p.split('_')[0].capitalize()}.{'X'}") for p in schemas.PRICES],
        F.col("volume").alias("Volume.X"),
    )
    return B.normalize_bars(vendor, "5m")


@query("normalize_bars_1m", f"""WITH {Q.BARS_5M}
  SELECT symbol, 'NSE' AS exchange, open_price, high_price, low_price, close_price, volume, event_time FROM bars""")
def normalize_bars_1m(spark, sf_dir):
    vendor = X.bars_5m(spark, sf_dir).select(
        "symbol", F.concat(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")).alias("Datetime"),
        *[F.col(p).alias(p.split("_")[0].capitalize()) for p in schemas.PRICES], F.col("volume").alias("Volume"),
    )
    return B.normalize_bars(vendor, "1m").drop("ingestion_time")


@query("loader_window", f"""WITH {Q.BARS_5M}
  SELECT symbol, event_time, close_price FROM bars
  WHERE event_time > TIMESTAMP '2024-01-25 12:00:00' - INTERVAL 8 DAYS AND event_time <= TIMESTAMP '2024-01-25 12:00:00'""")
def loader_window(spark, sf_dir):
    """Landed one-minute history cut to what a load at noon asks for: the eight days before it."""
    recent = B.within_history(X.bars_5m(spark, sf_dir), "1m", _ts("2024-01-25 12:00:00"))
    return recent.select("symbol", "event_time", "close_price")


@query("normalize_bars_1d", f"""WITH {Q.BARS_DAILY}
  SELECT symbol, open_price, high_price, low_price, close_price, volume, event_date FROM bars""")
def normalize_bars_1d(spark, sf_dir):
    vendor = X.bars_daily(spark, sf_dir).select(
        "symbol", F.col("event_date").alias("Date"),
        *[F.col(p).alias(p.split("_")[0].capitalize()) for p in schemas.PRICES], F.col("volume").alias("Volume"),
    )
    return B.normalize_bars(vendor, "1d", "Date").drop("ingestion_time")


@query("live_candles", f"""WITH {Q.BARS_5M} SELECT symbol, event_time,
  {", ".join(f"{Q.half_up(f'{p} / 3', 2)} AS {p}" for p in schemas.PRICES)}, volume FROM bars
  WHERE symbol IN ('click', 'view', 'error')""")
def live_candles(spark, sf_dir):
    """Universe filter and 2-digit prices of the live path."""
    bars = X.bars_5m(spark, sf_dir).withColumns({p: F.col(p) / 3 for p in schemas.PRICES})
    return B.round_prices(B.in_universe(bars, ("click", "view", "error"))).select(
        "symbol", "event_time", *schemas.PRICES, "volume"
    )


@query("ordered_bars", f"""WITH {Q.BARS_DAILY}
  SELECT symbol, event_date, open_price, high_price, low_price, close_price, volume FROM bars ORDER BY 1, 2""")
def ordered_bars(spark, sf_dir):
    return X.bars_daily(spark, sf_dir).select(
        "symbol", "event_date", *schemas.PRICES, "volume"
    ).orderBy("symbol", "event_date")


@query("preview_bars", f"""WITH {Q.BARS_DAILY}
  SELECT symbol, event_date, open_price, high_price, low_price, close_price, volume FROM bars ORDER BY 1, 2 LIMIT 20""")
def preview_bars(spark, sf_dir):
    return tables.preview(ordered_bars(spark, sf_dir), 20)


@query("distinct_symbols", f"WITH {Q.BARS_DAILY} SELECT DISTINCT symbol FROM bars")
def distinct_symbols(spark, sf_dir):
    return X.bars_daily(spark, sf_dir).select("symbol").distinct()


@query("row_count_audit", f"WITH {Q.BARS_DAILY} SELECT count(*) AS row_count FROM bars")
def row_count_audit(spark, sf_dir):
    return X.bars_daily(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))


@query("concat_bars", f"""WITH {_halves} SELECT symbol, event_time, close_price, ingestion_time FROM old
  UNION ALL SELECT symbol, event_time, close_price, ingestion_time FROM new""")
def concat_bars(spark, sf_dir):
    cols = ["symbol", "event_time", "close_price", "ingestion_time"]
    return stored_half(spark, sf_dir).select(*cols).unionByName(corrected_half(spark, sf_dir).select(*cols))


@query("latest_per_symbol", f"""WITH {_halves} SELECT symbol, exchange, open_price, high_price, low_price, close_price,
  volume, event_time, ingestion_time FROM candles QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC) = 1""")
def latest(spark, sf_dir):
    return latest_per_symbol(candles(spark, sf_dir))


@query("latest_wanted", f"""WITH {_halves}, wanted AS (SELECT DISTINCT symbol FROM candles UNION ALL SELECT 'unknown'),
  newest AS (SELECT * FROM candles QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC) = 1)
  SELECT w.symbol, n.event_time, n.close_price, n.symbol IS NOT NULL AS found
  FROM wanted w LEFT JOIN newest n ON w.symbol = n.symbol""")
def latest_wanted(spark, sf_dir):
    """Asked-for symbols, also those without rows."""
    bars = candles(spark, sf_dir).select("symbol", "event_time", "close_price")
    wanted = bars.select("symbol").distinct().unionByName(
        bars.agg(F.first(F.lit("unknown")).alias("symbol"))
    )
    return latest_per_symbol(bars, wanted)


@query("stream_bars_upsert", f"""WITH {_halves}
  SELECT symbol, exchange, open_price, high_price, low_price, round(close_price, 2) AS close_price, volume, event_time
  FROM (SELECT * FROM new UNION ALL
    SELECT * FROM old o WHERE NOT EXISTS
      (SELECT 1 FROM new n WHERE n.symbol = o.symbol AND n.event_time = o.event_time))""")
def stream_bars_upsert(spark, sf_dir):
    """Both halves as message files, corrections last, merged by the stream in two batches."""
    work = tables.scratch_dir(spark, "stream-bars")
    root, inbox, checkpoint = f"{work}/tables", f"{work}/inbox", f"{work}/checkpoint"
    for half in (stored_half, corrected_half):
        M.write_files(M.encode_bars(half(spark, sf_dir)), inbox)
        ingest_bars(M.stream_files(spark, inbox), root, checkpoint).awaitTermination()
    table = tables.read_table(spark, root, "market_candles_1m", schemas.CANDLES_INTRADAY)
    return table.drop("ingestion_time")


@query("table_refresh", f"""WITH {_halves} SELECT symbol, exchange, open_price, high_price, low_price, close_price,
  volume, event_time, ingestion_time FROM new""")
def table_refresh(spark, sf_dir):
    """A stored table replaced as a whole by the second write."""
    root = f"{tables.scratch_dir(spark, 'refresh')}/tables"
    for half in (stored_half, corrected_half):
        tables.refresh_table(half(spark, sf_dir), root, "market_candles_5m", schemas.CANDLES_INTRADAY)
    return tables.read_table(spark, root, "market_candles_5m", schemas.CANDLES_INTRADAY)


@query("table_upsert", _upsert_sql("CASE WHEN n.symbol IS NOT NULL THEN n.exchange ELSE o.exchange END"))
def table_upsert(spark, sf_dir):
    """A stored table into which the corrected half is merged, rewriting only its days."""
    root = f"{tables.scratch_dir(spark, 'upsert')}/tables"
    for half in (stored_half, corrected_half):
        tables.upsert_table(
            half(spark, sf_dir), root, "market_candles_5m", schemas.CANDLES_INTRADAY, _KEY, LIVE_UPDATES,
            "ingestion_time", touch="ingestion_time", now=_ts(NOW),
        )
    return tables.read_table(spark, root, "market_candles_5m", schemas.CANDLES_INTRADAY)


@query("publish_and_ingest", f"""WITH {_halves}, newest AS (SELECT symbol, max(event_time) AS last FROM candles GROUP BY 1)
  SELECT c.symbol, exchange, open_price, high_price, low_price, close_price, volume, event_time
  FROM candles c JOIN newest n ON c.symbol = n.symbol WHERE event_time < last
  UNION ALL SELECT o.symbol, exchange, open_price, high_price, low_price, close_price, volume, event_time
  FROM old o JOIN newest n ON o.symbol = n.symbol WHERE event_time = last""")
def publish_and_ingest(spark, sf_dir):
    """What the stored table lacks is published, ingested by the stream, and then nothing is missing."""
    work = tables.scratch_dir(spark, "publish")
    root, inbox, name = f"{work}/tables", f"{work}/inbox", "market_candles_1m"
    tables.refresh_table(stored_half(spark, sf_dir), root, name, schemas.CANDLES_INTRADAY)
    for _ in range(2):
        held = tables.read_table(spark, root, name, schemas.CANDLES_INTRADAY)
        publish_increment(candles(spark, sf_dir), held, inbox)
        ingest_bars(M.stream_files(spark, inbox), root, f"{work}/checkpoint").awaitTermination()
    return tables.read_table(spark, root, name, schemas.CANDLES_INTRADAY).drop("ingestion_time")
