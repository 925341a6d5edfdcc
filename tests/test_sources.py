"""Ingest, upsert, storage and streaming."""
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import minute_rows

from barloom.functions import iso_to_ist, ist_to_utc, to_ist
from barloom.plans.jobs import refresh_daily_features, run_jobs
from barloom.sources import bars as B
from barloom.sources import messages as M
from barloom.sources import schemas, tables
from barloom.sources.upsert import BACKFILL_UPDATES, LIVE_UPDATES, merge_upsert
from barloom.streaming.ingest import ingest_bars
from barloom.streaming.publish import drop_forming_bar, incremental_bars

NOW = datetime(2024, 2, 1)
CANDLE = "symbol string, exchange string, open_price double, high_price double, low_price double, close_price double, volume long, event_time timestamp_ntz, ingestion_time timestamp_ntz"


def candle(symbol, minute, close, exchange="NSE", ingested=0):
    t = datetime(2024, 1, 1, 9, 15 + minute)
    return (symbol, exchange, close, close, close, close, 10, t, datetime(2024, 1, 1, 10, ingested))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    "text,want",
    [
        ("2024-01-01T09:15:00+05:30", datetime(2024, 1, 1, 9, 15)),
        ("2024-01-01T03:45:00Z", datetime(2024, 1, 1, 9, 15)),
        ("2024-01-01T03:45:00.250000+00:00", datetime(2024, 1, 1, 9, 15, 0, 250000)),
        ("2023-12-31T22:45:00-05:00", datetime(2024, 1, 1, 9, 15)),
        ("2024-01-01T09:15:00", datetime(2024, 1, 1, 9, 15)),
        ("2024-01-01", datetime(2024, 1, 1)),
        ("soon", None),
        (None, None),
    ],
)
def test_iso_to_naive_ist(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(iso_to_ist(F.col("t")).alias("x")).first()["x"]
    assert got == want


def test_ist_and_back(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 3, 45),)], "t timestamp_ntz")
    r = df.select(to_ist(F.col("t")).alias("ist"), ist_to_utc(to_ist(F.col("t"))).alias("utc")).first()
    assert (r["ist"], r["utc"]) == (datetime(2024, 1, 1, 9, 15), datetime(2024, 1, 1, 3, 45))


def test_new_rows_keep_their_stamp_and_conflicts_touch_it(spark):
    target = spark.createDataFrame([candle("A", 0, 1.0, "OLD"), candle("A", 1, 2.0)], CANDLE)
    source = spark.createDataFrame(
        [candle("A", 0, 5.0, "NEW", 5), candle("B", 0, 7.0, "NSE", 6), candle("C", 0, 1.0, "X1", 1), candle("C", 0, 2.0, "X2", 2)],
        CANDLE,
    )
    now = F.lit(NOW).cast("timestamp_ntz")
    live = merge_upsert(target, source, schemas.INTRADAY_KEY, LIVE_UPDATES, "ingestion_time", "ingestion_time", now)
    got = {(r.symbol, r.event_time.minute): (r.exchange, r.close_price, r.ingestion_time) for r in live.collect()}
    assert got == {
        ("A", 15): ("NEW", 5.0, NOW),
        ("A", 16): ("NSE", 2.0, datetime(2024, 1, 1, 10, 0)),
        ("B", 15): ("NSE", 7.0, datetime(2024, 1, 1, 10, 6)),
        ("C", 15): ("X2", 2.0, NOW),
    }
    backfill = merge_upsert(target, source, schemas.INTRADAY_KEY, BACKFILL_UPDATES, "ingestion_time")
    assert {(r.symbol, r.event_time.minute): (r.exchange, r.close_price) for r in backfill.collect()} == {
        ("A", 15): ("OLD", 5.0), ("A", 16): ("NSE", 2.0), ("B", 15): ("NSE", 7.0), ("C", 15): ("X1", 2.0),
    }


def test_null_overwrites_and_absent_columns_stay(spark):
    target = spark.createDataFrame([("A", date(2024, 1, 1), 1.0, 9.0)], "symbol string, event_date date, x double, kept double")
    source = spark.createDataFrame([("A", date(2024, 1, 1), None), ("B", date(2024, 1, 1), 2.0)], "symbol string, event_date date, x double")
    out = merge_upsert(target, source, schemas.DAILY_KEY, ["x"], "event_date")
    assert rows(out.select("symbol", "x", "kept")) == [("A", None, 9.0), ("B", 2.0, None)]


def test_stored_upsert_is_idempotent_and_leaves_other_days(spark, tmp_path):
    root = str(tmp_path)
    january = [candle("A", i, float(i)) for i in range(3)]
    march = [(*candle("A", 0, 1.0)[:7], datetime(2024, 3, 1), datetime(2024, 3, 1))]
    tables.refresh_table(spark.createDataFrame(january + march, CANDLE), root, "t", schemas.CANDLES_INTRADAY)
    march = tables.last_commit(spark, f"{root}/t").parts["2024-03-01"]
    batch = spark.createDataFrame([candle("A", 1, 50.0, ingested=9), candle("A", 7, 8.0)], CANDLE)
    args = (root, "t", schemas.CANDLES_INTRADAY, schemas.INTRADAY_KEY, LIVE_UPDATES, "ingestion_time")
    for _ in range(2):
        tables.upsert_table(batch, *args)
        got = {(r.event_time, r.close_price) for r in tables.read_table(spark, root, "t", schemas.CANDLES_INTRADAY).collect()}
        assert {c for t, c in got if t.month == 1} == {0.0, 50.0, 2.0, 8.0} and len(got) == 5
    assert tables.last_commit(spark, f"{root}/t").parts["2024-03-01"] == march
    pruned = tables.read_table(spark, root, "t", schemas.CANDLES_INTRADAY, since="2024-02")
    assert pruned.count() == 1


def test_uncommitted_version_is_not_read_and_vacuum_removes_it(spark, tmp_path):
    root = str(tmp_path)
    tables.refresh_table(spark.createDataFrame([candle("A", 0, 1.0)], CANDLE), root, "t", schemas.CANDLES_INTRADAY)
    staged = spark.createDataFrame([candle("A", 0, 9.0)], CANDLE).withColumn("event_part", F.lit("2024-01-01"))
    staged.write.partitionBy("event_part").parquet(f"{root}/t/v-lost")
    read = lambda: [r.close_price for r in tables.read_table(spark, root, "t", schemas.CANDLES_INTRADAY).collect()]
    assert read() == [1.0]
    assert tables.vacuum(spark, root, "t") == 1 and not (tmp_path / "t" / "v-lost").exists() and read() == [1.0]


def test_reader_keeps_its_version_and_writers_do_not_mix(spark, tmp_path):
    root, args = str(tmp_path), ("t", schemas.CANDLES_INTRADAY)
    first = spark.createDataFrame([candle("A", 0, 1.0)], CANDLE)
    tables.refresh_table(first, root, *args)
    opened = tables.read_table(spark, root, *args)
    stale = tables.last_commit(spark, f"{root}/t")
    tables.refresh_table(spark.createDataFrame([candle("A", 0, 2.0)], CANDLE), root, *args)
    assert opened.first().close_price == 1.0
    assert tables.read_table(spark, root, *args).first().close_price == 2.0
    with pytest.raises(OSError):
        tables._commit(spark, f"{root}/t", tables.Commit(stale.number + 1, stale.parts))
    assert tables.read_table(spark, root, *args).first().close_price == 2.0


def test_replayed_batch_keeps_ingestion_time(spark, tmp_path):
    root = str(tmp_path)
    batch = spark.createDataFrame([candle("A", 0, 5.0)], CANDLE)
    times = []
    for hour in (1, 2):
        tables.upsert_table(
            batch, root, "t", schemas.CANDLES_INTRADAY, schemas.INTRADAY_KEY, LIVE_UPDATES, "ingestion_time",
            touch="ingestion_time", now=F.lit(datetime(2024, 5, 1, hour)).cast("timestamp_ntz"), batch=("s", 0),
        )
        times.append(tables.read_table(spark, root, "t", schemas.CANDLES_INTRADAY).first().ingestion_time)
    assert times[0] == times[1]


def test_forming_bar_and_increment(bars):
    fetched = bars(minute_rows("A", [1.111, 2.222, 3.333]), minute_rows("B", [5.0]), minute_rows("C", [1.0, 2.0]))
    assert sorted(r.symbol for r in drop_forming_bar(fetched).collect()) == ["A", "A", "C"]
    stored = bars(minute_rows("A", [1.0]))
    out = incremental_bars(fetched, stored)
    assert sorted((r.symbol, r.close_price) for r in out.collect()) == [("A", 2.22), ("C", 1.0)]


def test_rejects(spark):
    good = '{"symbol":"A","exchange":"NSE","open_price":1,"high_price":1,"low_price":1,"close_price":1,"volume":5,"event_time":"2024-01-01T09:15:00+05:30","ingestion_time":"2024-01-01T09:16:00"}'
    bad = [good[:-3], good.replace('"A"', "null"), good.replace("2024-01-01T09:15:00+05:30", "later"), "not json"]
    df = spark.createDataFrame([(t,) for t in [good, *bad]], "value string")
    kept = M.decode_bars(df).collect()
    assert len(kept) == 1 and kept[0].event_time == datetime(2024, 1, 1, 9, 15)
    assert sorted(r.value for r in M.rejected(df).collect()) == sorted(bad)
    ok, out = B.split_rejects(M.decode_bars(df).withColumn("close_price", F.lit(None).cast("double")), schemas.INTRADAY_KEY)
    assert ok.count() == 0 and out.first()["reject_reason"] == "close_price is missing"


def test_vendor_instants_and_headers(spark):
    df = spark.sql("SELECT 'A' AS symbol, TIMESTAMP '2024-01-01 03:45:00' AS Datetime, 1.005D AS `Open.A`, 2D AS `High.A`, 0.5D AS `Low.A`, 1.5D AS `Close.A`, 7 AS `Volume.A`")
    r = B.normalize_bars(df, "5m").first()
    assert (r.event_time, r.open_price, r.volume, r.ingestion_time) == (datetime(2024, 1, 1, 9, 15), 1.005, 7, None)
    with pytest.raises(ValueError):
        B.normalize_bars(df, "2h")


def _message_files(spark, path, groups):
    for g in groups:
        M.write_files(M.encode_bars(spark.createDataFrame(g, CANDLE)).coalesce(1), path)


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_stream_result_does_not_depend_on_batches(spark, tmp_path, files_per_batch):
    """Late, repeated and corrected bars; the newest ingestion time wins whatever the batching."""
    groups = [
        [candle("A", 0, 1.0, ingested=1), candle("A", 1, 2.0, ingested=2)],
        [candle("A", 5, 6.0, ingested=7), candle("B", 0, 9.0, ingested=3)],
        [candle("A", 1, 2.5, ingested=8), candle("A", 2, 3.0, ingested=9)],
    ]
    inbox = str(tmp_path / "inbox")
    _message_files(spark, inbox, groups)
    for _ in range(2):
        ingest_bars(
            M.stream_files(spark, inbox, files_per_batch), str(tmp_path / "db"), str(tmp_path / "ckpt"),
            rejects_path=str(tmp_path / "rejects"),
        ).awaitTermination()
    got = tables.read_table(spark, str(tmp_path / "db"), "market_candles_1m", schemas.CANDLES_INTRADAY)
    assert {(r.symbol, r.event_time.minute - 15, r.close_price) for r in got.collect()} == {
        ("A", 0, 1.0), ("A", 1, 2.5), ("A", 2, 3.0), ("A", 5, 6.0), ("B", 0, 9.0),
    }
    assert got.count() == 5


def test_strict_dialect_keeps_columns_it_does_not_write(spark, sf_dir, tmp_path):
    from barloom.sources import fixtures as X

    root = str(tmp_path)
    daily = X.bars_daily(spark, sf_dir).withColumn("ingestion_time", F.lit(None).cast("timestamp_ntz"))
    tables.refresh_table(daily, root, "market_candles_daily", schemas.CANDLES_DAILY)
    n = refresh_daily_features(spark, root, "partial")
    before = tables.read_table(spark, root, "daily_market_features", schemas.DAILY_FEATURES)
    kept = ["symbol", "event_date", "return_5d_pct", "return_20d_pct", "close_vs_sma20_pct", "rolling_volatility_20"]
    held = sorted(map(tuple, before.select(*kept).collect()), key=repr)
    assert before.where("sma_20 is null").count() == 0
    assert refresh_daily_features(spark, root, "strict") == n
    after = tables.read_table(spark, root, "daily_market_features", schemas.DAILY_FEATURES)
    assert sorted(map(tuple, after.select(*kept).collect()), key=repr) == held
    assert after.where("sma_20 is null").count() > 0


def test_job_chain_writes_every_table(spark, sf_dir, tmp_path):
    from barloom.queries.ingest import candles
    from barloom.sources import fixtures as X

    root = str(tmp_path)
    daily = X.bars_daily(spark, sf_dir).withColumn("ingestion_time", F.lit(None).cast("timestamp_ntz"))
    tables.refresh_table(daily, root, "market_candles_daily", schemas.CANDLES_DAILY)
    tables.refresh_table(candles(spark, sf_dir), root, "market_candles_5m", schemas.CANDLES_INTRADAY)
    audit = {r.table_name: r.row_count for r in run_jobs(spark, root, "20240131").collect()}
    assert audit["intraday_training_dataset"] == audit["intraday_model_dataset"] > 0
    assert (tmp_path / "snapshots" / "intraday_20240131.parquet").exists()
    facts = spark.read.json(f"{root}/snapshots/intraday_20240131.json").first()
    assert facts["rows"] == audit["intraday_training_dataset"]


def test_publishing_again_adds_nothing(spark, bars, tmp_path):
    from barloom.streaming.publish import publish_increment

    fetched = bars(minute_rows("A", [1.0, 2.0, 3.0]), minute_rows("B", [4.0, 5.0]))
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "db")
    counts = []
    for _ in range(2):
        held = tables.read_table(spark, root, "market_candles_1m", schemas.CANDLES_INTRADAY)
        publish_increment(fetched, held, inbox)
        ingest_bars(M.stream_files(spark, inbox), root, str(tmp_path / "ckpt")).awaitTermination()
        counts.append((spark.read.text(inbox).count(), tables.read_table(spark, root, "market_candles_1m", schemas.CANDLES_INTRADAY).count()))
    assert counts == [(3, 3), (3, 3)]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_landed_files(spark, tmp_path, fmt):
    df = spark.createDataFrame(
        [("TCS.NS", "2024-01-01T03:45:00+00:00", 1.5, 2.0, 1.0, 1.75, 10), ("X", "2024-01-01T03:50:00+00:00", 1.0, 1.0, 1.0, 1.0, 1)],
        "symbol string, Datetime string, Open double, High double, Low double, Close double, Volume long",
    )
    writer = df.write.option("header", True) if fmt == "csv" else df.write
    writer.format(fmt).save(str(tmp_path / "in"))
    out = B.in_universe(B.normalize_bars(B.read_landed(spark, str(tmp_path / "in"), fmt, df.schema), "1m"))
    r = out.collect()
    assert [(x.symbol, x.event_time, x.exchange, x.close_price) for x in r] == [("TCS.NS", datetime(2024, 1, 1, 9, 15), "NSE", 1.75)]
    assert r[0].ingestion_time is not None


def test_news_stream_drops_repeated_urls(spark, tmp_path):
    from barloom.operators.news import dedupe_news_stream

    schema = "url string, published_at timestamp_ntz"
    for i, u in enumerate(["u1", "u2", "u1"]):
        spark.createDataFrame([(u, datetime(2024, 1, 1, i))], schema).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema.replace("timestamp_ntz", "timestamp")).json(str(tmp_path / "in"))
    q = (
        dedupe_news_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["u1", "u2"]


def test_results_do_not_depend_on_the_session_zone(spark, sf_dir):
    from oracle_check import compare, connect

    from barloom.queries import ORACLES, QUERIES

    con = connect(sf_dir)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("intraday_features_full", "json_roundtrip", "normalize_bars_5m", "symbol_sentiment", "table_upsert"):
            assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_predictions_meet_outcomes_in_streams(spark, tmp_path):
    from barloom.streaming.live import match_outcomes_stream

    times = [datetime(2024, 1, 1, 9, m) for m in (0, 5, 10)]
    preds = spark.createDataFrame([("A", t, 0.9) for t in times], "symbol string, event_time timestamp, probability double")
    known = spark.createDataFrame([("A", t, i % 2) for i, t in enumerate(times[:2])], "symbol string, event_time timestamp, target_direction int")
    preds.write.parquet(str(tmp_path / "p"))
    known.write.parquet(str(tmp_path / "o"))
    read = lambda d, df: spark.readStream.schema(df.schema).parquet(str(tmp_path / d))
    q = (
        match_outcomes_stream(read("p", preds), read("o", known)).writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.event_time, r.is_right) for r in out.collect()) == [(times[0], False), (times[1], True)]


def run_stream(spark, folder, schema, plan, batches):
    """Each batch is landed and taken by a run of its own, so every run starts from the checkpoint of the one before."""
    (folder / "in").mkdir()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder / "in"))
        out = plan(spark.readStream.schema(schema).parquet(str(folder / "in")))
        out.writeStream.format("parquet").option("path", str(folder / "out")).option(
            "checkpointLocation", str(folder / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(str(folder / "out")).collect()


def test_rolling_performance_goes_on_after_a_restart(spark, tmp_path):
    import random

    from pyspark.sql import functions as F

    from barloom.operators.monitor import live_performance
    from barloom.streaming.live import rolling_performance_stream

    draw = random.Random(2)
    schema = "symbol string, event_time timestamp, probability double, is_right boolean"
    rows = [(s, datetime(2024, 1, 1) + timedelta(minutes=m), draw.random(), draw.random() < 0.6) for m in range(130) for s in ("A", "B")]
    parts = [rows[:30], rows[30:31], rows[31:200], rows[200:]]
    shuffled = [draw.sample(p, len(p)) for p in parts]
    got = run_stream(spark, tmp_path, schema, lambda s: rolling_performance_stream(s, 0.5, rows=20), shuffled)
    up = F.col("probability") > 0.5
    batch = spark.createDataFrame(rows, schema).withColumn("target_direction", F.when(up == F.col("is_right"), 1).otherwise(0))
    want = live_performance(batch.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")), 0.5, rows=20).collect()
    plain = lambda found: sorted(
        (r.symbol, r.event_time, r.predictions, round(r.rolling_accuracy, 9), None if r.rolling_precision is None else round(r.rolling_precision, 9),
         r.below_expected) for r in found)
    assert plain(got) == plain(want) and len(got) == 260


def test_silence_is_told_once_and_again_after_a_return(spark, tmp_path):
    from barloom.streaming.live import stale_alerts_stream

    at = lambda h, m=0: datetime(2024, 1, 1) + timedelta(hours=h, minutes=m)
    batches = [
        [("A", at(0)), ("B", at(0))], [("A", at(1))], [("A", at(3))],  # B falls silent
        [("A", at(4))], [("A", at(5)), ("B", at(5))],  # and returns
        [("A", at(6))], [("A", at(8))], [("A", at(9))],  # and falls silent again
    ]
    got = run_stream(spark, tmp_path, "symbol string, event_time timestamp", lambda s: stale_alerts_stream(s, "2 hours"), batches)
    assert sorted((r.subject, r.last_seen, r.silent_until) for r in got) == [("B", at(0), at(2)), ("B", at(5), at(7))]


def test_drift_watch_tells_shifted_windows(spark, tmp_path):
    from barloom.streaming.live import drift_alerts_stream, training_bins

    at = lambda h, i: datetime(2024, 1, 1) + timedelta(hours=h, seconds=i)
    trained = training_bins(spark.createDataFrame([(float(i % 100), 1.0) for i in range(1_000)], "x double, y double"), ["x", "y"])
    shares = {r.feature: r.shares for r in trained.collect()}
    assert shares["x"] == [0.1] * 10 and shares["y"] == [1.0] + [0.0] * 9
    same = [(at(1, i), float(i % 100), 1.0) for i in range(200)]
    moved = [(at(3, i), 50.0 + i % 50, None) for i in range(200)]
    later = [(at(9, 0), 0.0, 1.0)]
    plan = lambda s: drift_alerts_stream(s, trained, ["x", "y"], 0.2, "2 hours")
    got = run_stream(spark, tmp_path, "event_time timestamp, x double, y double", plan, [same, moved, later, later])
    assert [(r.subject, r.window_end, r.rows) for r in got] == [("x", at(4, 0), 200)]
    assert got[0].value > 3


def test_loader_windows(spark):
    """A window ends with the load and leaves out the moment it starts from; dates count whole days."""
    from pyspark.sql import functions as F

    from barloom.sources.bars import HISTORY_DAYS, within_history

    now = datetime(2024, 3, 1, 12)
    for interval, days in HISTORY_DAYS.items():
        at = [now, now + timedelta(seconds=1), now - timedelta(days=days), now - timedelta(days=days) + timedelta(seconds=1), None]
        bars = spark.createDataFrame([(i, t) for i, t in enumerate(at)], "i int, event_time timestamp_ntz")
        kept = within_history(bars, interval, F.lit("2024-03-01 12:00:00").cast("timestamp_ntz"))
        assert sorted(r.i for r in kept.collect()) == [0, 3]
