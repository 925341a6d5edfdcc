"""News rows: ingestion, lexicon sentiment, trailing sentiment, as-of attachment."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.scan import asof_join
from barloom.sources import schemas

# Words and signed weights of the default lexicon.
LEXICON = {
    "beat": 0.75, "boost": 0.5, "bullish": 1.0, "gain": 0.5, "growth": 0.5, "jump": 0.5, "profit": 0.75,
    "rally": 0.75, "record": 0.5, "rise": 0.5, "strong": 0.5, "surge": 1.0, "upgrade": 1.0, "win": 0.5,
    "bearish": -1.0, "crash": -1.0, "cut": -0.5, "decline": -0.5, "default": -1.0, "downgrade": -1.0,
    "drop": -0.5, "fall": -0.5, "fraud": -1.0, "loss": -0.75, "miss": -0.75, "plunge": -1.0, "weak": -0.5,
}
LABEL_EDGE = 0.05


def ingest_news(articles: DataFrame, tie: str = "doc_id") -> DataFrame:
    """One article per URL, the earliest published; repeated URLs merge before the shuffle."""
    cols = schemas.NEWS.fieldNames()
    extra = [c for c in articles.columns if c not in cols]
    kept = articles.groupBy("url").agg(F.min_by(F.struct(*cols, *extra), F.struct("published_at", tie)).alias("a"))
    return kept.select("a.*")


def dedupe_news_stream(articles: DataFrame, delay: str = "2 days") -> DataFrame:
    """Streaming form: the first arrival of a URL within the delay."""
    return articles.withWatermark("published_at", delay).dropDuplicatesWithinWatermark(["url"])


def sentiment_of(text: Column, lexicon: Mapping[str, float]) -> tuple[Column, Column]:
    """(mean weight of the lexicon words in the text, their number); 0 words give score 0.

    The whole text is read inside its row: no explode, no shuffle.
    """
    weights = F.create_map(*[F.lit(v) for pair in lexicon.items() for v in pair])
    words = F.filter(F.split(F.lower(text), "[^a-z]+"), lambda w: F.map_contains_key(weights, w))
    n = F.size(words)
    total = F.aggregate(words, F.lit(0.0), lambda acc, w: acc + F.try_element_at(weights, w))
    return F.coalesce(F.try_divide(total, n.cast("double")), F.lit(0.0)), n


def score_sentiment(articles: DataFrame, text: str = "body", lexicon: Mapping[str, float] = LEXICON) -> DataFrame:
    """Add ``sentiment_score`` in -1..1, ``sentiment_label`` and ``matched_words``."""
    score, n = sentiment_of(F.col(text), lexicon)
    scored = articles.withColumns({"sentiment_score": F.round(score, 4), "matched_words": n})
    s = F.col("sentiment_score")
    return scored.withColumn(
        "sentiment_label",
        F.when(s > LABEL_EDGE, "positive").when(s < -LABEL_EDGE, "negative").otherwise("neutral"),
    )


def symbol_sentiment(scored: DataFrame, bucket: str = "1 hour", trailing_seconds: int = 86_400) -> DataFrame:
    """Mean sentiment over the trailing day per symbol and time bucket that has news.

    Articles are first summed per bucket, so a symbol's window holds one row per
    bucket, not per article.  A row covers news published before ``bucket_end``.
    """
    per_bucket = (
        scored.groupBy("symbol", F.window("published_at", bucket).alias("w"))
        # scores have 4 digits; decimal sums do not depend on the order of the rows
        .agg(F.sum(F.col("sentiment_score").cast("decimal(10,4)")).alias("_sum"), F.count(F.lit(1)).alias("_n"))
        .select("symbol", F.col("w.end").alias("bucket_end"), "_sum", "_n")
        .withColumn(
            "_sec",
            F.unix_date(F.to_date("bucket_end")).cast("long") * 86_400
            + F.hour("bucket_end") * 3_600 + F.minute("bucket_end") * 60 + F.second("bucket_end"),
        )
    )
    day = Window.partitionBy("symbol").orderBy("_sec").rangeBetween(-(trailing_seconds - 1), 0)
    return per_bucket.select(
        "symbol", "bucket_end", F.sum("_n").over(day).alias("articles"),
        F.try_divide(F.sum("_sum").over(day).cast("double"), F.sum("_n").over(day).cast("double")).alias("mean_sentiment"),
    )


def join_sentiment_asof(bars: DataFrame, scored: DataFrame, ts: str = "event_time") -> DataFrame:
    """Attach the newest sentiment published strictly before the bar; several at one instant average."""
    at_instant = scored.groupBy("symbol", F.col("published_at").alias(ts)).agg(
        F.avg("sentiment_score").alias("sentiment_score"), F.max("published_at").alias("sentiment_time")
    )
    return asof_join(bars, at_instant, "symbol", ts, ["sentiment_score", "sentiment_time"], strict=True)
