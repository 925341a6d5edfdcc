"""Bar messages into the candle table.

There is no watermark: late, repeated and corrected bars are settled by the key.
The table remembers the last batch it took from each stream (its checkpoint), so a replayed
batch changes nothing, ``ingestion_time`` included.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from barloom.sources.messages import decode_bars, rejected
from barloom.sources.schemas import CANDLES_INTRADAY, INTRADAY_KEY
from barloom.sources.tables import upsert_table
from barloom.sources.upsert import LIVE_UPDATES


def ingest_bars(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    name: str = "market_candles_1m",
    sequence: str | Sequence[str] = "ingestion_time",
    rejects_path: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with a Kafka source pass ``("timestamp", "partition", "offset")`` as sequence."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read for the touched days, for the merge and for the rejects
        try:
            upsert_table(
                decode_bars(batch), root, name, CANDLES_INTRADAY, INTRADAY_KEY,
                LIVE_UPDATES, sequence, touch="ingestion_time", batch=(checkpoint, batch_id),
            )
            if rejects_path:
                rejected(batch).write.mode("overwrite").text(f"{rejects_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = messages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
