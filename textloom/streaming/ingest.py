"""Incremental preparation: message rows arriving as a stream, repeated deliveries dropped within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.operators import turns


def deliveries(messages: DataFrame, late: str = "7 days") -> DataFrame:
    """First deliveries of a stream of message rows: equal conversation, number, role and content within ``late`` are one message.

    State holds a hash per message and is dropped behind the watermark on received_at. Rows without a whole number pass,
    as the rebuilt conversation has to know of them.
    """
    ev = turns.events(messages.withWatermark("received_at", late), "received_at")
    return ev.withColumn("h", F.xxhash64("conversation_id", "turn", "role", "content")).dropDuplicatesWithinWatermark(["h"]).drop("h")


def append(messages: DataFrame, path: str, checkpoint: str, late: str = "7 days", once: bool = True) -> StreamingQuery:
    """Write first deliveries to Parquet; ``once`` takes what is there and stops."""
    w = deliveries(messages, late).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w).start()
