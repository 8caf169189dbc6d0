"""Windowed rollup of a log stream that waits for late records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell.streaming.logs import TRIGGER


def traffic_rollup(logs: DataFrame, window: str = "5 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Connections and bytes per protocol and window of event time.

    On a stream in append mode a window is emitted once the watermark has passed
    it, and its state is dropped then; on a batch it is a plain aggregate.
    """
    volume = F.col("bytes_sent").cast("bigint") + F.col("bytes_received")
    return (
        logs.withWatermark("event_timestamp", lateness)
        .groupBy(F.window("event_timestamp", window).alias("_window"), "protocol")
        .agg(F.count("*").alias("connections"), F.sum(volume).alias("total_bytes"))
        .select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"),
                "protocol", "connections", "total_bytes")
    )


def write_rollup_stream(rolled: DataFrame, checkpoint: str, path: str, available_now: bool = False) -> StreamingQuery:
    """Append each window once the watermark has passed it; open windows wait in the state below ``checkpoint``.

    A query that is started again with the same checkpoint goes on with that state and the watermark reached.
    """
    writer = rolled.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)
    return writer.start(path)
