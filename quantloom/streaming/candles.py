"""Streams of ticks and candles: resampling with a watermark, and keyed upserts of each micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.upsert import upsert_partitions


def resample(ticks: DataFrame, interval: str, watermark: str | None = None, time: str = "ts", value: str = "value", key: str = "symbol", order: str = "event_id") -> DataFrame:
    """Candles of ticks in tumbling windows; the same for a table and, with a watermark, for a stream."""
    if watermark:
        ticks = ticks.withWatermark(time, watermark)
    at = F.struct(time, order)
    out = ticks.groupBy(F.window(time, interval).alias("w"), key).agg(F.min_by(value, at).alias("open"), F.max_by(value, at).alias("close"), F.max(value).alias("high"), F.min(value).alias("low"), F.count(F.lit(1)).alias("volume"))
    return out.select(key, F.col("w.start").alias("timeframe"), "open", "close", "high", "low", "volume")


def upsert_stream(stream: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], checkpoint: str, once: bool = True):
    """Start a query that merges each micro-batch into the table at ``path``; later corrections of a key win.

    A batch that is run again after a failure merges to the same table.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: upsert_partitions(batch, path, keys, partition_by))
    return (writer.trigger(availableNow=True) if once else writer).start()


def append_candles(ticks: DataFrame, path: str, checkpoint: str, interval: str, watermark: str, **names: str) -> int:
    """Append to ``path`` the candles of all ticks that have arrived, once the watermark has passed their window's end.

    Open windows stay in the state at ``checkpoint`` until a later call. Gives how many rows came too late: they change
    nothing that is written (Spark counts them after the first aggregation, by window and key of each task).
    """
    out = resample(ticks, interval, watermark, **names)
    query = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
