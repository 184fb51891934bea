"""Structured Streaming forms of the accumulating operators; each equals its batch form once the stream is drained."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.graph import upsert


def timed(events: DataFrame, at: str = "ts", late: str = "1 hour") -> DataFrame:
    """``events`` with a watermark; times without a zone are taken as UTC, as watermarks need a zone."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)


def tumbling(events: DataFrame, size: str = "1 hour", at: str = "ts") -> DataFrame:
    """``(start, event_type, events, value)`` by windows; batch or stream."""
    value = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value")
    out = events.groupBy(F.window(at, size).alias("w"), "event_type").agg(F.count("*").alias("events"), value)
    return out.select(F.col("w.start").alias("start"), "event_type", "events", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", at: str = "ts") -> DataFrame:
    """``(user_id, start, last, events)``: a user's events that are less than ``gap`` apart; batch or stream."""
    out = events.groupBy("user_id", F.session_window(at, gap).alias("w")).agg(F.count("*").alias("events"), F.max(at).alias("last"))
    return out.select("user_id", F.col("w.start").alias("start"), "last", "events")


def first_seen(events: DataFrame, keys: list[str]) -> DataFrame:
    """A row a key within the watermark: what a replay brings again goes."""
    return events.dropDuplicatesWithinWatermark(keys)


def memory(log: DataFrame) -> DataFrame:
    """Query patterns of a stream of ``(question, ts, confidence)``, in update or complete mode."""
    last = F.max(F.struct("ts", "confidence")).alias("last")
    return log.groupBy("question").agg(F.count("*").alias("asks"), last).select("question", "asks", F.col("last.confidence").alias("last_confidence"), F.col("last.ts").alias("last_asked_at"))


def drain(df: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Writes all that is there as Parquet and ends; started again with the same checkpoint it goes on from where it was."""
    query = df.writeStream.format("parquet").outputMode(mode).option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def upserting(changes: DataFrame, keys: list[str], read: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Merges each batch of changes into a table; ``write`` gets the merged table and the batch's number and must not overwrite what ``read`` reads."""

    def each(batch: DataFrame, number: int) -> None:
        write(upsert(read(), batch, keys), number)

    query = changes.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def service(ticks: DataFrame, cycle: Callable[[int], None], checkpoint: str, every: str = "1 hour") -> StreamingQuery:
    """Runs a maintenance cycle for each trigger of a stream of ticks, until stopped."""
    return ticks.writeStream.foreachBatch(lambda _, number: cycle(number)).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
