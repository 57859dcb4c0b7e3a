"""Streams of events: watermarked deduplication, windows, and upserts by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def deduplicated(events: DataFrame, ts: str = "ts", key: str = "event_id", delay: str = "7 days") -> DataFrame:
    """First row of each key; state is dropped once the watermark is past it."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def windowed(events: DataFrame, ts: str = "ts", key: str = "event_type", size: str = "1 day", slide: str | None = None, delay: str = "7 days") -> DataFrame:
    """Counts and sums per window and key; the same code serves batch and stream."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if rows.isStreaming:
        rows = rows.withWatermark(ts, delay)
    return rows.groupBy(w.alias("w"), F.col(key)).agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(20,2)")).alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n", "total")


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop; a later call goes on from the checkpoint."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def for_each_batch(stream: DataFrame, apply, checkpoint: str) -> None:
    """Hand every micro-batch and its number to ``apply``; numbers repeat after a crash, so apply must be idempotent."""
    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
