"""Incremental ingest and windowed monitoring as streams."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adjudika.plans.ingest import Ingest

WATERMARK = "10 minutes"


def lot_of(checkpoint: str, batch_id: int) -> int:
    """The run number of a stream's batch: 31 bits of the checkpoint's name before 32 bits of the batch."""
    return ((zlib.crc32(checkpoint.rstrip("/").encode()) >> 1) | 1) << 32 | int(batch_id)


def ingest_arrivals(arrivals: DataFrame, ingest: Ingest, checkpoint: str,
                    prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Ingest everything that has arrived since the last run, then stop; run it daily.

    The references seen so far are the stored table itself, so the horizon is unbounded without operator state. A batch
    that is run again after a failure is taken up where it broke off; one that had ended changes nothing. Runs are numbered by checkpoint and
    batch, so streams and batch jobs share a store without taking each other's numbers.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        ingest.run(prepare(batch), lot_of(checkpoint, batch_id))

    return arrivals.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def window_counts(events: DataFrame, by: list[str], width: str = "10 minutes", step: str = "1 minute",
                  watermark: str = WATERMARK) -> DataFrame:
    """Events per sliding window and group; events later than the watermark are dropped. Works on a batch too."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", watermark) if events.isStreaming else timed
    return timed.groupBy(F.window("ts", width, step).alias("_w"), *by).agg(F.count(F.lit(1)).alias("n")).select(
        *by, F.col("_w.start").cast("timestamp_ntz").alias("debut"), F.col("_w.end").cast("timestamp_ntz").alias("fin"), "n")


def first_arrivals(arrivals: DataFrame, key: str, ts: str, horizon: str) -> DataFrame:
    """One row per key within a bounded horizon; the state of a key is dropped after it."""
    return arrivals.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, horizon).dropDuplicatesWithinWatermark(
        [key])


def append_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option(
        "path", path).trigger(availableNow=True).start()
