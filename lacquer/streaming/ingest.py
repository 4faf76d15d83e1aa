"""Incremental ingest with Structured Streaming: seen keys, watermark upsert, versioned sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup
from ..session import exists


def landed(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int = 64) -> DataFrame:
    """A stream over the files of a landing folder."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)


def new_only(stream: DataFrame, keys: list[str], event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """First row per key; with an event time the state is dropped after `delay`."""
    if event_time and delay:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def run_available(stream: DataFrame, target: str, checkpoint: str, partition_by: list[str] | None = None) -> None:
    """Everything that has landed, then stop; a restart goes on where it ended."""
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (writer.partitionBy(*partition_by) if partition_by else writer).start().awaitTermination()


def append_above_watermark(spark: SparkSession, target: str, date: str, order: list[str]) -> Callable[[DataFrame, int], None]:
    """foreachBatch: rows later than the latest stored date, the last of each date.

    Each batch overwrites its own batch_id partition, so a batch that is tried again
    after a lost executor or driver leaves no second copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if exists(spark, target):  # any failure to read what is stored ends the batch
            existing = spark.read.parquet(target).where(F.col("batch_id") < batch_id)
        else:
            existing = batch.limit(0)
        fresh = dedup.above_watermark(batch, existing.select(date), date, order)
        fresh.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return write


def counted_by_window(stream: DataFrame, event_time: str, keys: list[str], width: str, delay: str) -> DataFrame:
    """Counts per key and tumbling window; rows later than `delay` are dropped."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), *keys).agg(F.count(F.lit(1)).alias("n"))
