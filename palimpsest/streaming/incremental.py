"""Resumable runs over arriving files with Structured Streaming: what a checkpoint has seen is not read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def take_new(spark: SparkSession, folder: str, schema: str, checkpoint: str, step: Callable[[DataFrame, int], None], files: int = 1000) -> None:
    """Run ``step(rows, batch number)`` on the Parquet files that have come since the last call, then stop.

    ``step`` must be safe to repeat with the same number, as a batch that was cut off is run again.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)
    query = rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def first_arrivals(spark: SparkSession, folder: str, schema: str, key: list[str], time: str, delay: str = "7 days") -> DataFrame:
    """A stream of the first row of each key; what is later than ``delay`` may be given again, so state stays bounded."""
    rows = spark.readStream.schema(schema).parquet(folder)
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)
