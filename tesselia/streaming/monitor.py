"""Watching runs: event counts and seconds in time windows, from folders of events that still grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

EVENT_SCHEMA = "event_id long, ts timestamp, run_id long, event string, seconds double"


def event_stream(spark: SparkSession, folder: str, schema: str = EVENT_SCHEMA, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(folder)


def windowed_counts(events: DataFrame, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts and sums per window and event; events later than ``late`` are left out."""
    by = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event")
    return by.agg(F.count(F.lit(1)).alias("n"), F.sum("seconds").alias("seconds")).select(F.col("window.start").alias("start"), "event", "n", "seconds")
