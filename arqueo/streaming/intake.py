"""Incremental intake of a source that is still growing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(file_format).load(path)


def land_available(stream: DataFrame, target: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """Append all files that are new since the last run, each exactly once, and stop."""
    out = prepare(stream) if prepare else stream
    query = out.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    query.awaitTermination()
    return query


def with_delay(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Events by their time ``ts``, of which none is awaited longer than ``late``."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def windowed_totals(events: DataFrame, window: str = "1 day") -> DataFrame:
    """Count and exact total by event type and window, for events with a bounded delay."""
    amount = F.col("value").cast("decimal(24,2)")
    return (
        events.groupBy(F.window("ts", window).alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(amount).cast("decimal(38,2)").alias("total"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
    )


def unique_events(events: DataFrame, key: list[str]) -> DataFrame:
    """Without repeats that arrive within the delay; the state is bounded by it."""
    return events.dropDuplicatesWithinWatermark(key)
