"""Structured Streaming over append-only events: an extension of our own for telemetry-like tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stream over Parquet files of events, ``ts`` as a TIMESTAMP so that it can carry a watermark."""
    return spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_rollup(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window and type; state older than the watermark is dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("calls"), F.sum(F.greatest("value", F.lit(0.0))).alias("total")).select(F.col("w.start").alias("start"), "event_type", "calls", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("events")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "events")


def first_seen(events: DataFrame, key: list[str], late: str = "2 hours") -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(key)


def drain(stream: DataFrame, name: str, checkpoint: str, mode: str = "complete"):
    """Run a stream over what there is into a memory table and stop (tests and small results)."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
