"""Streams: links that an archive does not know yet, and event counts by time window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import web


def link_stream(spark: SparkSession, folder: str, known: DataFrame) -> DataFrame:
    """New links from text files that arrive in a folder, each once, without those already known."""
    seen = known.select(web.feed_url(F.col("url")).alias("url")).distinct()
    rows = spark.readStream.schema("value string").text(folder).select(web.feed_url(F.col("value")).alias("url")).where("url <> ''")
    return rows.dropDuplicates(["url"]).join(seen, "url", "left_anti")


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and sums of value by type and time window; late rows beyond the watermark are dropped on streams."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if rows.isStreaming else rows
    return rows.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
