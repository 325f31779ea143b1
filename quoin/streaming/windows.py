"""Extension beside the batch operators: windowed counts of an event stream with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """(start, event_type, n, total) per tumbling window of events(ts, event_type, value); works on streams and tables."""
    # A watermark needs an instant; a time without a zone is taken in the session's.
    src = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events
    return src.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
