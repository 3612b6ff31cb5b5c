"""An addition to the batch operators: windowed counts over an event stream with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed(events: DataFrame, ts: str = "ts", by: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Works on a stream and on a table alike."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if events.isStreaming:
        rows = rows.withWatermark("_ts", late)
    return rows.groupBy(F.window("_ts", width), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), by, "n", "total")
