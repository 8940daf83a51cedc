"""Event-time windows, the batch form of the time-triggered flush."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_FORMAT = "yyyy-MM-dd HH:mm:ss"


def with_window(df: DataFrame, ts: str, duration: str) -> DataFrame:
    """Add ``window_start`` of the tumbling window the row falls in."""
    return df.withColumn("window_start", F.window(F.col(ts), duration)["start"])


def tumbling_counts(df: DataFrame, ts: str, duration: str, key: str) -> DataFrame:
    return with_window(df, ts, duration).groupBy("window_start", key).agg(F.count(F.lit(1)).alias("count"))


def windowed_distinct(df: DataFrame, ts: str, duration: str, key: str, *values: str) -> DataFrame:
    """Distinct tuples within each window; the same tuple may come back in the next one.

    On a stream with a watermark on ``ts`` the state of closed windows is dropped.
    """
    cols = [key, *values]
    if not df.isStreaming:
        return with_window(df, ts, duration).select("window_start", *cols).distinct()
    # Only the window itself carries the watermark; its start alone would keep all state for ever.
    windowed = df.select(F.window(F.col(ts), duration).alias("window"), *cols)
    return windowed.dropDuplicates(["window", *cols]).select(F.col("window.start").alias("window_start"), *cols)
