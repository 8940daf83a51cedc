"""Topics as streams; these need the Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import frame_key, frame_line


def read_topic(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    """``key, value`` texts from the earliest offset on; the query's checkpoint keeps the position.

    ``max_offsets`` bounds a micro-batch, the counterpart of a count-triggered flush.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def unframe(messages: DataFrame, value: str = "value") -> DataFrame:
    """Split framed messages back into ``host`` and ``line``."""
    return messages.select(frame_key(F.col(value)).alias("host"), frame_line(F.col(value)).alias("line"))
