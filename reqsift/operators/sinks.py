"""Writers for redacted records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.redact import sensitive_names
from ..functions.text import encode_map, frame


def to_record_map(requests: DataFrame) -> DataFrame:
    """Add ``record``: the columns and fields of a parsed request as one map, columns first in rank."""
    own = F.create_map(
        F.lit("host"), F.col("host"),
        F.lit("url"), F.col("url"),
        F.lit("action_type"), F.col("action_type"),
    )
    form = F.when(
        F.col("request_parameters").isNotNull(),
        F.create_map(F.lit("request_parameters"), F.to_json("request_parameters")),
    ).otherwise(F.create_map().cast("map<string,string>"))
    names = F.array(F.lit("host"), F.lit("url"), F.lit("action_type"), F.lit("request_parameters"))
    fields = F.map_filter("fields", lambda k, v: ~F.array_contains(names, k))
    return requests.withColumn("record", F.map_concat(own, form, fields))


def framed_lines(requests: DataFrame) -> DataFrame:
    """Parsed requests with ``line``: the host, a separator, and the encoded record."""
    return to_record_map(requests).withColumn("line", frame(F.col("host"), encode_map(F.col("record")))).drop("record")


def topic_rows(lines: DataFrame, line: str = "line") -> DataFrame:
    """``key, value`` rows for a topic; the key is a random UUID, so partitions fill evenly."""
    return lines.select(F.uuid().alias("key"), F.col(line).alias("value"))


def write_topic(rows: DataFrame, servers: str, topic: str) -> None:
    """Batch write to a topic; needs the Kafka connector on the class path."""
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option(
        "kafka.acks", "1"
    ).save()


def write_archive(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Archive ``batch, seq, line`` rows as Parquet, one folder per batch."""
    out = rows.select(F.col("batch").cast("long").alias("batch"), F.col("seq").cast("int").alias("seq"), "line")
    out.hint("rebalance", F.col("batch")).write.mode(mode).partitionBy("batch").parquet(path)


def append_json(df: DataFrame, key: str, path: str, mode: str = "append", key_buckets: int | None = None) -> None:
    """JSON lines, one directory per value of ``key``.

    The rebalance hint gathers the rows of a key into few files and lets adaptive execution split a hot
    one. For very many keys pass ``key_buckets``: one directory per bucket, the key stays in the rows.
    """
    refused = sensitive_names(df.columns)
    if refused:
        raise ValueError(f"refusing to store sensitive columns: {', '.join(refused)}")
    by = key
    if key_buckets:
        by = "key_bucket"
        df = df.withColumn(by, F.pmod(F.xxhash64(key), F.lit(key_buckets)).cast("int"))
    df.hint("rebalance", F.col(by)).write.partitionBy(by).mode(mode).json(path)
