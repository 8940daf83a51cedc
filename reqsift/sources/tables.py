"""Parquet tables and the day scan over them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from ..session import is_directory


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


#: Spark forgets, and skips, files older than this behind the newest one; some 100,000 years.
ALL_AGES = "36500000d"


def file_stream(spark: SparkSession, max_files: int | None = None) -> DataStreamReader:
    """A reader of files in any order of their time stamps; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.option("maxFileAge", ALL_AGES)
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def stream_table(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """The same table as a file stream, from its first file on; ``max_files`` bounds a micro-batch."""
    reader = file_stream(spark, max_files).schema(read_table(spark, folder, name).schema)
    path = os.path.join(folder, f"{name}.parquet")
    if is_directory(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def rows_after_day(df: DataFrame, ts: str, day: str) -> DataFrame:
    """Rows of days after ``day`` (``yyyy-MM-dd``).

    Written as a plain range on the column, so that it is pushed down to the scan.
    """
    first = F.expr(f"cast(date_add(date '{day}', 1) as timestamp_ntz)")
    return df.filter(F.col(ts) >= first)
