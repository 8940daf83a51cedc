"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nonblank(df: DataFrame, *cols: str) -> DataFrame:
    """Rows in which every one of ``cols`` is neither null nor empty."""
    for c in cols:
        df = df.filter(F.col(c) != "")  # a null does not pass either
    return df


def key_equals(df: DataFrame, col: str, value: str) -> DataFrame:
    """Rows whose trimmed ``col`` equals ``value``."""
    return df.filter(F.trim(F.col(col)) == F.lit(value))


def listed(state: DataFrame) -> DataFrame:
    """Keys on the allowlist: any status but ``'0'``; a null status is not listed."""
    return state.filter(F.col("status") != "0")
