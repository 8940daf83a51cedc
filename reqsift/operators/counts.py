"""Counting, ranking, distinct values and set operations over keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, key: str = "host") -> DataFrame:
    """Rows per key; partial counts are built before the shuffle, so a hot key costs one row per task."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def merge_counts(state: DataFrame, counts: DataFrame, key: str = "host") -> DataFrame:
    """Running state plus the counts of a batch; each side has a key once.

    A new key starts with its whole batch count and status ``'0'``; a known key keeps its status.
    """
    old = state.select(key, F.col("count").alias("_old"), "status")
    new = counts.select(key, F.col("count").alias("_new"))
    return old.join(new, key, "full_outer").select(
        key,
        (F.coalesce("_old", F.lit(0)) + F.coalesce("_new", F.lit(0))).alias("count"),
        F.coalesce("status", F.lit("0")).alias("status"),
    )


def total_count(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total_count"))


def rank_by_count(counts: DataFrame, key: str = "host", limit: int | None = None) -> DataFrame:
    """Largest count first, ties by key. A ``limit`` turns the sort into a top-k."""
    ranked = counts.orderBy(F.desc("count"), F.asc(key))
    return ranked if limit is None else ranked.limit(limit)


def distinct_per_key(df: DataFrame, key: str, *values: str) -> DataFrame:
    """Distinct value tuples of each key, one per row.

    Rows rather than one array per key: the shuffle is on key and values together, so no task has to
    hold all the values of a hot key.
    """
    return df.select(key, *values).distinct()


def union_keys(key: str, *tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [t.select(key) for t in tables]).distinct()


def key_difference(all_keys: DataFrame, without: DataFrame, key: str = "host") -> DataFrame:
    return all_keys.select(key).subtract(without.select(key))


def exposure_by_host(requests: DataFrame) -> DataFrame:
    """Per host: how many requests carry credentials of each kind (``key``: one that only its form tells), and how many (but for mere usernames) in cleartext.

    Counts only; the parser has already removed the credentials themselves.
    """
    cleartext = ~F.lower("url").startswith("https://")
    kinds = ("password", "basic", "bearer", "session", "userinfo", "key")
    carries = reduce(Column.__or__, [F.col(f"has_{k}") for k in kinds])
    return (
        requests.groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("has_username")).alias("with_username"),
            *(F.count_if(F.col(f"has_{k}")).alias(f"with_{k}") for k in kinds),
            F.count_if(carries & cleartext).alias("exposed"),
        )
        .withColumn("exposed_share", F.col("exposed") / F.col("requests"))
    )
