"""Joins of a large, possibly skewed table with a table that holds each key once."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .filters import listed, nonblank

MAX_BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 48
_COLUMN_BYTES = 16
_MIN_SUPPORT = 1e-4
#: A key is spread once it holds this many times the rows of an even partition, over so many salts as it fills.
HOT_FACTOR = 1
#: Salts of null keys, which meet no lookup row; far more than partitions, so that these fill evenly.
NULL_SALTS = 1 << 20


def fits(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` is small enough to broadcast.

    The plan's own bound decides where it is certain: an optimizer's estimate can only be too large for filters and
    aggregates of stored files, so far below the limit nothing is computed twice.
    """
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    # Files are compressed and rows have overhead: a tenfold margin.
    return limit > 0 and (int(estimate) * 10 <= limit or table_bytes(df) <= limit)


def table_bytes(df: DataFrame) -> int:
    """Size of ``df`` as hash-table rows, measured, not estimated from statistics."""
    size = F.lit(_ROW_OVERHEAD + _COLUMN_BYTES * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
    return df.agg(F.sum(size.cast("long"))).first()[0] or 0


def hot_keys(df: DataFrame, key: str, share: float) -> dict:
    """Every key that holds more than ``share`` of the rows, with its exact share; null is no key.

    A first pass in bounded memory finds candidates, some of them by mistake; a second one counts them. At most
    ``1 / share`` keys come back.
    """
    share = max(share, _MIN_SUPPORT)
    found = [k for k in df.select(key).stat.freqItems([key], share).first()[0] if k is not None]
    if not found:
        return {}
    named = F.when(F.col(key).isin(found), F.col(key))
    rows = df.groupBy(named.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()  # the candidates and the rest
    total = sum(r["n"] for r in rows)
    return {r["k"]: r["n"] / total for r in rows if r["k"] is not None and r["n"] > share * total}


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str,
    spread_by: Sequence[str] | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join ``facts`` with ``lookup`` (each key once) on ``key``; ``how`` keeps the rows of ``facts``.

    A lookup whose measured size fits is broadcast, so ``facts`` is not shuffled at all. A larger one
    is shuffled, and then the hot keys of ``facts`` are spread by a hash of ``spread_by`` (an id; default all plain
    columns) over as many salts as their share of the rows fills partitions, with their lookup rows repeated as often.
    Null keys find nothing and are spread over all partitions. Finding the keys is two more passes over the key column
    of ``facts``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if fits(lookup, max_broadcast_bytes):
        return facts.join(F.broadcast(lookup), key, how)
    if facts.isStreaming:  # hot keys of a stream are not known up front; call per micro-batch instead
        return facts.join(lookup, key, how)

    spark = facts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = {k: min(math.ceil(share * parts), parts) for k, share in hot_keys(facts, key, HOT_FACTOR / max(parts, 1)).items()}
    hot_table = F.broadcast(  # at most min(parts, 1 / _MIN_SUPPORT) keys
        spark.createDataFrame(list(hot.items()), T.StructType([facts.schema[key], T.StructField("_salts", T.IntegerType())]))
    )

    def salted(df: DataFrame, salt: Column) -> DataFrame:
        if not hot:
            return df.withColumn("_salts", F.lit(1)).withColumn("_salt", salt).drop("_salts")
        return df.join(hot_table, key, "left").withColumn("_salt", salt).drop("_salts")

    row_hash = F.xxhash64(*(spread_by or _hashable(facts)))
    spread = F.when(F.col(key).isNull(), F.pmod(row_hash, F.lit(NULL_SALTS))).otherwise(
        F.pmod(row_hash, F.coalesce("_salts", F.lit(1)))
    )
    salted_facts = salted(facts, spread.cast("int"))
    salted_lookup = salted(lookup, F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
    return salted_facts.join(salted_lookup, [key, "_salt"], how).drop("_salt")


def drop_listed(requests: DataFrame, state: DataFrame, key: str = "host", **options) -> DataFrame:
    """Requests whose key is present and not on the allowlist. Exact: nothing is dropped by chance."""
    return lookup_join(nonblank(requests, key), listed(state).select(key), key, "left_anti", **options)


def enrich_with_state(df: DataFrame, state: DataFrame, key: str = "host", **options) -> DataFrame:
    """Add the known ``count`` and ``status`` of the key; unknown keys get 0 and ``'0'``."""
    known = state.select(key, F.col("count").alias("known_count"), F.col("status").alias("known_status"))
    return lookup_join(df, known, key, "left", **options).withColumns(
        {
            "known_count": F.coalesce("known_count", F.lit(0)),
            "known_status": F.coalesce("known_status", F.lit("0")),
        }
    )
