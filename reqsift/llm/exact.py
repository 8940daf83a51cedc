"""Exact duplicates against a persistent digest index, bucketed and sorted by hash.

The index is a table of ``digest, keep_id``. A batch is reduced to its digests, merged with the index by a sort-merge
join (the bucketed side is neither shuffled nor, with one file per bucket, sorted), and only digests the anti-join
finds new are appended. Texts never leave the scan.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import SPACES, stored, text_or_empty, type_of


def text_digest(text_col: str) -> Column:
    """SHA-256 (lowercase hex) of the text with every run of white space as one space; null counts as empty."""
    return F.sha2(F.regexp_replace(text_or_empty(text_col), SPACES, " "), 256)


class DigestIndex:
    """The index stored at ``path``, which all executors share; it is created when absent and outlives the session."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.name = f"digest_index_{hashlib.md5(path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def add(self, groups: DataFrame) -> None:
        """Append the ``digest, keep_id`` rows whose digest is not in the index; adding them again adds nothing."""
        new = groups.join(self.read().hint("merge"), "digest", "left_anti")
        new = new.select("digest", "keep_id").repartition(self.buckets, "digest").sortWithinPartitions("digest")
        new.write.insertInto(self.name)


def exact_duplicates(df: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add a batch to the index and say for each of its rows which row of all batches so far stays.

    One row per input row: ``id_col, keep_id`` (the first batch's smallest id with this text), ``group_size`` (rows of
    this batch with this text), ``kept`` (``id_col`` is ``keep_id``), ``text_sha256``. Null and empty texts are equal. Rows
    repeated whole are all ``kept`` together; ``keep_first`` drops the repeats. A null id stays only where no row of
    its group has an id. An empty batch gives an empty result. Running a batch again gives the same answers.
    """
    marked = stored(df.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest")), "digests")
    groups = marked.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    index.add(groups)
    known = groups.select("digest", "group_size").join(index.read().hint("merge"), "digest")
    return marked.join(known, "digest").select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_first(df: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, with all their columns, that ``exact_duplicates`` keeps; of whole repeats, one."""
    decided = stored(exact_duplicates(df, index, id_col, text_col), "exact-decisions")
    keep = decided.filter("kept").groupBy(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_digest"))
    keep = keep.agg(F.count("*").alias("_rows"))
    rows = df.select(F.struct("*").alias("_row"), F.col(id_col).alias("_own"), text_digest(text_col).alias("_sha"))
    rows = rows.join(keep, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_digest")))
    once, often = rows.filter("_rows = 1"), rows.filter("_rows > 1").dropDuplicates(["_id", "_sha"])
    return once.unionByName(often).select("_row.*")


def new_index(spark: SparkSession, df: DataFrame, path: str, id_col: str = "doc_id") -> DigestIndex:
    return DigestIndex(spark, path, type_of(df, id_col))


#: DuckDB SQL of ``exact_duplicates`` for one batch and an empty index.
SQL = r"""
WITH marked AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM marked WINDOW g AS (PARTITION BY text_sha256)
"""
