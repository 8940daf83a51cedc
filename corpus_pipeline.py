"""The corpus pipeline: quality rules, exact dedup, near-duplicates, secrets, packing; each stage reads what the last kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but the last return the columns of ``docs``,
whatever further ones it has; the last returns pieces of token ids with their places in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqsift.llm import exact, minhash, packing, quality, secrets
from reqsift.llm.store import discard, ship, stored, table
from reqsift.session import scratch_dir

#: Near-duplicates of the corpus: words in a shingle, least similarity in percent.
WIDTH, PERCENT = 5, 80
#: Tokens in a sequence.
CAPACITY = 1024


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that break no quality rule. Null and empty texts are too short and go."""
    whole = docs.select(F.struct("*").alias("doc"), F.col("text"))
    return quality.quality(whole).filter("kept").select("doc.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows whose texts are equal but for white space, the one with the smallest doc_id; of whole repeats, one."""
    return exact.keep_first(docs, exact.new_index(spark, docs, scratch_dir(spark, "pipeline-digests")))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest doc_id; rows without a doc_id stay if alone."""
    ship(spark)
    return minhash.keep_one(docs, width=WIDTH, percent=PERCENT)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets in their texts replaced by a mark, and ``n_chars`` of texts with a mark counted again."""
    ledger = secrets.BlobLedger(spark, scratch_dir(spark, "pipeline-secrets"))
    changed = secrets.redact(docs, ledger)
    if "n_chars" not in docs.columns:
        return changed
    count = F.when(F.contains("text", F.lit(secrets.MARK)), F.length("text")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all rows and their places in sequences of ``CAPACITY`` tokens."""
    ship(spark)
    return packing.pack(packing.token_pieces(docs, CAPACITY), CAPACITY)


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near duplicates", near_stage),
    ("secret scan", secrets_stage),
    ("best-fit packing", packing_stage),
]

#: The last stage's token ids are beyond SQL; tests compare ``run`` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        last, docs = docs, stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(last)
    return docs
