"""The named queries of this package, ``(spark, folder) -> DataFrame``, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import centroids, exact, huffman, licences, mixing, packing, periodic, pieces, quality, secrets, urlrules, warc
from .minhash import near_duplicates
from .store import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op2_exact_dedup": exact.SQL,
    "op4_quality_rules": quality.SQL,
    "op6_warc": warc.SQL,
    "op7_licence_scan": licences.SQL,
    "op9_secret_scan": secrets.SQL,
    "op11_periodic_runs": periodic.SQL,
    "op12_centroids": centroids.SQL,
    "op13_source_mix": mixing.SQL,
}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), width=4)


@query
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    index = exact.new_index(spark, documents, scratch_dir(spark, "digest-index"))
    return exact.exact_duplicates(documents, index)


@query
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = quality.quality(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *counts, "base_failed", "kept")


@query
def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    ledger = secrets.BlobLedger(spark, scratch_dir(spark, "blob-ledger"))
    return secrets.digest_columns(secrets.scan_documents(table(spark, folder, "documents"), ledger))


@query
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, folder, "documents")))


@query
def op10_token_file(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "token-file")
    huffman.write_token_file(table(spark, folder, "documents"), path)
    return huffman.read_token_file(spark, path)


@query
def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    # A page's path names the document it shows; a page is bad if that document's label is.
    shown = F.regexp_extract("url", r"^[^:]*://[^/]*/[a-z]+/([0-9]+)", 1).try_cast("bigint")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, folder, "labels").select("doc_id", bad.alias("bad"))
    labelled = pages.withColumn("doc_id", shown).join(labels, "doc_id").select("url", "bad")
    return urlrules.filter_urls(pages, labelled)


@query
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.archived_pages(spark, path).withColumnRenamed("id", "page_id")


@query
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every whole text, and the digest of what they decode to again."""
    documents = table(spark, folder, "documents")
    encoded = pieces.encode(documents)
    both = pieces.decode(encoded)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.sha2("text", 256).alias("decoded_sha256"))


@query
def op7_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents have no paths: they are filed under source/lang, some there, some in shard and some below it; every second one
    with a licence line is a licence file, of source, of source/lang or of a shard."""
    documents = table(spark, folder, "documents")
    head = F.coalesce("text", F.lit("")).rlike(licences.TRIGGER) & (F.col("doc_id") % 2 == 0)
    number, no = F.col("doc_id"), F.col("doc_id").cast("string")
    shard = F.floor(number / 100).cast("string")
    licence = F.when(number % 3 == 0, F.concat_ws("/", "source", F.concat(F.lit("LICENSE."), no)))
    licence = licence.when(number % 3 == 1, F.concat_ws("/", "source", "lang", F.concat(F.lit("LICENSE."), no)))
    licence = licence.otherwise(F.concat_ws("/", "source", "lang", shard, F.concat(F.lit("LICENSE."), no)))
    other = F.when(number % 5 == 0, F.concat_ws("/", "source", "lang", no))
    other = other.when(number % 5 < 3, F.concat_ws("/", "source", "lang", shard, no))
    other = other.otherwise(F.concat_ws("/", "source", "lang", shard, F.concat(F.lit("part"), (number % 7).cast("string")), no))
    path = F.when(head, licence).otherwise(other)
    return licences.scan_licences(documents.withColumn("path", path))


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    planted = periodic.with_planted_runs(table(spark, folder, "documents"))
    return periodic.digest_columns(periodic.periodic_runs(planted))


@query
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.with_totals(*centroids.cluster(table(spark, folder, "embeddings")))


@query
def op13_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))
