"""Secret scans with an incremental ledger of text versions, in built-in functions only.

Every version of a text is a blob named by its SHA-256. The ledger holds which rule versions were run on which blob and
what they found; a scan runs only the pairs it lacks, on one text per blob, and joins the findings back to all rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import is_directory
from .store import stored, text_or_empty

#: (kind, pattern, group, least characters of that group), in the order in which spans of equal start are listed. The patterns mean
#: the same to Java and to RE2. Matches are leftmost and don't overlap within a kind; too short ones are dropped after.
#: A run of at least n characters is the same as a run that is dropped when it has fewer, so those bounds are in the pattern.
RULES = (
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("url_login", r"[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/@]+@", 0, 0),
)
#: What stands for a secret in redacted texts.
MARK = "[SECRET]"
BASE_KINDS = ("assign", "access", "hex")


def rule_version(rule: tuple) -> str:
    """Changes whenever anything about the rule does."""
    return f"{rule[0]}:{hashlib.sha256(repr(rule).encode()).hexdigest()[:12]}"


def blob_id(text_col: str) -> Column:
    return F.sha2(text_or_empty(text_col), 256)


def _matches(text: str, rule: tuple) -> Column:
    """An array of ``before, length, counted``: characters between the matches, of each match, of its deciding group.

    The texts between matches and the matches themselves come from the same left-to-right search, so their lengths add
    up to places in code points.
    """
    _, pattern, group, _ = rule
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(F.col(text), pattern, -1)
    lengths = F.arrays_zip(
        F.transform(F.slice(gaps, 1, F.size(found)), lambda x: F.length(x)).alias("before"),
        F.transform(found, lambda x: F.length(x)).alias("length"),
        F.transform(counted, lambda x: F.length(x)).alias("counted"),
    )
    return F.when(F.col(text).rlike(pattern), lengths)


def scan(blobs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``blob, rule, start, end`` (code points, end exclusive) for rows of ``blob, text, todo`` (rule versions to run)."""
    parts = []
    for rule in rules:
        due = F.array_contains("todo", rule_version(rule))
        one = F.struct(F.lit(rule_version(rule)).alias("rule"), F.lit(rule[3]).alias("least"))
        parts.append(F.struct(one.alias("rule"), F.when(due, _matches("text", rule)).alias("hits")))
    runs = blobs.select("blob", F.explode(F.array(*parts)).alias("run")).filter("run.hits IS NOT NULL")
    hits = runs.select("blob", "run.rule.rule", "run.rule.least", F.posexplode("run.hits").alias("n", "hit"))
    # All places up to the end of hit n: what lies before each hit, and the hits.
    ends = F.expr(
        "sum(hit.before + hit.length) OVER (PARTITION BY blob, rule ORDER BY n "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    placed = hits.withColumn("end", ends).withColumn("start", F.expr("end - hit.length"))
    return placed.filter("hit.counted >= least").select("blob", "rule", "start", "end")


#: Unseen blobs whose names are sent to all tasks, some 130 bytes each; for more of them the texts are shuffled.
BROADCAST_BLOBS = 200_000


class BlobLedger:
    """What was scanned and found, as two growing tables under ``path`` in the shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.path}/{name}"
        if not is_directory(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def scanned(self) -> DataFrame:
        """``blob, rules``: the rule versions already run on each blob."""
        rows = self._read("scanned", "blob string, rules array<string>")
        return rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"))

    def findings(self) -> DataFrame:
        """``blob, rule, start, end``, each once."""
        return self._read("findings", "blob string, rule string, start long, end long").distinct()

    def update(self, df: DataFrame, text_col: str = "text", rules: tuple = RULES) -> None:
        """Run each rule version on each blob of ``df`` that it has not seen.

        Findings are written before the record that a blob was scanned, so a job that dies in between only scans again.
        """
        versions = F.array(*(F.lit(rule_version(r)) for r in rules))
        blobs = df.select(blob_id(text_col).alias("blob")).distinct()
        todo = blobs.join(self.scanned(), "blob", "left")
        todo = todo.select("blob", F.array_except(versions, F.coalesce("rules", F.array().cast("array<string>"))).alias("todo"))
        todo = stored(todo.filter(F.size("todo") > 0), "unseen-blobs")
        texts = df.select(blob_id(text_col).alias("blob"), text_or_empty(text_col).alias("text"))
        if todo.count() <= BROADCAST_BLOBS:
            # Texts that were scanned before stay where they are.
            numbers = F.transform(versions, lambda v, i: F.when(F.array_contains("todo", v), i.cast("short")))
            # Digests as bytes and rules by number: the driver holds all of them at once.
            short = todo.select(F.unhex("blob").alias("_blob"), F.array_compact(numbers).alias("_rules"))
            texts = texts.join(F.broadcast(short), F.unhex("blob") == F.col("_blob")).dropDuplicates(["blob"])
            due = F.transform("_rules", lambda i: F.get(versions, i.cast("int")))
            texts = texts.select("blob", "text", due.alias("todo"))
        else:
            # One text of each blob leaves a task, so copies don't meet in the join.
            texts = texts.dropDuplicates(["blob"]).join(todo, "blob")
        found = scan(texts, rules)
        found.write.mode("append").parquet(f"{self.path}/findings")
        todo.withColumnRenamed("todo", "rules").write.mode("append").parquet(f"{self.path}/scanned")


def findings_per_blob(ledger: BlobLedger, rules: tuple = RULES) -> DataFrame:
    """``blob, found``: spans ``start, rank, kind, end`` of the given rules, by start and then by the rules' order."""
    ranks = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(rule_version(r)), F.lit(i))))
    kinds = F.array(*(F.lit(r[0]) for r in rules))
    found = ledger.findings().withColumn("rank", ranks[F.col("rule")]).filter("rank IS NOT NULL")
    found = found.withColumn("kind", F.get(kinds, F.col("rank")))
    return found.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("found"))


def scan_documents(
    df: DataFrame, ledger: BlobLedger, id_col: str = "doc_id", text_col: str = "text", rules: tuple = RULES
) -> DataFrame:
    """``id_col, blob, found`` for every row of ``df``: its spans, from the ledger after bringing that up to date.

    A null text counts as empty and has no spans. Rows with equal texts share one scan and each get its spans. An empty
    table gives an empty result. Other columns are ignored.
    """
    ledger.update(df, text_col, rules)
    paths = df.select(F.col(id_col), blob_id(text_col).alias("blob"))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    joined = paths.join(findings_per_blob(ledger, rules), "blob", "left")
    return joined.select(id_col, "blob", F.coalesce("found", none).alias("found"))


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest_columns(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        id_col, *(count(k) for k in BASE_KINDS), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans")
    )


def redact(
    df: DataFrame, ledger: BlobLedger, text_col: str = "text", rules: tuple = RULES, mark: str = MARK
) -> DataFrame:
    """``df`` with every span of its texts replaced by ``mark``; overlapping spans become one. All rows and columns stay."""
    ledger.update(df, text_col, rules)
    rows = df.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text"), blob_id(text_col).alias("_blob"))
    found = findings_per_blob(ledger, rules).select(F.col("blob").alias("_b"), F.col("found").alias("_f"))
    joined = rows.join(found, F.col("_blob") == F.col("_b"), "left")
    merged = F.expr(
        """aggregate(_f, array(named_struct('start', -1L, 'end', 0L)), (a, s) ->
            if(s.start < element_at(a, -1).end,
               concat(slice(a, 1, size(a) - 1), array(named_struct(
                   'start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, s.end)))),
               concat(a, array(named_struct('start', s.start, 'end', s.end)))))"""
    )
    text = F.col("_text")
    joined = joined.withColumn("_m", merged)
    stop = lambda i: F.coalesce(F.get("_m", i + 1)["start"], F.length(text).cast("long"))
    kept = F.transform("_m", lambda m, i: text.substr((m["end"] + 1).cast("int"), (stop(i) - m["end"]).cast("int")))
    cleaned = F.when(F.col("_f").isNull(), text).otherwise(F.array_join(kept, mark))
    cleaned = cleaned.cast(df.schema[text_col].dataType)
    return joined.select(F.col("_row").withField(f"`{text_col}`", cleaned).alias("_row")).select("_row.*")


def _sql(rules: tuple = RULES) -> str:
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(rules):
        quoted = "'" + pattern.replace("'", "''") + "'"
        parts.append(
            f"SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, {quoted}) AS found, "
            f"regexp_extract_all(t, {quoted}, {group}) AS counted, string_split_regex(t, {quoted}) AS gaps "
            f"FROM texts WHERE regexp_matches(t, {quoted})"
        )
    base = ", ".join(f"'{k}'" for k in BASE_KINDS)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({" UNION ALL ".join(parts)}),
each AS (SELECT doc_id, rank, kind, least, n, length(found[n]) AS len, length(counted[n]) AS counted, length(gaps[n]) AS gap
    FROM hits, range(1, 1000000) AS r(n) WHERE n <= len(found)),
placed AS (SELECT *, sum(gap + len) OVER (PARTITION BY doc_id, rank ORDER BY n)::BIGINT AS stop FROM each),
spans AS (SELECT doc_id, rank, kind, stop - len AS start, kind || ':' || (stop - len) || ':' || stop AS span
    FROM placed WHERE counted >= least),
listed AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k,
    count(*) FILTER (kind = 'hex') AS h, string_agg(span, ',' ORDER BY start, rank) FILTER (kind IN ({base})) AS base,
    string_agg(span, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (doc_id)
"""


#: DuckDB SQL of ``digest_columns(scan_documents(...))`` over ``documents``.
SQL = _sql()
