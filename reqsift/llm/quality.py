"""Quality rules: a table of thresholds compiled into one projection of built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import SPACES, text_or_empty

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it was for on with as are be this by at from or an not have"
    " der die das und ist den von zu mit sich des auf für nicht ein eine im dem als auch"
    " le la les de et un une que en est des du pour dans qui sur au par plus avec"
    " el los las y del se por con una su para es al lo como más pero sus"
).split()

#: (name of the rule, SQL over the measures, least value, largest value); null bounds nothing. Ratios of a text without
#: words or lines are null and break no rule.
THRESHOLDS = (
    ("length", "n_words", 10, None),
    ("repeated_words", "100 * n_repeat_words / n_words", None, 20),
    ("word_length", "word_chars / n_words", 2, 20),
    ("symbols", "n_symbols / n_words", None, 0.5),
    ("stop_words", "(n_stop_words + 1) / n_words", 0.02, None),
    ("duplicate_lines", "n_dup_lines / n_lines", None, 0.5),
    ("shouted_words", "n_upper_words / n_words", None, 0.5),
)
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_upper_words",
)
#: The first rules decide ``base_failed``, all decide ``kept``.
BASE_RULES = 2


def measures(df: DataFrame, text_col: str = "text", window: int = 5) -> DataFrame:
    """``df`` with the counts the rules use, from whole texts; a column of the same name is replaced.

    Arrays that a later expression uses more than once are columns of their own, so they are computed once a row.
    Windows are compared by 64-bit hashes of their words. Null texts count as empty: all counts are 0.
    """
    words = F.filter(F.split(F.col("_t"), SPACES), lambda w: w != "")
    lines = F.filter(F.split(F.col("_t"), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = df.select(F.struct("*").alias("_row"), text_or_empty(text_col).alias("_t"))
    out = out.withColumn("_w", words).withColumn("_l", lines)
    h = F.col("_h")
    starts = F.sequence(F.lit(0), F.size(h) - window)
    hashed = F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(window))))
    out = out.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    out = out.withColumn("_g", F.when(F.size(h) > window, hashed))
    # Only texts with a repeated window sort theirs, by hash and place.
    twice = F.size(F.array_distinct("_g")) < F.size("_g")
    out = out.withColumn(
        "_s", F.when(twice, F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    )
    s = F.col("_s")
    beside = lambda x, i, d: F.coalesce(F.get(s, i + d)["g"] == x["g"], F.lit(False))
    places = F.transform(F.filter(s, lambda x, i: beside(x, i, -1) | beside(x, i, 1)), lambda x: x["i"])
    covered = F.aggregate(
        F.sort_array(places),
        F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(window), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    stop = [*STOP_WORDS]
    upper = lambda w: (F.length(w) > 1) & (F.upper(w) == w) & (F.lower(w) != w)
    count = lambda c: c.cast("long")
    out = out.withColumns(
        {
            "n_words": count(F.size("_w")),
            "word_chars": count(F.length(F.array_join("_w", ""))),
            "n_symbols": count(F.regexp_count("_t", F.lit("[#*$%&|<>]"))),
            "n_lines": count(F.size("_l")),
            "n_dup_lines": count(F.size("_l") - F.size(F.array_distinct("_l"))),
            "n_repeat_words": count(F.coalesce(covered, F.lit(0))),
            "n_stop_words": count(F.size(F.filter("_w", lambda w: F.lower(w).isin(stop)))),
            "n_upper_words": count(F.size(F.filter("_w", upper))),
        }
    )
    # Generating one row of one keeps Catalyst from copying these expressions into the filters and columns of a caller.
    out = out.select("_row", F.explode_outer(F.array(F.struct(*MEASURES))).alias("_counts"))
    return out.select(*(F.col(f"_row.`{c}`") for c in df.columns if c not in MEASURES), "_counts.*")


def broken(rules=THRESHOLDS) -> Column:
    """The names of the rules a row of measures breaks, in the table's order."""
    # try_divide: a text without words or lines has no ratio.
    checks = []
    for name, value, least, most in rules:
        top, _, bottom = value.partition(" / ")
        value = f"try_divide({top}, {bottom})" if bottom else top
        tests = [f"{value} < {least}"] * (least is not None) + [f"{value} > {most}"] * (most is not None)
        checks.append(F.when(F.expr(" OR ".join(tests)), F.lit(name)))
    return F.array_compact(F.array(*checks))


def quality(df: DataFrame, text_col: str = "text", rules=THRESHOLDS, base: int = BASE_RULES) -> DataFrame:
    """``df`` with the measures, ``base_failed`` (a base rule is broken), ``broken_rules`` and ``kept`` (none is broken).

    A null or empty text has no words and fails the length rule. Rows are judged one by one: repeats alike, an empty
    table stays empty, other columns (but those named here) pass through.
    """
    judged = measures(df, text_col).withColumn("broken_rules", broken(rules))
    failed = F.arrays_overlap("broken_rules", F.array(*(F.lit(r[0]) for r in rules[:base])))
    return judged.withColumn("base_failed", failed).withColumn("kept", F.size("broken_rules") == 0)


def _sql(rules=THRESHOLDS) -> str:
    tests = []
    for _, value, least, most in rules:
        value = value.replace(" / ", " / nullif(") + ", 0)" if " / " in value else value
        tests += [f"coalesce({value} < {least}, false)"] * (least is not None)
        tests += [f"coalesce({value} > {most}, false)"] * (most is not None)
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (
    SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM texts
),
grams AS (
    SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM split, range(1, len(w) - 3) AS r(i)
),
repeated AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT doc_id, sum(least(5, i - coalesce(before, i - 5)))::BIGINT AS n FROM repeated GROUP BY doc_id),
measures AS (
    SELECT s.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l) AS n_lines,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words,
        len(list_filter(w, lambda x: length(x) > 1 AND upper(x) = x AND lower(x) <> x)) AS n_upper_words
    FROM split s LEFT JOIN covered c USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, NOT ({" OR ".join(tests)}) AS kept
FROM measures
"""


#: DuckDB SQL of the query over ``documents``.
SQL = _sql()
