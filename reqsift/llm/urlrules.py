"""URL filters: given rules by host and path, and association rules mined from labelled URLs by FP-growth.

A mined rule is a set of items that blocks. An item is a URL token, or several that stand in exactly the same labelled URLs,
any of which is the item then: mining them apart would make a rule of every choice among them. Rules are matched by an
inverted index: a URL meets the rules that have one of its items as their rarest, and is then tested for the others.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

#: (action, host and path prefix); a host stands for itself and its subdomains, the longest fitting rule wins.
GIVEN_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

#: A token set is mined if this share of the labelled rows, and at least ``MIN_ROWS`` of them, has it with the label.
MIN_SUPPORT, MIN_ROWS = 0.0005, 20
#: It blocks if this share of its labelled rows is bad.
MIN_CONFIDENCE = 0.9
#: Tokens in more than this share of the labelled rows are in no set with others. At 1 that is none: all token sets are mined.
COMMON = 1.0

_BAD = "\x00bad"
# Between the items of a set.
_APART = "\x1f"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: from there up to ``? #`` or the end.

    Both are empty for a null URL or one without ``://``.
    """
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def given_rule(host: Column, path: Column, rules: tuple = GIVEN_RULES) -> tuple[Column, Column]:
    """``(rule, action)`` of the longest rule that fits, null where none does; of rules of equal text the first counts."""
    rule = action = F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        at, _, prefix = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + prefix)
        rule, action = F.when(fits, text).otherwise(rule), F.when(fits, verdict).otherwise(action)
    return rule, action


def url_tokens(url: str) -> Column:
    """Distinct tokens: scheme, every host suffix, every path segment that isn't a number, file ending, query names and values.

    Null and empty URLs have none.
    """
    host, path = host_and_path(url)
    tag = lambda kind, a: F.transform(a, lambda x: F.concat(F.lit(kind), x))
    labels = F.split(host, r"\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    segments = F.filter(F.split(path, "/"), lambda s: ~s.rlike(r"^[0-9]*$"))
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    query = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"\?([^#]*)", 1)
    scheme = F.substring_index(F.coalesce(F.col(url), F.lit("")), "://", 1)
    found = F.concat(
        F.array(F.concat(F.lit("s:"), scheme)),
        tag("h:", suffixes),
        tag("p:", F.filter(segments, lambda s: ~s.rlike(r"^[0-9]+\."))),
        F.array(F.concat(F.lit("e:"), ending)),
        tag("q:", F.split(query, "&")),
    )
    return F.array_distinct(F.filter(found, lambda x: F.length(x) > 2))


def _items(rows: DataFrame, least: int) -> DataFrame:
    """``token, item, count, sure``: the tokens that ``least`` bad rows have, of ``rows`` (``row, tokens, bad``); those of
    exactly the same rows are one item.

    Rows are compared by their number, two sums of hashes of their ids, and then by count: what looks equal must stand together
    in every row.
    """
    tokens = rows.select("row", "bad", F.explode("tokens").alias("token"))
    seen = tokens.groupBy("token").agg(
        F.count("*").alias("count"),
        F.count_if("bad").alias("sure"),
        F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("a"),
        F.sum(F.xxhash64("row", F.lit(1)).cast("decimal(38,0)")).alias("b"),
    )
    alike = Window.partitionBy("count", "a", "b")
    seen = stored(seen.filter(F.col("sure") >= least).select("token", "count", "sure", F.min("token").over(alike).alias("first"), F.count("*").over(alike).alias("n")), "url-tokens")
    together = tokens.join(seen.filter("n > 1").select("token", "first", "n"), "token").groupBy("row", "first")
    apart = together.agg(F.count("*").alias("here"), F.max("n").alias("n")).filter("here != n").select("first").distinct()
    marked = seen.join(apart.withColumn("apart", F.lit(True)), "first", "left")
    group = F.when(F.col("apart").isNull(), F.col("first")).otherwise(F.col("token"))
    named = marked.select("token", "count", "sure", group.alias("first"))
    names = named.groupBy("first").agg(F.array_join(F.array_sort(F.collect_list("token")), "|").alias("item"))
    return stored(named.join(names, "first").select("token", "item", "count", "sure"), "url-items")


def mine_rules(
    labelled: DataFrame,
    url: str = "url",
    bad: str = "bad",
    min_support: float = MIN_SUPPORT,
    min_rows: int = MIN_ROWS,
    min_confidence: float = MIN_CONFIDENCE,
    common: float = COMMON,
) -> tuple[DataFrame, DataFrame]:
    """``rule, items, confidence, rows``: item sets that block, mined from all labelled URLs; and ``token, item`` of each.

    Sets have any number of items. A set is dropped when a part of it is a rule with no less confidence. So items all of whose
    rows are bad are rules of their own and in no other, and items in too few bad rows are in none: neither is mined with the
    others, nor are items of every row, which change no confidence. ``bad`` is a boolean; rows where it is null are left out,
    and without labelled rows there are no rules. FP-growth keeps at most (tokens of a row / ``min_support``) items; the
    sets it finds are a table.
    """
    spark = labelled.sparkSession
    none = spark.createDataFrame([], "rule string, items array<string>, confidence double, rows long")
    no_items = spark.createDataFrame([], "token string, item string")
    rows = labelled.filter(F.col(bad).isNotNull()).select(url_tokens(url).alias("tokens"), F.col(bad).alias("bad"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "labelled-urls")
    total = rows.count()
    least = max(math.ceil(min_support * total - 1e-9), min_rows)
    if least > total:
        return none, no_items
    items = _items(rows, least)
    distinct = items.groupBy("item").agg(F.first("count").alias("count"), F.first("sure").alias("sure"))
    frequent = distinct.withColumn("confidence", F.col("sure") / F.col("count"))
    # Alone: no other item makes them surer, or they say nothing of others.
    alone = F.col("sure").eqNullSafe(F.col("count")) | (F.col("count") == total) | (F.col("count") > common * total)
    single = frequent.filter(alone & (F.col("confidence") >= min_confidence) & ((F.col("sure") == F.col("count")) | (F.col("count") == total)))
    single = single.select(F.col("item").alias("rule"), F.array("item").alias("items"), "confidence", F.col("sure").alias("rows"))
    mixed = items.join(frequent.filter(~alone).select("item"), "item").select("token", "item")
    held = rows.select("row", "bad", F.explode("tokens").alias("token")).join(mixed, "token")
    baskets = held.groupBy("row").agg(F.collect_set("item").alias("items"), F.first("bad").alias("bad"))
    baskets = stored(baskets.select(F.when(F.col("bad"), F.array_append("items", F.lit(_BAD))).otherwise(F.col("items")).alias("items")), "url-baskets")
    kept = baskets.count()
    if kept < least:
        return stored(single, "url-rules"), items.select("token", "item")
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / max(kept, least)).fit(baskets)
    sets = model.freqItemsets.withColumn("tokens", F.array_sort(F.array_remove("items", _BAD)))
    sets = sets.withColumn("key", F.array_join("tokens", _APART)).filter(F.size("tokens") > 0)
    surely = sets.filter(F.array_contains("items", _BAD)).select("key", "tokens", F.col("freq").alias("sure"))
    sets = surely.join(sets.filter(~F.array_contains("items", _BAD)).select("key", F.col("freq").alias("count")), "key")
    sets = stored(sets.withColumn("confidence", F.col("sure") / F.col("count")), "url-sets")
    rules, below = [single], None
    # Level by level: the surest rule among the parts of a set is that of the sets with one item less, or among their parts.
    for n in range(1, (sets.agg(F.max(F.size("tokens"))).first()[0] or 0) + 1):
        level = sets.filter(F.size("tokens") == n)
        if below is None:
            level = level.withColumn("below", F.lit(0.0))
        else:
            part = F.explode(F.transform("tokens", lambda t, i: F.array_join(F.filter("tokens", lambda _, j: j != i), _APART)))
            parts = level.select("key", part.alias("part")).join(below.select(F.col("key").alias("part"), "best"), "part")
            level = level.join(parts.groupBy("key").agg(F.max("best").alias("below")), "key")
        sure = F.when(F.col("confidence") >= min_confidence, F.col("confidence")).otherwise(0.0)
        below = stored(level.withColumn("best", F.greatest("below", sure)), "url-level")
        found = below.filter((F.col("confidence") >= min_confidence) & (F.col("confidence") > F.col("below")))
        rules.append(found.select(F.array_join("tokens", " ").alias("rule"), F.col("tokens").alias("items"), "confidence", F.col("sure").alias("rows")))
    return stored(reduce(DataFrame.unionByName, rules), "url-rules"), items.select("token", "item")


def mined_matches(urls: DataFrame, rules: DataFrame, items: DataFrame, id_col: str, url: str = "url") -> DataFrame:
    """``id_col, rules``: the mined rules each URL meets, through the inverted index rarest item -> rule."""
    keyed = rules.select("rule", F.col("items").alias("needed"), F.array_join("items", _APART).alias("key"))
    spread = keyed.select("key", F.explode("needed").alias("item"))
    often = spread.groupBy("item").agg(F.count("*").alias("n"))
    rarest = spread.join(often, "item").groupBy("key").agg(F.min(F.struct("n", "item"))["item"].alias("item"))
    index = keyed.join(rarest, "key").drop("key")
    tokens = urls.select(F.col(id_col), F.explode(url_tokens(url)).alias("token")).join(items.join(often, "item"), "token")
    held = tokens.groupBy(id_col).agg(F.collect_set("item").alias("held"))  # at most the tokens of one URL
    met = held.withColumn("item", F.explode("held")).join(index, "item").filter(F.size(F.array_except("needed", "held")) == 0)
    return met.groupBy(id_col).agg(F.sort_array(F.collect_list("rule")).alias("rules"))


def filter_urls(
    pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url: str = "url", rules: tuple = GIVEN_RULES, **mining
) -> DataFrame:
    """``id_col, host, path, rule, verdict, mined`` for every row of ``pages``.

    ``verdict`` is the given rule's action where one fits, else ``block`` where a mined rule is met, else ``allow``. Null
    URLs, and those without ``://``, have empty host and path; no given rule fits them. Each distinct URL is matched once,
    so rows of one URL get equal verdicts whatever their ids. ``labelled`` has columns ``url`` and ``bad``.
    """
    mined, items = mine_rules(labelled, url, **mining)
    # A null URL has no tokens, so it meets no rule and joins nothing.
    urls = pages.select(F.col(url).alias("_url")).filter("_url IS NOT NULL").distinct()
    matches = mined_matches(urls, mined, items, "_url", "_url")
    host, path = host_and_path(url)
    rule, action = given_rule(F.col("host"), F.col("path"), rules)
    out = pages.select(id_col, F.col(url).alias("_url"), host.alias("host"), path.alias("path")).join(matches, "_url", "left")
    verdict = F.coalesce(action, F.when(F.col("rules").isNotNull(), "block"), F.lit("allow"))
    return out.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("verdict"), F.col("rules").alias("mined"))
