"""Connected components as joins and aggregates: union-find whose unions are rounds over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """``node, root``: for every node of a link, the smallest node of its component.

    Each round hangs the larger neighbours of every node under the smallest one it knows, then the smaller ones, so
    that paths halve; no component is ever gathered in one place. Links with a null end and loops count for nothing;
    no links give an empty table.
    """
    edges = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    edges = edges.filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") != F.col("v")))
    edges = stored(edges.distinct(), "links")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u != v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        last, edges = edges, stored(small.filter("u != v").distinct(), "small-star")
        discard(last, large)
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
