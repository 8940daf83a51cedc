"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled by a hash and queue up, the whole source again after its last document. A document
is served in packets of at most ``QUANTUM`` words, and each packet's virtual finish time is the words its source has
been served up to its end, divided by the source's target. All packets are sorted by that time over the whole cluster and
the mix is the head of that order that the budget holds, so at every point of the mix each source has had its share, and
at the end its target to within a packet.

Both running sums (words of a source, words of the mix) are taken inside range partitions and shifted by the sums of the
partitions before, so neither a hot source nor the mix itself passes through one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import WORD, discard, stored, text_or_empty

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
QUANTUM = 64


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def shuffle_key(id_col: str) -> Column:
    """A place in the source's queue that depends on the id alone: 60 bits of the MD5 of the id in decimal."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, rank, target`` of each source in ``sizes`` (``source, source_size``).

    Sources by code point, null last, have the weights in turn and share ``share`` times all sizes; a target stops at ``most``
    times its source's size, and the excess goes to the others by weight until none is above. Sources fill up in
    order of size by weight, so one sorted pass finds which do. One row per source, so a single task's window.
    """
    by_name, by_fill = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("fill")
    whole = Window.partitionBy()
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    weighted = ranked.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("rank") % len(weights) + 1).cast("double"))
    cap = (most * F.col("source_size")).cast("double")
    filled = weighted.select("*", cap.alias("cap"), (cap / F.col("w")).alias("fill"), (share * F.sum("source_size").over(whole)).alias("budget"))
    # Filled at the level where it would be full itself: what all sources then hold is within the budget.
    needed = F.sum("cap").over(by_fill) + F.col("fill") * (F.sum("w").over(whole) - F.sum("w").over(by_fill))
    full = filled.withColumn("full", needed <= F.col("budget"))
    capped, open_ = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(whole), F.sum(F.when(~F.col("full"), F.col("w"))).over(whole)
    target = F.when(F.col("full"), F.col("cap")).otherwise((F.col("budget") - capped) * F.col("w") / open_)
    return full.select("source", "source_size", "rank", target.alias("target"), "budget")


def running_sum(df: DataFrame, order: list[Column], value: str, group: str | None, name: str) -> tuple[DataFrame, DataFrame]:
    """``df`` (stored) in the global order of ``order``, with ``part``, ``seen`` (the sum of ``value`` inside the range
    partition and ``group``, up to and with the row), and what to add to it: ``part``, ``group``, ``before``."""
    schema = df.schema
    grouped = group is not None
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = np.cumsum(batch.column(value).to_numpy(zero_copy_only=False), dtype=np.int64)
            keys = batch.column(group).to_numpy(zero_copy_only=False) if grouped else np.zeros(batch.num_rows, np.int64)
            starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
            taken = np.concatenate(([0], sums[starts[1:] - 1]))
            if keys[0] == last:
                taken[0] -= carried
            seen = sums - np.repeat(taken, np.diff(np.append(starts, len(keys))))
            carried, last = int(seen[-1]), keys[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seen)], names=[*batch.schema.names, "seen"])

    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"{fields}, seen long")
    placed = stored(placed.withColumn("part", F.spark_partition_id()), name)
    # One row per partition, and one more for every group that begins inside one.
    keys = [group] if grouped else []
    totals = placed.groupBy("part", *keys).agg(F.max("seen").alias("held"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return placed, totals.select("part", *keys, F.coalesce(F.sum("held").over(before), F.lit(0)).cast("long").alias("before"))


def queues(df: DataFrame, size: Column, id_col: str, source_col: str, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """One stored row per document: ``row, id, size, rank``, its source's ``source_size, target, budget``, and ``served``, the
    words of the source up to its end in the first pass."""
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), shuffle_key(id_col).alias("key"))
    # Texts are read here and never again; the row number is fixed by being written.
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")
    sources = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    # Joined on a text that is never null; Spark broadcasts the sources while they are small.
    same = F.concat(F.lit("="), F.col("source"))
    ranked = rows.withColumn("s", F.coalesce(same, F.lit(""))).drop("source")
    ranked = ranked.join(sources.select(F.coalesce(same, F.lit("")).alias("s"), "rank"), "s").drop("s")
    order = [F.col("rank"), F.col("key"), F.col("id").asc_nulls_last(), F.col("size"), F.col("row")]
    placed, before = running_sum(ranked, order, "size", "rank", "queues")
    out = placed.join(before, ["part", "rank"]).join(sources.drop("source"), "rank")
    out = out.select("row", "id", "size", "rank", "source_size", "target", "budget", (F.col("before") + F.col("seen")).alias("served"))
    documents = stored(out, "documents")
    discard(rows, sources, placed)
    return documents


def mix(
    df: DataFrame,
    size: Column | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    quantum: int = QUANTUM,
) -> tuple[DataFrame, DataFrame]:
    """The documents with their places in their queues, and the mix: ``row, pass, start, words, position`` per packet.

    ``pass`` counts repeats from 0, ``start`` the words of the document before the packet, ``position`` the words of the mix
    before it; positions are gapless from 0 up to the budget, and the packet that reaches it is cut there. ``size`` defaults
    to the words of ``text`` (null: none). Rows are told apart by where they stand, so rows with equal or null ids are documents
    of their own; a null source is one source. Documents without words, sources of such, and an empty table take
    nothing. Other columns are left aside.
    """
    documents = queues(df, word_count() if size is None else size, id_col, source_col, weights, share, most)
    count = F.ceil(F.col("size") / quantum).cast("int")
    passes = documents.filter("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    packets = passes.withColumn("n", F.explode(F.sequence(F.lit(0), count - 1)))
    start = (F.col("n") * quantum).cast("long")
    words = F.least(F.lit(quantum).cast("long"), F.col("size") - start)
    end = F.col("pass") * F.col("source_size") + F.col("served") - F.col("size") + start + words
    packets = packets.select("row", "pass", start.alias("start"), words.alias("words"), "rank", end.alias("end"), F.try_divide(end, F.col("target")).alias("finish"), "budget")
    # Sources end within a packet of each other, so nothing that finishes later than this is reached.
    limit = documents.agg((1 + F.try_divide((F.max("rank") + 2) * quantum, F.max("budget"))).alias("limit"))
    packets = packets.join(F.broadcast(limit)).filter("finish <= limit").drop("limit")
    order = [F.col("finish"), F.col("rank"), F.col("end")]
    placed, before = running_sum(packets, order, "words", None, "packets")
    position = F.col("before") + F.col("seen") - F.col("words")
    left = F.floor(F.col("budget")).cast("long") - position
    out = placed.join(before, "part").select("row", "pass", "start", F.least("words", left).alias("words"), position.alias("position"))
    return documents, out.filter("words > 0")


def mixed(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``id_col, size, source_size, target, taken`` of every document: the words that ``mix`` takes of it, repeats counted."""
    documents, packets = mix(df, id_col=id_col, **options)
    taken = packets.groupBy("row").agg(F.sum("words").alias("taken"))
    out = documents.join(taken, "row", "left")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


SQL = rf"""
WITH d AS MATERIALIZED (
    SELECT doc_id, source, row_number() OVER () AS r, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
    FROM documents
), s AS (
    SELECT *, [5.0::DOUBLE, 2.0, 1.0][rank % 3 + 1] AS w, {float(MOST)} * source_size AS cap, {SHARE}::DOUBLE * sum(source_size) OVER () AS budget
    FROM (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
        FROM d GROUP BY source
    )
), f AS (
    SELECT *, sum(cap) OVER (ORDER BY cap / w) + cap / w * (sum(w) OVER () - sum(w) OVER (ORDER BY cap / w)) <= budget AS filled FROM s
), t AS MATERIALIZED (
    SELECT source, source_size, rank, budget, CASE WHEN filled THEN cap ELSE
        (budget - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ()) * w / sum(CASE WHEN filled THEN 0 ELSE w END) OVER () END AS target
    FROM f
), q AS MATERIALIZED (
    SELECT d.doc_id, d.r, d.size, t.*, sum(size) OVER (PARTITION BY rank ORDER BY key, doc_id, size, r) AS served
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
    SELECT r, rank, budget, words, (pass * source_size + served - size + start + words)::BIGINT AS reach, reach / target AS finish
    FROM (
        SELECT *, least({QUANTUM}, size - start) AS words
        FROM (SELECT *, unnest(range(0, size, {QUANTUM})) AS start FROM q, (VALUES (0), (1)) AS x(pass))
    )
), m AS (
    SELECT r, words, floor(budget) - (sum(words) OVER (ORDER BY finish, rank, reach) - words) AS room FROM p
), taken AS (
    SELECT r, sum(least(words, room))::BIGINT AS taken FROM m WHERE room > 0 GROUP BY r
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM q LEFT JOIN taken USING (r)
"""
