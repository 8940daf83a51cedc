"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

Equal shingle sets are one node first, so exact copies never meet in a bucket. Buckets are not expanded into pairs:
every bucket links its members to one of them, the one with most company in all buckets, and only where a bucket still
spans several components are its members compared with each other, as blocks of sketches in numpy. All that passes the
sketch is confirmed on full sets. No bucket, partner or candidate is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as S
from .components import components
from .store import discard, runs, stored, type_of

#: 240 slots in 40 bands of 6: a pair at a similarity of 0.8 shares no band with a probability of 5e-6.
SLOTS, ROWS = 240, 6
#: A sketch may estimate this much too little (some 4.6 standard deviations at 0.8) before a pair goes unconfirmed.
SLACK = 0.12
#: Members of a bucket that are compared with each other in one task at a time.
BLOCK = 512
#: Nodes whose texts are fetched by a broadcast of their names, some 100 bytes each; more of them by a shuffle of the texts.
BROADCAST_NODES = 500_000
_BATCH_SHINGLES = 1 << 16


def _node(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(df: DataFrame, id_col: str, text_col: str, width: int, slots: int = SLOTS, rows: int = ROWS) -> DataFrame:
    """``id, n_shingles, node, sketch, bands`` per row; ``node`` names the shingle set and is null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            full = [s for s in sets if len(s)]
            signature = S.super_minhash(full, slots) if full else np.empty((0, slots), np.uint64)
            sketches, bands = iter(S.sketch(signature)), iter(S.band_keys(signature, rows))
            node = [_node(s) if len(s) else None for s in sets]
            columns = [
                pa.array(ids, type=id_type),
                pa.array([len(s) for s in sets], type=pa.int64()),
                pa.array(node, type=pa.binary()),
                pa.array([n and next(sketches).tobytes() for n in node], type=pa.binary()),
                pa.array([n and next(bands) for n in node], type=pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["id", "n_shingles", "node", "sketch", "bands"])

        ids, sets, held = [], [], 0
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids.append(key)
                    sets.append(S.shingle_set(text, width))
                    held += len(sets[-1])
                    if held >= _BATCH_SHINGLES or len(sets) >= 4096:
                        yield flush()
                        ids, sets, held = [], [], 0
        if sets:
            yield flush()

    schema = f"id {type_of(df, id_col)}, n_shingles long, node binary, sketch binary, bands array<bigint>"
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _sets_of(df: DataFrame, id_col: str, text_col: str, wanted: DataFrame, width: int) -> DataFrame:
    """``node, shingles`` (sorted, as bytes) of the nodes in ``wanted`` (``node, id``), made again from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                nodes, sets = [], []
                for node, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    shingles = S.shingle_set(text, width)
                    if _node(shingles) == node:  # another text of the same id is not meant
                        nodes.append(node)
                        sets.append(shingles.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, type=pa.binary()), pa.array(sets, type=pa.binary())], names=["node", "shingles"]
                )

    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if wanted.count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    joined = texts.join(wanted, wanted["id"].eqNullSafe(texts["id"])).select("node", "text")
    # Nodes named by a null or repeated id meet several texts; equal sets are the same bytes.
    return joined.mapInArrow(run, "node binary, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))


def _likely(n1, n2, same, percent: int):
    """Sizes and share of equal sketch bytes allow ``percent``; works on arrays."""
    sizes = 100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)
    return sizes & (same >= percent / 100 - SLACK)


def _star_pairs(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``left, right``: every member of a bucket with the most popular one, where the sketches allow it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n1, n2 = batch.column("n_left").to_numpy(), batch.column("n_right").to_numpy()
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("s_left", "s_right"))
                same = (a == b).reshape(batch.num_rows, -1).mean(axis=1)
                yield batch.select(["left", "right"]).filter(pa.array(_likely(n1, n2, same, percent)))

    popular = members.groupBy("node").agg(F.sum("members").alias("company"))
    hubs = members.join(popular, "node").groupBy("key").agg(F.min(F.struct(-F.col("company"), "node")).alias("best"))
    pairs = members.join(hubs.select("key", F.col("best.node").alias("hub")), "key").filter("node != hub")
    pairs = pairs.select(F.least("node", "hub").alias("left"), F.greatest("node", "hub").alias("right")).distinct()
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    joined = pairs.join(side("left"), "left").join(side("right"), "right")
    return joined.mapInArrow(run, "left binary, right binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
            keep = [S.similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in rows]
            yield batch.select(["left", "right"]).filter(pa.array(keep, type=pa.bool_()))

    side = lambda c, s: sets.select(F.col("node").alias(c), F.col("shingles").alias(s))
    joined = pairs.join(side("left", "a"), "left").join(side("right", "b"), "right")
    return joined.mapInArrow(run, "left binary, right binary")


def _open_pairs(members: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """``key, lo, hi, left, right``: per block of a bucket, its likely pairs between different components.

    A pair is looked at in the first band it shares only, so the buckets of one group don't repeat each other's work.
    """

    def pairs_of(group: pa.Table) -> dict | None:
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        key = group.column("key")[0].as_py()
        node, root = group.column("node").to_pylist(), np.array(group.column("root").to_pylist(), dtype=object)
        n, block = group.column("n_shingles").to_numpy(), group.column("block").to_numpy()
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
        bands = np.array(group.column("bands").to_pylist(), dtype=np.int64)
        _, root = np.unique(root, return_inverse=True)
        left, right = [], []
        firsts = np.flatnonzero(block == lo)
        seconds = np.flatnonzero(block == hi)
        for i in firsts:
            others = seconds[seconds > i] if lo == hi else seconds
            others = others[root[others] != root[i]]
            others = others[100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i])]
            if len(others):
                others = others[_likely(n[others], n[i], (sketch[others] == sketch[i]).mean(axis=1), percent)]
            if len(others):
                shared = bands[others] == bands[i]
                others = others[bands[i][shared.argmax(axis=1)] == key]
            left += [node[i]] * len(others)
            right += [node[j] for j in others]
        return {"key": key, "lo": lo, "hi": hi, "left": left, "right": right} if left else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.binary())
        schema = pa.schema([("key", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("left", kind), ("right", kind)])
        held, size = [], 0
        for group in runs(batches, ["key", "lo", "hi"]):
            if found := pairs_of(group):
                held.append(found)
                size += len(found["left"])
                if size > 100_000 or len(held) > 1000:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    spans = rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("n"))
    spans = spans.filter("least != most").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    open_ = rooted.join(spans, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = open_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "root"
    )
    full = dealt.join(nodes.select("node", "n_shingles", "sketch", "bands"), "node")
    ordered = full.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "node")
    return ordered.mapInArrow(run, "key long, lo int, hi int, left array<binary>, right array<binary>")


def _confirm_blocks(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``left, right``: the pairs of ``_open_pairs`` that hold; every set goes to a block once, not once per pair."""

    def run(pairs: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        held = {n: np.frombuffer(s, np.uint64) for n, s in zip(members["node"], members["shingles"])}
        found = [
            (a, b)
            for lefts, rights in zip(pairs["left"], pairs["right"])
            for a, b in zip(lefts, rights)
            if a in held and b in held and S.similar(held[a], held[b], percent)
        ]
        return pd.DataFrame(found, columns=["left", "right"])

    keys = ["key", "lo", "hi"]
    involved = F.explode(F.array_distinct(F.concat("left", "right"))).alias("node")
    members = blocks.select(*(F.col(k).alias(f"m_{k}") for k in keys), involved).join(sets, "node")
    grouped = blocks.groupBy(*keys).cogroup(members.groupBy(*(f"m_{k}" for k in keys)))
    return grouped.applyInPandas(run, "left binary, right binary")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """Groups of documents linked by ``100 * |A & B| >= percent * |A | B|`` over their sets of ``width``-word shingles.

    One row per input row: ``id_col, n_shingles, component_id`` (smallest id reachable) and ``kept`` (it is that id).
    A null or empty text, or one without words, has no shingles and is its own component. Repeated rows each get
    their row. A null id takes part, but is never the smallest: its ``component_id`` is null only if no id is in its
    component, and it is kept then. An empty table gives an empty result. Further columns are ignored.
    """
    return _grouped(df, id_col, text_col, width, percent)[0]


def _grouped(df: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """The result of ``near_duplicates``, and the stored tables it reads."""
    marks = stored(signatures(df, id_col, text_col, width), "signatures")
    nodes = marks.filter("node is not null").groupBy("node").agg(F.min("id").alias("id"))
    nodes = stored(
        nodes.join(marks.select("node", "id", "n_shingles", "sketch", "bands").withColumnRenamed("id", "own"), "node")
        .filter("id <=> own")
        .dropDuplicates(["node"])
        .drop("own"),
        "nodes",
    )
    full, marks = marks, stored(marks.select("id", "n_shingles", "node"), "marks")
    discard(full)
    rows = nodes.select("node", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    members = stored(rows.join(buckets, "key"), "buckets")
    wanted = stored(nodes.select("node", "id").join(members.select("node").distinct(), "node"), "bucketed")
    sets = stored(_sets_of(df, id_col, text_col, wanted, width), "sets")
    links = stored(_confirmed(_star_pairs(members, nodes, percent), sets, percent), "star-links")
    roots = stored(components(links), "roots")
    blocks = stored(_open_pairs(members, nodes, roots, percent), "open-pairs")
    more = stored(_confirm_blocks(blocks, sets, percent), "open-links")
    if not more.isEmpty():
        known = roots.filter("node != root").select(F.col("node").alias("left"), F.col("root").alias("right"))
        roots = stored(components(known.union(more)), "all-roots")
    discard(members, wanted, sets, links, blocks, more)
    rooted = nodes.select("node", "id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    groups = rooted.join(least, "root").select("node", "component_id")
    out = marks.select("id", "n_shingles", "node").join(groups, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    out = out.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
    return out, [marks, nodes, roots]


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df``, with all their columns, that come first in their group: smallest id, nulls last, then by text.

    Rows repeated whole stay or go together. Only keys of the rows to drop are joined, so the texts need not move while
    those are few.
    """
    text = F.col(text_col)
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"))
    groups, tables = _grouped(df.select(key.alias("key"), text.alias("text")), "key", "text", width, percent)
    dropped = stored(groups.filter("NOT kept").select(F.col("key").alias("_dropped")).distinct(), "near-dropped")
    discard(*tables)
    rows = df.select(F.struct("*").alias("_row"), key.alias("_own"))
    return rows.join(dropped, F.col("_own").eqNullSafe(F.col("_dropped")), "left_anti").select("_row.*")
