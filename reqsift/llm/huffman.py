"""Token ids in files of canonical, length-limited Huffman codes, in blocks that decode on their own.

Counts of all ids give the code lengths (at most ``MAX_BITS``); the lengths alone define the codes. A block holds the ids
of consecutive documents or of a part of a long one, with a bit offset every ``STRIDE`` ids, so that a reader can start
at any of them and decodes many stretches at a time by one table look-up per id.

A file is a Parquet table of blocks in ascending document order: Parquet is only the container that lets Spark write
to any store, commit whole tasks and read blocks in parallel. Block layout: see ``pack_block``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import stored, text_or_empty, type_of
from .tokens import encoder

MAX_BITS, STRIDE, BLOCK_IDS = 20, 128, 1 << 16
END_ID = 2


# --- codes ------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for ids that don't occur, 1 for a lone id."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    used = used[np.lexsort((used, counts[used]))]
    weights = counts[used].astype(np.float64)
    # Each level merges the pairs of the level below with the ids; only how many of a level's first items are ids matters.
    items, is_leaf = weights, [np.ones(len(used), dtype=bool)]
    for _ in range(limit - 1):
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate((weights, pairs))
        order = np.argsort(merged, kind="stable")
        items = merged[order]
        is_leaf.append(order < len(weights))
    take = 2 * len(used) - 2
    for level in reversed(is_leaf):
        leaves = int(level[:take].sum())
        lengths[used[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length and then id."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code, before = 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for i in order[np.searchsorted(lengths[order], 1) :]:
        code <<= int(lengths[i]) - before
        before = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and code length for every window of ``bits`` bits that starts with a code."""
    bits = int(lengths.max(initial=1))
    codes = canonical_codes(lengths)
    ids, sizes = np.zeros(1 << bits, dtype=np.uint16), np.zeros(1 << bits, dtype=np.uint8)
    used = np.flatnonzero(lengths)
    spans = 1 << (bits - lengths[used].astype(np.int64))
    starts = codes[used].astype(np.int64) * spans
    order = np.argsort(starts)
    filled = int(spans.sum())
    ids[:filled] = np.repeat(used[order], spans[order])
    sizes[:filled] = np.repeat(lengths[used][order], spans[order])
    return ids, sizes, bits


# --- blocks -----------------------------------------------------------------------------------------


def pack_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    """``count`` (u32), the bit offset of every ``STRIDE``-th id (u32 each), the codes, most significant bit first."""
    size = lengths[ids].astype(np.uint64)
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1]) if len(ids) else 0
    words = np.zeros(total // 32 + 2, dtype=np.uint64)
    shift = np.uint64(64) - (starts & np.uint64(31)) - size
    window = codes[ids] << shift
    at = (starts >> np.uint64(5)).astype(np.int64)
    if len(ids):
        first = np.flatnonzero(np.diff(at, prepend=-1))
        sums = np.bitwise_or.reduceat(window, first)  # codes that start in the same word
        words[at[first]] |= sums >> np.uint64(32)
        words[at[first] + 1] |= sums & np.uint64(0xFFFFFFFF)
    head = np.concatenate(([len(ids)], starts[::STRIDE])).astype("<u4").tobytes()
    return head + words.astype(">u4").tobytes()


def unpack_blocks(blocks: list[bytes], table: tuple[np.ndarray, np.ndarray, int]) -> list[np.ndarray]:
    """The ids of several blocks; every stretch between two bit offsets advances by one id per step, all together."""
    to_id, to_size, bits = table
    counts, offsets, data, base = [], [], [], 0
    for block in blocks:
        n = int(np.frombuffer(block, "<u4", 1)[0])
        marks = -(-n // STRIDE)
        bit = np.frombuffer(block, "<u4", marks, 4).astype(np.int64)
        body = np.frombuffer(block, ">u4", -1, 4 + 4 * marks)
        counts.append(n)
        offsets.append(bit + 32 * base)
        data.append(body)
        base += len(body)
    words = np.concatenate(data).astype(np.uint64) if data else np.empty(0, np.uint64)
    pairs = (words[:-1] << np.uint64(32)) | words[1:] if len(words) > 1 else np.empty(0, np.uint64)
    at = np.concatenate(offsets) if offsets else np.empty(0, np.int64)
    sizes = [np.minimum(STRIDE, n - np.arange(0, n, STRIDE)) for n in counts]
    left = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
    out = np.zeros((len(at), STRIDE), dtype=np.uint16)
    lanes = np.arange(len(at))
    down = np.uint64(64 - bits)
    for step in range(int(left.max(initial=0))):
        if step and (left[lanes] <= step).any():
            keep = left[lanes] > step
            lanes, at = lanes[keep], at[keep]
        window = ((pairs[at >> 5] << (at & 31).astype(np.uint64)) >> down).astype(np.int64)
        out[lanes, step] = to_id[window]
        at = at + to_size[window]
    flat = out[np.arange(STRIDE) < left[:, None]]
    return np.split(flat, np.cumsum(counts)[:-1]) if counts else []


# --- Spark ------------------------------------------------------------------------------------------


def token_ids(df: DataFrame, vocabulary: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """``id_col, ids``: the ids of each whole text (null: empty) and ``end_id``, as little-endian 16-bit values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary).encode, np.uint16(end_id).astype("<u2").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [x.tobytes() + end for x in encode(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, type=pa.binary())], names=[id_col, "ids"])

    texts = df.select(F.col(id_col), text_or_empty(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"`{id_col}` {type_of(df, id_col)}, ids binary")


def count_ids(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in all rows; one row per id and task reaches the shuffle, one per id the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                data = b"".join(batch.column(0).slice(at, 512).to_pylist())
                counts += np.bincount(np.frombuffer(data, "<u2"), minlength=1 << 16)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, type=pa.int32()), pa.array(counts[used])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << 16, dtype=np.int64)
    for row in rows:
        counts[row["id"]] = row["n"]
    return counts


def write_token_file(
    df: DataFrame, path: str, vocabulary: str = "word_bpe_49k.json", id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> None:
    """Encode all texts and write ``path/blocks`` and ``path/codes``, in ascending order of ``id_col`` (nulls first).

    Rows of equal id keep all their ids, in any order among them. An empty table gives files without blocks.
    """
    spark = df.sparkSession
    tokens = stored(token_ids(df, vocabulary, id_col, text_col, end_id), "token-ids")
    lengths = code_lengths(count_ids(tokens))
    spark.createDataFrame([(bytes(lengths),)], "lengths binary").write.parquet(f"{path}/codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        number = 0

        def block() -> pa.RecordBatch:
            # Per document in the block: its ids here, and whether they are its last.
            row = {"block": number, "doc": docs, "n": sizes, "ends": ends, "data": pack_block(np.concatenate(held), codes, lengths)}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        docs, sizes, ends, held, size = [], [], [], [], 0
        schema = None
        for batch in batches:
            schema = schema or pa.schema(
                [
                    ("block", pa.int64()),
                    ("doc", pa.list_(batch.schema.field(0).type)),
                    ("n", pa.list_(pa.int32())),
                    ("ends", pa.list_(pa.bool_())),
                    ("data", pa.binary()),
                ]
            )
            for i in range(batch.num_rows):
                key, ids = batch.column(0)[i].as_py(), np.frombuffer(batch.column(1)[i].as_py(), "<u2")
                at = 0
                while at < len(ids):
                    part = ids[at : at + BLOCK_IDS - size]
                    at += len(part)
                    size += len(part)
                    docs.append(key)
                    sizes.append(len(part))
                    ends.append(at == len(ids))
                    held.append(part)
                    if size == BLOCK_IDS:
                        yield block()
                        number += 1
                        docs, sizes, ends, held, size = [], [], [], [], 0
        if held:
            yield block()

    kind = type_of(df, id_col)
    ordered = tokens.repartitionByRange(F.col(id_col).asc_nulls_first()).sortWithinPartitions(F.col(id_col).asc_nulls_first())
    blocks = ordered.mapInArrow(run, f"block long, doc array<{kind}>, n array<int>, ends array<boolean>, data binary")
    # The number of the range partition leads the number of the block in it.
    blocks.withColumn("part", F.spark_partition_id()).write.parquet(f"{path}/blocks")


def read_token_file(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """``id_col, start, n_tokens, ids_crc32`` (and ``ids``) per document, decoded block by block.

    Blocks of a part are read in order, since a long document runs over several; its checksum is carried along.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    lengths = np.frombuffer(spark.read.parquet(f"{path}/codes").first()["lengths"], dtype=np.uint8)
    kind = blocks.schema["doc"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths)
        part, inner, n, crc, whole = None, 0, 0, 0, []
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                few = batch.slice(at, 32)
                rows = []
                column = {name: few.column(name).to_pylist() for name in ("part", "doc", "n", "ends", "data")}
                for i, ids in enumerate(unpack_blocks(column["data"], table)):
                    if column["part"][i] != part:
                        part, inner = column["part"][i], 0
                    wide, cut = ids.astype("<u4"), 0
                    for doc, size, end in zip(column["doc"][i], column["n"][i], column["ends"][i]):
                        crc = zlib.crc32(wide[cut : cut + size].data, crc)
                        if with_ids:
                            whole.append(wide[cut : cut + size])
                        cut += size
                        n += size
                        if end:
                            rows.append((doc, part, inner, n, crc, np.concatenate(whole) if with_ids else None))
                            inner += n
                            n, crc, whole = 0, 0, []
                if rows:
                    types = [few.schema.field("doc").type.value_type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                    names = [id_col, "part", "inner", "n_tokens", "ids_crc32", "ids"]
                    arrays = [pa.array(c, type=t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    parts = blocks.select("part", F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = parts.groupBy("part").agg(F.sum("n").alias("n"))
    # One row per part of the file, not per document.
    first = F.expr("coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)")
    parts = parts.select(F.col("part").alias("_p"), first.alias("first"))
    ordered = blocks.repartition("part").sortWithinPartitions("part", "block").select("part", "doc", "n", "ends", "data")
    schema = f"`{id_col}` {kind.simpleString()}, part int, inner long, n_tokens long, ids_crc32 long, ids array<int>"
    docs = ordered.mapInArrow(run, schema).join(F.broadcast(parts), F.col("part") == F.col("_p"))
    out = docs.withColumn("start", F.col("first") + F.col("inner"))
    return out.select(id_col, "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
