"""Best-fit packing of token pieces into sequences by exact-complement hashing of the sums of one, two and three lengths.

Only lengths matter, and there are at most ``capacity`` of them: the plan is made on the driver from a histogram of at
most ``capacity`` counts, whatever the number of documents. It lists patterns (lengths that fill one sequence) and how
often each is used; the pieces are then dealt to the places of the patterns by a join on length and rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import stored, text_or_empty, type_of
from .tokens import crc32, encoder

END_ID = 2


def token_pieces(
    df: DataFrame,
    capacity: int = 1024,
    vocabulary: str = "byte_bpe_50k.json",
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32`` (and ``ids``): the ids of each whole text and ``end_id``.

    Longer documents are cut into pieces of ``capacity``, the first of which may be shorter. Null texts count as empty
    and are one piece of the end id alone. Every input row gets its pieces, repeats too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                keys, numbers, starts, lengths, crcs, kept = [], [], [], [], [], []
                for key, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    ids = np.append(ids, np.uint16(end_id))
                    cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                    if len(ids) <= capacity:
                        cuts = [0, len(ids)]
                    for n, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                        keys.append(key)
                        numbers.append(n)
                        starts.append(start)
                        lengths.append(stop - start)
                        crcs.append(crc32(ids[start:stop]))
                        if with_ids:
                            kept.append(ids[start:stop].astype(np.int32))
                columns = [
                    pa.array(keys, type=part.schema.field(0).type),
                    pa.array(numbers, type=pa.int32()),
                    pa.array(starts, type=pa.int64()),
                    pa.array(lengths, type=pa.int64()),
                    pa.array(crcs, type=pa.int64()),
                ]
                names = [id_col, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(kept, type=pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_col}` {type_of(df, id_col)}, piece int, start long, length long, ids_crc32 long"
    texts = df.select(F.col(id_col).alias(id_col), text_or_empty(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, schema + ", ids array<int>" * with_ids)


class _Sums:
    """How many pieces of each length are left, and an index of the sums that one, two and three of them make.

    ``pairs[s]`` and ``triples[s]`` are the numbers of ways to make ``s``, under the counts that are left; they are brought up to
    date when a count falls to two, one or none, the only times they change.
    """

    def __init__(self, counts: np.ndarray):
        self.left, self.stale = counts.copy(), True

    def take(self, lengths: np.ndarray, times: np.ndarray) -> None:
        before = np.minimum(self.left[lengths], 3)
        self.left[lengths] -= times
        self.stale |= bool((np.minimum(self.left[lengths], 3) != before).any())

    def _index(self) -> None:
        """Ways to make a sum, counted by convolutions of what is there once, twice and three times."""
        size = len(self.left)
        once, twice, thrice = (np.asarray(self.left >= n, dtype=np.float64) for n in (1, 2, 3))
        once[0] = twice[0] = thrice[0] = 0
        spread = lambda x, n: np.bincount(n * np.arange(size), weights=x, minlength=n * size)[:size]
        ordered = np.convolve(once, once)[:size]
        self.pairs = (ordered - spread(once, 2)) / 2 + spread(twice, 2)
        two_and_one = np.convolve(spread(once, 2), once)[:size]
        apart = (np.convolve(ordered, once)[:size] - 3 * two_and_one + 2 * spread(once, 3)) / 6
        double = np.convolve(spread(twice, 2), once)[:size] - spread(twice, 3)
        self.triples, self.stale = apart + double + spread(thrice, 3), False

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """Lengths that sum to exactly ``gap``: one, else two, else three of them; of several ways, the one whose scarcest
        length is scarcest, and of those the one with the longest."""
        if self.left[gap]:
            return (gap,)
        if self.stale:
            self._index()
        if self.pairs[gap] > 0.5:
            return self._pair(gap)[1:]
        if self.triples[gap] < 0.5:
            return None
        best = None
        for first in np.flatnonzero(self.left[:gap])[::-1]:
            if 3 * first < gap:
                break
            self.left[first] -= 1
            found = self._pair(gap - int(first), int(first))
            self.left[first] += 1
            if found:
                scarcest = min(found[0], int(self.left[first]))
                if best is None or scarcest < best[0]:
                    best = (scarcest, int(first), *found[1:])
        return best[1:] if best else None

    def _pair(self, gap: int, largest: int | None = None) -> tuple[int, int, int] | None:
        """``(pieces left of the scarcer one, longer, shorter)``."""
        longer = np.arange(min(gap - 1, largest or gap), (gap - 1) // 2, -1)
        shorter = gap - longer
        there = (self.left[longer] > 0) & (self.left[shorter] > 0) & ((longer != shorter) | (self.left[longer] > 1))
        longer, shorter = longer[there], shorter[there]
        if not len(longer):
            return None
        scarcer = np.minimum(self.left[longer], self.left[shorter])
        at = int(scarcer.argmin())
        return int(scarcer[at]), int(longer[at]), int(shorter[at])


def exact_plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns by exact complements, largest lengths first. A pattern's gap goes to the longest piece that fits and lengths
    that fill the rest exactly; else, in a gap of more than a quarter, to that piece alone, since short pieces are kept for small
    gaps; else to lengths that fill the gap exactly; else to the longest piece that fits (best fit). Then on with the smaller
    gap. A pattern is used as often as the counts allow at once."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] += n
    sums, patterns = _Sums(counts), []
    one = np.ones(1, dtype=np.int64)
    for length in range(capacity, 0, -1):
        while sums.left[length] > 0:
            pattern, gap = [length], capacity - length
            sums.take(np.array([length]), one)
            while gap:
                fitting = np.flatnonzero(sums.left[: gap + 1] > 0)
                if not len(fitting):
                    break
                longest = int(fitting[-1])
                if longest == gap:
                    found = (gap,)
                else:
                    sums.take(np.array([longest]), one)
                    rest = sums.exact(gap - longest)
                    sums.take(np.array([longest]), -one)
                    found = (longest, *(rest or ()))
                    if not rest and 4 * gap <= capacity:
                        found = sums.exact(gap) or found
                sums.take(*np.unique(found, return_counts=True))
                pattern += found
                gap -= sum(found)
            used, per = np.unique(pattern, return_counts=True)
            more = int((sums.left[used] // per).min())
            sums.take(used, more * per)
            patterns.append((tuple(int(x) for x in pattern), 1 + more))
    return patterns


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of best fit decreasing, many equal sequences at a time: the pieces of a length, largest lengths first, go to
    the sequences with the smallest gap that holds them, each of which takes as many as fit."""
    open_: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]

    def put(gap: int, pattern: tuple[int, ...], times: int, left: int) -> int:
        """Give ``left`` pieces to ``times`` sequences with this gap; returns how many pieces remain."""
        most = gap // length
        full = min(times, left // most)
        if full:
            open_[gap - full_gap(most)].append((pattern + (length,) * most, full))
        left, times = left - full * most, times - full
        if times and 0 < left < most:
            open_[gap - full_gap(left)].append((pattern + (length,) * left, 1))
            left, times = 0, times - 1
        if times and gap < capacity:
            open_[gap].append((pattern, times))
        return left

    full_gap = lambda n: n * length
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for gap in range(length, capacity):
            held, open_[gap] = open_[gap], []
            for i, (pattern, times) in enumerate(held):
                if not left:
                    open_[gap] += held[i:]
                    break
                left = put(gap, pattern, times, left)
            if not left:
                break
        if left:
            put(capacity, (), -(-left // (capacity // length)), left)
    return [x for gap in open_ for x in gap]


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, times)``: patterns whose uses consume the histogram exactly, each of at most ``capacity``.

    The plan by exact complements, or plain best fit should that take fewer sequences.
    """
    used = lambda patterns: sum(times for _, times in patterns)
    return min(exact_plan(histogram, capacity), best_fit_plan(histogram, capacity), key=used)


def _places(spark: SparkSession, patterns: list[tuple[tuple[int, ...], int]]) -> DataFrame:
    """``length, first, last, per, base, shift``: which ranks of a length a pattern takes, and where they go."""
    rows, taken, base = [], {}, 0
    for lengths, times in patterns:
        offset = 0
        offsets: dict[int, list[int]] = {}
        for length in lengths:
            offsets.setdefault(length, []).append(offset)
            offset += length
        for length, at in offsets.items():
            first = taken.get(length, 0)
            taken[length] = first + times * len(at)
            rows.append((length, first, taken[length], base, at))
        base += times
    return spark.createDataFrame(rows, "length long, first long, last long, base long, offsets array<long>")


def pack(pieces: DataFrame, capacity: int = 1024, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sequences are gapless from 0 and hold at most ``capacity`` tokens.

    Needs a ``length`` of 1 to ``capacity`` in every row; a null or other length raises. Rows of equal length are
    interchangeable and dealt in ``order`` within a partition. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces.withColumn("_part", F.spark_partition_id()), "pieces")
    per_part = stored(pieces.groupBy("length", "_part").agg(F.count("*").alias("n")), "piece-counts")
    wrong = per_part.filter(f"length IS NULL OR length < 1 OR length > {capacity}").first()
    if wrong:
        raise ValueError(f"pieces must have 1 to {capacity} tokens, not {wrong['length']}")
    # At most `capacity` rows.
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(spark, plan(histogram, capacity))
    # Rank of a row among all of its length: those in earlier partitions, and those before it in its own.
    before = "coalesce(sum(n) OVER (PARTITION BY length ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
    before = per_part.select("length", "_part", F.expr(before).alias("_before"))
    inner = f"row_number() OVER (PARTITION BY length, _part ORDER BY {', '.join(order)}) - 1"
    ranked = pieces.withColumn("_rank", F.expr(inner)).join(before, ["length", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    # A length has few patterns; their rank ranges are found in a sorted array rather than by a range join.
    listed = places.groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("first", "last", "base", "offsets"))).alias("_places")
    )
    placed = ranked.join(F.broadcast(listed), "length")  # at most `capacity` rows, as many places as patterns
    place = F.get(F.filter("_places", lambda p: (p["first"] <= F.col("_rank")) & (F.col("_rank") < p["last"])), 0)
    placed = placed.withColumn("_place", place).withColumn("_at", F.expr("_rank - _place.first"))
    width = F.size("_place.offsets")
    return placed.select(
        *(c for c in pieces.columns if c != "_part"),
        (F.col("_place.base") + F.floor(F.col("_at") / width)).cast("long").alias("sequence_id"),
        F.get("_place.offsets", (F.col("_at") % width).cast("int")).alias("offset"),
    )
