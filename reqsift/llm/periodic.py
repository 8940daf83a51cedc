"""Runs of periodically repeated words, by block convolution.

At scale ``b`` (1, 2, 4, ...) a sequence of word numbers is cut into blocks of ``b``. A run of period ``b <= p < 2b`` and at
least four periods holds a whole block that occurs again ``p`` words later. The sums of squared differences of a block
and every stretch of the window that follows it come from one cyclic convolution, a number-theoretic transform over
integers: a sum of zero is an occurrence, and its distance is the seed of a run, which is then extended word by word.

Blocks that cannot take part are left out before, without loss: the words of the block and of the next one each occur
again within ``2b - 1`` words, else no run of this scale begins in the block before; and a block well inside a known run of a
smaller period has only multiples of that period. Texts are joined with words that occur nowhere else, so one pass covers
many of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import WORD, text_or_empty, type_of

#: Least periods in a run and least words in one.
EXPONENT, LEAST = 4, 6
#: Primes of the form ``c * 2**m + 1`` below 2**32 with a generator: fixed values.
PRIMES = ((3221225473, 5), (2013265921, 31))
#: Elements that are transformed together, and bytes of text that are scanned together.
CHUNK, SLICE = 1 << 17, 1 << 21
_U = np.uint64


# --- integer convolution ----------------------------------------------------------------------------


@lru_cache(maxsize=128)
def _roots(size: int, prime: int, generator: int, inverse: bool) -> np.ndarray:
    """The first half of the powers of a root of unity of order ``size``."""
    root = pow(generator, (prime - 1) // size, prime)
    root = pow(root, -1, prime) if inverse else root
    out = np.ones(max(size // 2, 1), dtype=_U)
    have = 1
    while have < len(out):
        out[have : 2 * have] = out[:have] * _U(pow(root, have, prime)) % _U(prime)
        have *= 2
    return out


def _reduced(x: np.ndarray, p: np.uint64) -> np.ndarray:
    """``x`` below ``2 p``, modulo ``p``: what is below ``p`` wraps around to something huge."""
    return np.minimum(x, x - p)


def _forward(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform of each column; rows come out in bit-reversed order."""
    size, p = len(x), _U(prime)
    half = size // 2
    while half:
        pair = x.reshape(size // (2 * half), 2, half, -1)
        a, b = pair[:, 0], pair[:, 1]
        w = _roots(2 * half, prime, generator, False)[:, None]
        x = np.stack((_reduced(a + b, p), (a + (p - b)) % p * w % p), axis=1).reshape(size, -1)
        half //= 2
    return x


def _backward(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Inverse of ``_forward``."""
    size, p = len(x), _U(prime)
    half = 1
    while half < size:
        pair = x.reshape(size // (2 * half), 2, half, -1)
        a, b = pair[:, 0], pair[:, 1] * _roots(2 * half, prime, generator, True)[:, None] % p
        x = np.stack((_reduced(a + b, p), _reduced(a + (p - b), p)), axis=1).reshape(size, -1)
        half *= 2
    return x * _U(pow(size, -1, prime)) % p


def squared_differences(blocks: np.ndarray, windows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Modulo ``prime``: the sum of squared differences of ``blocks[:, r]`` (b words) and each of the first ``b`` stretches of
    ``windows[:, r]`` (2b words), by distance and ``r``."""
    b, p = len(blocks), _U(prime)
    blocks, windows = blocks.astype(_U) % p, windows.astype(_U) % p
    turned = np.zeros_like(windows)
    turned[:b] = blocks[::-1]
    product = _forward(turned, prime, generator) * _forward(windows, prime, generator) % p
    cross = _backward(product, prime, generator)[b - 1 : 2 * b - 1]
    sums = np.zeros((2 * b + 1, windows.shape[1]), dtype=_U)
    np.cumsum(windows * windows % p, axis=0, out=sums[1:])
    own = (blocks * blocks % p).sum(axis=0)
    total = own + (sums[b : 2 * b] - sums[:b])
    return (total % p + (p - cross) * _U(2)) % p


def occurrences(ids: np.ndarray, starts: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """``(start, distance)`` of each stretch equal to the block of ``b`` words at ``starts``, ``b`` to ``2b - 1`` words after it.

    A sum that is zero modulo the first prime is taken modulo the second one too: below their product, some 2**62, zero
    means zero, and beyond, the extension compares the words.
    """
    found = [], []
    step = max(1, CHUNK // (2 * b))
    for at in range(0, len(starts), step):
        first = starts[at : at + step]
        place = first + np.arange(3 * b)[:, None]
        words = ids[np.minimum(place, len(ids) - 1)]  # the last word occurs only there
        blocks, windows = words[:b], words[b:]
        for prime in PRIMES:
            zero = squared_differences(blocks, windows, *prime) == 0
            keep = np.flatnonzero(zero.any(axis=0))
            first, blocks, windows, zero = first[keep], blocks[:, keep], windows[:, keep], zero[:, keep]
            if not len(keep):
                break
        shift, row = np.nonzero(zero)
        found[0].append(first[row])
        found[1].append(shift + b)
    return np.concatenate([*found[0], np.empty(0, np.int64)]), np.concatenate([*found[1], np.empty(0, np.int64)])


# --- runs -------------------------------------------------------------------------------------------


def _next_distance(ids: np.ndarray) -> np.ndarray:
    """How many words later each word occurs again; the length of ``ids`` where it doesn't."""
    out = np.full(len(ids), len(ids), dtype=np.int64)
    order = np.argsort(ids, kind="stable")
    again = ids[order[1:]] == ids[order[:-1]]
    out[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return out


def _extended(ids: np.ndarray, at: int, d: int) -> tuple[int, int]:
    """The longest stretch around ``at`` in which words ``d`` apart are equal."""
    end, step = at, 32
    while end + d < len(ids):
        stop = min(end + step, len(ids) - d)
        differ = ids[end:stop] != ids[end + d : stop + d]
        k = int(differ.argmax())
        if differ[k]:
            end += k
            break
        end, step = stop, min(2 * step, 1 << 16)
    start, step = at, 32
    while start > 0:
        stop = max(start - step, 0)
        differ = (ids[stop:start] != ids[stop + d : start + d])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            start -= k
            break
        start, step = stop, min(2 * step, 1 << 16)
    return start, end + d


class _Covered:
    """Tells stretches that lie inside one known run."""

    def __init__(self, runs: list[tuple[int, int, int]]):
        spans = sorted((s, e) for s, e, _ in runs)
        self.starts = np.array([s for s, _ in spans], dtype=np.int64)
        self.reach = np.maximum.accumulate(np.array([e for _, e in spans], dtype=np.int64)) if spans else self.starts

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(len(start), dtype=bool)
        at = np.searchsorted(self.starts, start, side="right") - 1
        return (at >= 0) & (self.reach[at] >= end)


def find_runs(ids: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of every run in ``ids``, by start and period. The last of ``ids`` must occur only there.

    A run is a stretch of at least ``exponent`` (4 or more) times its smallest period and at least ``least`` words (not more than
    twice ``exponent``) that keeps its period and cannot be longer.
    """
    if exponent < 4 or least > 2 * exponent:
        raise ValueError("runs have at least four periods, and at least so many words that one of period 2 has them")
    runs: list[tuple[int, int, int]] = []
    far, b = _next_distance(ids), 1
    while exponent * b <= len(ids):
        near = far < 2 * b
        starts = np.flatnonzero(near[:-1] & near[1:]) * b
        covered = _Covered(runs)
        starts = starts[~covered(starts, starts + 3 * b - 1)]
        if len(starts):
            at, d = occurrences(ids, starts, b)
            open_ = ~covered(at, at + b + d)
            at, d = at[open_], d[open_]
            order = np.lexsort((at, d))
            at, d = at[order], d[order]
            # Neighbouring blocks with equal distance lie in the same stretch.
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = (np.diff(d) != 0) | (np.diff(at) != b)
            stretches = {(*_extended(ids, a, q), q) for a, q in zip(at[fresh].tolist(), d[fresh].tolist())}
            runs += [(s, e, q) for s, e, q in stretches if e - s >= max(least, exponent * q)]
        if len(far) % 2:
            far = np.append(far, len(ids))  # a block that is not whole
        far = far.reshape(-1, 2).max(axis=1)
        b *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    words = [w for text in texts for w in text]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    ids = np.empty(len(words) + len(texts), dtype=np.int64)
    own = np.ones(len(ids), dtype=bool)
    own[ends - 1] = False
    ids[own] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    ids[ends - 1] = len(number) + np.arange(len(texts))  # a word after each text that occurs nowhere else
    found = find_runs(ids)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    which = np.searchsorted(ends, [s for s, _, _ in found], side="right")
    for text, (s, e, q) in zip(which.tolist(), found):
        first = int(ends[text] - sizes[text] - 1)
        out[text].append((s - first, e - first, q))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that are in the first period of every run that holds them, joined by one space."""
    if runs:
        repeats = np.zeros(len(words) + 1, dtype=np.int64)
        for s, e, q in runs:
            repeats[s + q] += 1
            repeats[e] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(repeats[:-1]) == 0).tolist()]
    return b" ".join(words)


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, runs, collapsed``: the runs of each whole text by start and period, and the text without their repeats.

    Words are stretches without the six ASCII white-space characters, compared byte by byte and numbered from 0. Null, empty
    and blank texts have no runs and collapse to an empty text. Every row is a text of its own, whatever its id. Other
    columns are left aside.
    """
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def scanned(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        words = [t.split() for t in texts]  # at the six ASCII white-space characters
        found = runs_of_texts(words)
        flat = [r for runs in found for r in runs]
        columns = np.array(flat, dtype=np.int64).reshape(-1, 3).T
        fields = pa.StructArray.from_arrays([columns[0], columns[1] - columns[0], columns[2]], names=["start", "length", "period"])
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in found]))).astype(np.int32)
        lists = pa.ListArray.from_arrays(offsets, fields).cast(run_type)
        short = pa.array([collapsed(w, r) for w, r in zip(words, found)], type=pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([part.column(0), lists, short], names=[id_col, "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size, held = 0, 0, []
            for i in range(batch.num_rows):
                held.append(batch.column(1)[i].as_py())
                size += len(held[-1])
                if size >= SLICE or i + 1 == batch.num_rows:
                    yield scanned(batch.slice(first, len(held)), held)
                    first, size, held = i + 1, 0, []

    texts = df.select(F.col(id_col), text_or_empty(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(run, f"`{id_col}` {type_of(df, id_col)}, runs {RUNS}, collapsed string")


def longest(runs: str = "runs") -> Column:
    """The longest run (ties: smallest start, then period), or null."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(best.isNotNull(), F.struct((-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period")))


def digest_columns(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("best", longest())
    best = F.col("best")
    return rows.select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_col``, where the tail of every tenth text (by CRC-32 of its id) repeats a stretch of itself."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    chosen = df.select(id_col, text_col, F.floor(h / 10).alias("g"), (h % 10 == 0).alias("some"))
    words = F.when(F.col("some"), F.regexp_extract_all(text_or_empty(text_col), F.lit(f"({WORD})")))
    counted = chosen.withColumn("words", words).withColumn("n", F.size("words"))
    # Null unless the text is chosen and has words: the rest then stays null too, and the text as it is.
    n = F.when(F.col("n") > 0, F.col("n"))
    placed = counted.withColumn("n", n).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("int")
    placed = placed.withColumn("p", period)
    left = F.col("n") - F.col("a")
    stretch = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(stretch, F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return placed.select(id_col, F.when(F.col("n").isNotNull(), changed).otherwise(F.col(text_col)).alias(text_col))


SQL = r"""
WITH crc_table AS MATERIALIZED (
    SELECT list(list_reduce([b] || range(8), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY b) AS t
    FROM range(256) AS x(b)
), h AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM documents, crc_table
), a AS (
    SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h
), m AS MATERIALIZED (
    SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i:
        w[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END) + 1]) END AS w
    FROM a
), word AS MATERIALIZED (
    SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM m
), pair AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM word x JOIN word y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), stretch AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair)
    GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), run AS MATERIALIZED (
    SELECT doc_id, start, length, min(q) AS period FROM stretch GROUP BY doc_id, start, length
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM word ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
), per AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
           arg_max({'start': start, 'length': length, 'period': period}, (length, -start, -period)) AS best
    FROM run GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM m LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
