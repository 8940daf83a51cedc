"""Texts as pieces: cut on their UTF-8 bytes, and told apart, for many texts at a time (numpy, inside tasks).

A piece is a stretch between two separators, and its leading run of Latin letters is a piece of its own where one of the
``closers`` follows. Natural text repeats its pieces, so work per distinct piece is much less than work per piece.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from .shingles import mix

_U = np.uint64
#: Bytes of text that are cut at a time, and where memory is short.
SLICE = 1 << 21
SMALL = 1 << 19
CLOSERS = b" \n.,;:!?|%&*#$"
_ASCII = np.zeros(256, dtype=bool)
_ASCII[65:91] = _ASCII[97:123] = True
_BASES = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=2)
def _both_powers(size: int) -> list[np.ndarray]:
    """Of each base, ``size`` of them: up to 32 MB, made where texts are cut, which neither the driver nor every worker does."""
    return [_powers(b, size) for b in _BASES]


@dataclass
class Pieces:
    """``distinct`` pieces as UTF-8 and whether each is a ``plain`` word (Latin letters, with ``keep`` after a space), which
    of them every piece is (in text order), and how many pieces each text has."""

    distinct: list[bytes]
    plain: np.ndarray
    which: np.ndarray
    counts: np.ndarray


def _latin(data: np.ndarray) -> np.ndarray:
    """Bytes of A-Z, a-z and of the letters in U+00C0 to U+00FF."""
    letters = _ASCII[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    letters[lead] = letters[lead + 1] = True
    return letters


def _bounds(data: np.ndarray, first: np.ndarray, separators: bytes, keep: bool, closers: bytes, runs: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of texts that lie one after another, and whether they are plain words; ``first`` are
    the places where texts start.

    With ``keep`` a separator begins the next piece, and cuts only if a Latin letter follows; else it belongs to none. Without
    ``runs`` nothing is cut inside a run of separators.
    """
    size, letters = len(data), _latin(data)
    separates = np.zeros(size, dtype=bool)
    for byte in separators:
        separates |= data == byte
    if keep:
        cut = separates.copy()
        follows = letters.copy()
        follows[first] = False  # a letter of the next text
        cut[:-1] &= follows[1:]
        cut[-1:] = False
        if not runs:
            cut[1:] &= ~separates[:-1]
        cut[first] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], size)
    else:
        inside = ~separates
        begins = inside.copy()
        begins[1:] &= separates[:-1]
        begins[first] = inside[first]
        starts = np.flatnonzero(begins)
        stops = separates.copy()
        stops[first] = True
        stops = np.append(np.flatnonzero(stops), size)
        ends = stops[np.searchsorted(stops, starts, side="right")]
    if not len(starts):
        return starts, ends, np.empty(0, dtype=bool)
    # Where the run of letters at the start of a piece (after its separator) ends.
    others = np.append(np.flatnonzero(~letters), size)
    run = starts + (separates[starts] if keep else 0)
    stop = others[np.searchsorted(others, run)]
    split = (stop > run) & (stop < ends)
    closes = np.zeros(256, dtype=bool)
    closes[list(closers)] = True
    split[split] = closes[data[stop[split]]]
    plain = split | (stop > run) & (stop >= ends)
    if keep:
        plain &= data[starts] == 0x20
    plain = np.concatenate((plain, np.zeros(int(split.sum()), dtype=bool)))
    starts = np.concatenate((starts, stop[split]))
    ends = np.concatenate((ends, ends[split]))
    ends[: len(split)][split] = stop[split]
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order], plain[order]


def cut(texts: list[str], separators: bytes, keep: bool, closers: bytes = CLOSERS, runs: bool = True) -> Pieces:
    """The pieces of texts of ``SLICE`` bytes or less altogether (or of one text of any size)."""
    encoded = [t.encode() for t in texts]
    sizes = np.array([len(t) for t in encoded])
    buffer = b"".join(encoded)
    data = np.frombuffer(buffer, dtype=np.uint8)
    if not len(data):
        return Pieces([], np.empty(0, bool), np.empty(0, np.int64), np.zeros(len(texts), np.int64))
    first = np.cumsum(sizes) - sizes
    starts, ends, plain = _bounds(data, first[sizes > 0], separators, keep, closers, runs)
    counts = np.diff(np.searchsorted(starts, np.append(first, len(data))))
    if len(data) > SLICE:  # the powers don't reach
        words = [buffer[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        which = np.array([number[w] for w in words], dtype=np.int64)
        flags = np.zeros(len(number), dtype=bool)
        flags[which] = plain
        return Pieces(list(number), flags, which, counts)
    hashes = []
    size = SLICE if len(data) > SMALL else SMALL
    for power in _both_powers(size):
        values = data.astype(_U)
        values += _U(1)
        values *= power[: len(data)]
        sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(values, out=sums[1:])
        # As if every piece began at the same, the last place.
        hashes.append(mix((sums[ends] - sums[starts]) * power[size - 1 - starts] + (ends - starts).astype(_U)))
    _, at, which = np.unique(hashes[0], return_index=True, return_inverse=True)
    if not np.array_equal(hashes[1], hashes[1][at][which]):  # two pieces of equal first hash: tell them apart by both
        _, at, which = np.unique(np.stack(hashes, axis=1), axis=0, return_index=True, return_inverse=True)
    distinct = [buffer[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())]
    return Pieces(distinct, plain[at], which.reshape(-1), counts)
