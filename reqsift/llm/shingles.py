"""Word shingles as sets of 64-bit hashes, and SuperMinHash signatures of such sets (numpy, inside tasks).

Words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z. All work is on UTF-8 bytes in slices of bounded
size, so memory follows the number of words of one text, not its temporaries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

_SLICE = 1 << 19
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64) -> np.ndarray:
    out = np.full(_SLICE + 1, base, dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER, _BACK = _powers(_BASE), _powers(_INVERSE)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit over the output."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _slices(text: bytes) -> Iterator[bytes]:
    """Pieces of at most ``_SLICE`` bytes that end between words; a longer single word comes whole."""
    start = 0
    while len(text) - start > _SLICE:
        cut = max(text.rfind(c, start, start + _SLICE) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut < start:
            cut = start + _SLICE - 1
            while cut + 1 < len(text) and _IS_WORD[text[cut]]:
                cut += 1
        yield text[start : cut + 1]
        start = cut + 1
    yield text[start:]


def _word_hashes_of(piece: bytes) -> np.ndarray:
    data = _LOWER[np.frombuffer(piece, dtype=np.uint8)]
    inside = _IS_WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=_U)
    if len(data) > _SLICE:  # one huge word, or one with a little around it
        digests = (hashlib.blake2b(data[s:e].tobytes(), digest_size=8).digest() for s, e in zip(starts, ends))
        return np.frombuffer(b"".join(digests), dtype="<u8").astype(_U)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum((data.astype(_U) + _U(1)) * _POWER[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _BACK[starts] + (ends - starts).astype(_U))


def word_hashes(text: str | None) -> np.ndarray:
    """One hash per word, in order."""
    parts = [_word_hashes_of(p) for p in _slices((text or "").encode())]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct shingles of ``width`` words; the whole sequence as one when there are fewer words."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = max(len(words) - width + 1, 1)
    out = np.full(n, min(width, len(words)), dtype=_U)
    for i in range(min(width, len(words))):
        out = mix(out * _BASE + words[i : i + n])
    return np.unique(out)


def super_minhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash signatures, one row per non-empty set: uint64 values, the rank in the high 32 bits.

    Every element walks its own random permutation of the slots; step ``j`` offers the value ``j + r`` with a random
    fraction ``r`` to the slot the permutation has at ``j``, and a slot keeps its minimum. A set is done, and its elements
    stop, once no slot can get a smaller value: all slots hold a rank of at most ``j``.
    """
    sizes = np.array([len(s) for s in sets])
    signature = np.full((len(sets), slots), np.iinfo(np.uint64).max, dtype=_U)
    flat = signature.reshape(-1)
    element = np.concatenate(sets) if sets else np.empty(0, _U)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = None
    for j in range(slots):
        draw = mix(element + _U(int(_BASE) * (j + 1) % (1 << 64)))
        pick = j + (((draw & _U(0xFFFFFFFF)) * _U(slots - j)) >> _U(32)).astype(np.int64)
        if order is None:
            slot = pick
        else:
            rows = np.arange(len(element))
            slot = order[rows, pick]
            order[rows, pick] = order[:, j]
        np.minimum.at(flat, owner * slots + slot, (_U(j) << _U(32)) | (draw >> _U(32)))
        done = signature.max(axis=1) < (_U(j + 1) << _U(32))
        going = ~done[owner]
        if not going.any():
            break
        if order is None:
            first = pick[going]
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(first), 1))
            order[np.arange(len(first)), first] = 0
        elif not going.all():
            order = order[going]
        element, owner = element[going], owner[going]
    return signature


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per set and band of ``rows`` slots; the band number is part of the key."""
    sets, slots = signature.shape
    bands = slots // rows
    key = np.tile(np.arange(1, bands + 1, dtype=_U), (sets, 1))
    parts = signature[:, : bands * rows].reshape(sets, bands, rows)
    for i in range(rows):
        key = mix(key * _BASE + parts[:, :, i])
    return key.view(np.int64)


def sketch(signature: np.ndarray) -> np.ndarray:
    """One byte per slot: enough to estimate the similarity of two sets."""
    return (mix(signature) & _U(0xFF)).astype(np.uint8)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """``100 * |intersection| >= percent * |union|`` on the full sets, in integers."""
    if not len(a) or not len(b):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)
