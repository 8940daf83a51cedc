"""Token ids of whole texts with the tokenizers library, each distinct piece of text encoded once per worker.

A text is cut only where the vocabulary's own pre-tokenizer always cuts, so the ids of the pieces, one after another, are
the ids of the text. Pieces are remembered in a bounded table; new ones go to the library together, and plain words as
one text whose ids are dealt back by their lengths.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers

from . import cuts

_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Bytes of remembered ids and pieces after which a worker starts afresh.
CACHE_BYTES = 192 << 20


class Remembered:
    """Ids by piece, in one array: ``find`` gives the row of each piece, ``gather`` the ids of rows, one after another."""

    def __init__(self, dtype: str):
        self.rows: dict[bytes, int] = {}
        self.dtype, self.bytes = dtype, 0
        self.ids, self.start, self.size = np.empty(1 << 16, dtype), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int32)
        self.used = 0

    def add(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        """``ids`` holds ``sizes[i]`` ids for each new piece in turn."""
        first, count = len(self.rows), len(pieces)
        while len(self.ids) < self.used + len(ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        while len(self.start) < first + count:
            self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
        self.ids[self.used : self.used + len(ids)] = ids
        self.size[first : first + count] = sizes
        self.start[first : first + count] = self.used + np.cumsum(sizes) - sizes
        self.rows.update(zip(pieces, range(first, first + count)))
        self.used += len(ids)
        self.bytes += 160 * count + sum(map(len, pieces)) + ids.nbytes

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``rows``, and where those of each row end."""
        size = self.size[rows].astype(np.int64)
        ends = np.cumsum(size)
        shift = np.repeat(self.start[rows] - (ends - size), size)
        return self.ids[shift + np.arange(len(shift))], ends


def slices(texts: list[str], at: re.Pattern, limit: int = cuts.SLICE) -> Iterator[list[tuple[int, str]]]:
    """Groups of ``(text number, stretch)`` of at most ``limit`` bytes; long texts are cut before a match of ``at``.

    A stretch without a match comes whole, however long.
    """
    held, size = [], 0
    for i, text in enumerate(texts):
        start = 0
        while True:
            found = at.search(text, start + limit // 4) if len(text) - start > limit // 4 else None
            part = text[start : found.start()] if found else text[start:]
            need = len(part.encode()) if not part.isascii() else len(part)
            if held and size + need > limit:
                yield held
                held, size = [], 0
            held.append((i, part))
            size += need
            if not found:
                break
            start = found.start()
    if held:
        yield held


class PieceEncoder:
    """Ids as 16-bit values. A byte-level vocabulary is cut before a space or newline and a letter, one with word ends at
    every space and newline, which it drops."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        if max(vocabulary.values()) > 0xFFFF:
            raise ValueError("ids of more than 16 bits")
        names = [""] * (max(vocabulary.values()) + 1)
        for name, i in vocabulary.items():
            names[i] = name
        self.word = any(n.endswith("</w>") for n in names)
        # What the ids of a plain word add up to: its one word end, or its bytes (a character of the name each).
        self.weight = np.array([n.endswith("</w>") if self.word else len(n) for n in names], dtype=np.int64)
        self.cut_at = re.compile("[ \n]" if self.word else f"[ \n](?=[{_LATIN}])")
        self.known = Remembered("<u2")

    def _learn(self, plain: list[bytes], others: list[bytes]) -> None:
        """Plain words go in as one text, as whose parts they are cut alike; their ids are told apart by what ids stand for."""
        if plain:
            joined = (b" " if self.word else b"").join(plain).decode()
            encoding = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0]
            ids = np.array(encoding.ids, dtype="<u2")
            done = np.cumsum(self.weight[ids])
            ends = np.arange(1, len(plain) + 1) if self.word else np.cumsum([len(p) for p in plain])
            stops = np.searchsorted(done, ends) + 1
            if stops[-1] != len(ids) or not np.array_equal(done[stops - 1], ends):
                raise ValueError("the vocabulary cuts words in another way")
            self.known.add(plain, ids, np.diff(stops, prepend=0))
        if others:
            texts = [p.decode() for p in others]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            flat = np.array([i for ids in found for i in ids], dtype="<u2")
            self.known.add(others, flat, np.array([len(ids) for ids in found]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.known.bytes > CACHE_BYTES:
            self.known = Remembered("<u2")
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for group in slices(texts, self.cut_at):
            pieces = cuts.cut([part for _, part in group], b" \n", keep=not self.word)
            rows, distinct = self.known.rows, pieces.distinct
            if new := [i for i, p in enumerate(distinct) if p not in rows]:
                plain = pieces.plain[new].tolist()
                self._learn([distinct[i] for i, p in zip(new, plain) if p], [distinct[i] for i, p in zip(new, plain) if not p])
            row = np.fromiter(map(rows.__getitem__, distinct), np.int64, len(distinct))
            ids, ends = self.known.gather(row[pieces.which])
            last = np.append(0, ends)[np.cumsum(pieces.counts)]
            for (i, _), a, b in zip(group, np.append(0, last[:-1]).tolist(), last.tolist()):
                parts[i].append(ids[a:b])
        return [p[0] if len(p) == 1 else np.concatenate(p) for p in parts]


@lru_cache(maxsize=2)
def encoder(name: str) -> PieceEncoder:
    """The encoder of a vocabulary file, by its public name or its path; kept while the worker lives."""
    return PieceEncoder(name if os.path.isabs(name) else public_tokenizers.path(name))


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
