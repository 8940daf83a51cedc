"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice of a text has a node between any two characters and an edge for every piece. A unigram model takes the path
of the best score. A BPE model has one valid path to every node: the one whose neighbouring pieces would not have merged
otherwise, which is asked of pairs of pieces only. Either way a node keeps one backpointer, edges reach at most the
longest piece ahead, and so the search holds the nodes of that window and those behind it that are not committed: ids
are committed up to the boundary on which the backpointers of all open nodes converge.

The normalizer is the model's own, in the library. Words, the stretches between two boundaries that no piece can cross,
are remembered in a bounded table.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import cuts
from .store import text_or_empty, type_of
from .tokens import Remembered, slices

SPACE = "▁"
#: Words and ids remembered by a worker, in bytes.
CACHE_BYTES = 128 << 20
#: Open nodes after which the search looks for the boundary they share.
COMMIT_EVERY = 64

_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5
_UNIGRAM, _BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message; fixed fields come as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


class Model:
    """Pieces, scores and kinds of a model file."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.pieces, self.scores, self.kinds, self.algorithm = [], [], [], _UNIGRAM
        for number, value in _fields(data):
            if number == 1:
                piece = {1: b"", 2: b"\0\0\0\0", 3: _NORMAL, **dict(_fields(value))}
                self.pieces.append(piece[1].decode())
                self.scores.append(float(np.frombuffer(piece[2], "<f4")[0]))
                self.kinds.append(piece[3])
            elif number == 2:
                self.algorithm = dict(_fields(value)).get(3, _UNIGRAM)
        if self.algorithm not in (_UNIGRAM, _BPE) or _USER in self.kinds or _UNUSED in self.kinds:
            raise ValueError("only unigram and BPE models without user-defined and unused pieces")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == _NORMAL}
        self.longest = max(map(len, self.ids), default=1)
        #: Score of an unknown character, as in the library.
        self.unknown_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10
        self.unknown = self.kinds.index(_UNKNOWN)
        byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == _BYTE}
        self.bytes = [byte[b] for b in range(256)] if len(byte) == 256 else None
        #: Ids of pieces; for what only begins a piece, -2 less the id of the longest piece it begins with itself, or -1.
        self.edges = {p[:n]: -1 for p in self.ids for n in range(1, len(p))} | self.ids
        #: Of each piece, the next shorter one that it begins with, or -1.
        self.shorter = [-1] * len(self.pieces)
        for p in sorted(self.edges, key=len):
            before, own = self.edges.get(p[:-1], -1), self.edges[p]
            before = before if before >= -1 else -2 - before
            if own >= 0:
                self.shorter[own] = before
            elif before >= 0:
                self.edges[p] = -2 - before
        self.lengths = list(map(len, self.pieces))
        # No piece crosses from another character to a space: words are independent.
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        # An unknown character is in no piece either.
        self.deep = self.algorithm == _BPE and all(c in self.ids for p in self.ids for c in p)
        self.pairs: dict[int, bool] = {}
        self._splits: dict[int, tuple[int, int] | None] = {}

    def _split(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes ``piece``, None for a character; (-1, -1) if merging ends in other pieces."""
        known = self._splits.get(piece, 0)
        if known == 0:
            parts, last = list(self.pieces[piece]), None
            while len(parts) > 1:
                found = [(-self.scores[i], n) for n in range(len(parts) - 1) if (i := self.ids.get(parts[n] + parts[n + 1])) is not None]
                if not found:
                    last = (-1, -1)
                    break
                at = min(found)[1]  # best score, leftmost among equals
                last = (self.ids[parts[at]], self.ids[parts[at + 1]])
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self._splits[piece] = last
        return known

    def stays(self, left: int, right: int) -> bool:
        """Whether the merges of ``left + right`` give just these two pieces; ``left`` -1 asks for ``right`` alone.

        Goes back in time over the merges that made the two: at every moment the pieces that then met at the boundary must
        not have been the better merge.
        """
        key = left * 0x100000 + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 400_000:
                self.pairs.clear()
            known = self.pairs[key] = self._meets(left, right)
        return known

    def _meets(self, left: int, right: int) -> bool:
        if self._split(right) == (-1, -1):
            return False
        if left < 0:
            return True
        pieces, scores = self.pieces, self.scores
        undone = float("-inf")  # score of the merge that is undone: it must beat the one across the boundary
        strict = False  # a merge on the left of the boundary goes first among equals, one on its right does not
        while True:
            across = self.ids.get(pieces[left] + pieces[right])
            if across is not None and (scores[across] > undone or strict and scores[across] == undone):
                return False
            a, b = self._split(left), self._split(right)
            if a is None and b is None:
                return True
            # Of two equal scores the left one was merged first, so the right one is undone first.
            if b is None or a is not None and scores[left] < scores[right]:
                undone, strict, left = scores[left], False, a[1]
            else:
                undone, strict, right = scores[right], True, b[0]

class StreamingViterbi:
    """``feed`` normalized text in any slices, then ``finish``; both return the ids that are certain by then."""

    def __init__(self, model: Model):
        self.model, self.text = model, ""
        #: By node from ``text``'s start: (score, piece, node before). Piece -1 begins the path, -2 is an unknown character.
        self.nodes: dict[int, tuple[float, int, int]] = {0: (0.0, -1, -1)}
        self.at = 0
        self.after_unknown = False

    def _ids(self, node: int) -> list[int]:
        """The ids on the way to ``node``."""
        model, nodes, parts = self.model, self.nodes, []
        while node > 0:
            _, piece, node = nodes[node]
            parts.append(piece if piece != -2 else -2 - node)
        ids: list[int] = []
        for piece in reversed(parts):
            if piece >= 0:
                ids.append(piece)
            elif model.bytes:
                ids += [model.bytes[b] for b in self.text[-2 - piece].encode()]
            elif not self.after_unknown:  # a run of unknown characters is one id
                ids.append(model.unknown)
            self.after_unknown = piece < 0
        return ids

    def _commit(self, node: int) -> list[int]:
        """The ids on the way to ``node``, which becomes the start."""
        ids, last = self._ids(node), self.nodes[node]
        self.nodes = {k - node: (s - last[0], p, b - node) for k, (s, p, b) in self.nodes.items() if k > node}
        # The piece before the start still decides which pieces may follow it.
        self.nodes[0] = (0.0, last[1], -1)
        self.text, self.at = self.text[node:], self.at - node
        return ids

    def _shared(self) -> int:
        """The boundary on which the paths of all open nodes converge."""
        open_ = {k for k in self.nodes if k >= self.at}
        while len(open_) > 1:
            last = max(open_)
            open_.remove(last)
            open_.add(max(self.nodes[last][2], 0))
        return open_.pop()

    def _run(self, stop: int, safe: int) -> list[int]:
        """Lay all edges from the nodes before ``safe``, which no open edge can improve any more."""
        model, text, nodes, ids = self.model, self.text, self.nodes, []
        edge, known, longest, unigram = model.edges.get, model.pairs.get, model.longest, model.algorithm == _UNIGRAM
        at = self.at
        while at < safe:
            here = nodes.get(at)
            if here is not None:  # else no path comes here
                score, left, _ = here
                left, single = max(left, -1), False
                for end in range(at + 1, min(stop, at + longest) + 1):
                    piece = edge(text[at:end])
                    if piece is None:
                        break
                    if piece < 0:
                        continue
                    if unigram:
                        single |= end == at + 1
                        reached = score + model.scores[piece]
                        if end not in nodes or reached > nodes[end][0]:
                            nodes[end] = (reached, piece, at)
                    elif end not in nodes:
                        stays = known(left * 0x100000 + piece)
                        if model.stays(left, piece) if stays is None else stays:
                            nodes[end] = (0.0, piece, at)
                if not single and (unigram or text[at] not in model.ids):
                    reached = score + model.unknown_score
                    if at + 1 not in nodes or unigram and reached > nodes[at + 1][0]:
                        nodes[at + 1] = (reached, -2, at)
            at += 1
            if at % COMMIT_EVERY == 0:
                self.at = at
                if (node := self._shared()) > 0:
                    ids += self._commit(node)
                    stop, safe, at, text, nodes = stop - node, safe - node, self.at, self.text, self.nodes
        self.at = at
        return ids

    def feed(self, text: str) -> list[int]:
        self.text += text
        return self._run(len(self.text), len(self.text) - self.model.longest)

    def _deep(self) -> bool:
        """Lay the edges depth first, longest first: a node that is off the path is seldom reached, and nodes that lead
        nowhere are not tried again. For BPE, where a node's one path needs no comparing; False if no path came to the end."""
        model, text, nodes = self.model, self.text, self.nodes
        edge, known, stays, shorter, lengths = model.edges.get, model.pairs.get, model.stays, model.shorter, model.lengths
        way: list[tuple[int, int, int]] = []  # nodes on the way, the pieces before them, and the next pieces to try
        at, left, size = 0, max(nodes[0][1], -1), len(text)
        while at < size:
            # What begins a piece begins one with fewer characters, too: look around the usual length.
            stop = min(at + 4, size)
            piece = edge(text[at:stop])
            if piece is None:
                while piece is None and stop > at + 1:
                    stop -= 1
                    piece = edge(text[at:stop])
            else:
                while stop < size and (more := edge(text[at : stop + 1])) is not None:
                    piece = more
                    stop += 1
            if piece is None:
                piece, end = -2, at + 1
                nodes[end] = (0.0, piece, at)
            else:
                piece = piece if piece >= -1 else -2 - piece
                while True:
                    while piece >= 0:
                        end = at + lengths[piece]
                        if end not in nodes:  # else the way from there is a dead end
                            valid = known(left * 0x100000 + piece)
                            if stays(left, piece) if valid is None else valid:
                                break
                        piece = shorter[piece]
                    if piece >= 0:
                        break
                    if not way:
                        return False
                    at, left, piece = way.pop()
                nodes[end] = (0.0, piece, at)
                way.append((at, left, shorter[piece]))
            at, left = end, max(piece, -1)
        return True

    def finish(self, text: str = "") -> list[int]:
        """The rest of the ids, ``text`` being the last slice."""
        self.text += text
        size = len(self.text)
        # Nothing this short is committed on the way.
        if len(self.nodes) > 1 or size > COMMIT_EVERY or not self.model.deep or not self._deep():
            ids = self._run(size, size)
            return ids + self._ids(len(self.text))
        return self._ids(size)


class PieceCodec:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.model = model = Model(file.read())
        # A line end that is in no piece takes part in no merge: it separates as spaces do.
        self.separators = b" \n" if not any("\n" in p for p in model.ids) else b" "
        # Nor do words merge with what follows them, where no piece holds a letter and then this character.
        joined = {b for p in model.ids for a, b in zip(p, p[1:]) if re.match("[A-Za-zÀ-ÖØ-öø-ÿ]", a)}
        self.closers = bytes(c for c in range(128) if chr(c) not in joined and not chr(c).isalpha())
        self.cut_at = re.compile("(?<=[^ ]) (?=[^ ])")
        self.known = Remembered("<i4")
        spell = lambda p, k: b"" if k == _CONTROL else bytes([int(p[3:5], 16)]) if k == _BYTE else p.replace(SPACE, " ").encode()
        spelled = [spell(p, k) for p, k in zip(model.pieces, model.kinds)]
        spelled[model.unknown] = " ⁇ ".encode()
        self.spelled, self.size = np.frombuffer(b"".join(spelled), np.uint8), np.array([len(s) for s in spelled])
        self.start = np.cumsum(self.size) - self.size
        self.dummy_prefix = model.processor.normalize("a").startswith(SPACE)

    def search(self, normalized: str, slice_chars: int = 4096) -> list[int]:
        search, ids = StreamingViterbi(self.model), []
        if len(normalized) <= COMMIT_EVERY:
            return search.finish(normalized)
        for at in range(0, len(normalized), slice_chars):
            ids += search.feed(normalized[at : at + slice_chars])
        return ids + search.finish()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; those of the library's encoder."""
        normalized = self.model.processor.normalize(texts) if texts else []
        if not self.model.by_word or self.model.bytes is None:
            return [np.array(self.search(t), dtype="<i4") for t in normalized]
        if self.known.bytes > CACHE_BYTES:
            self.known = Remembered("<i4")
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for group in slices([t.replace(SPACE, " ") for t in normalized], self.cut_at, cuts.SMALL):
            words = cuts.cut([part for _, part in group], self.separators, True, self.closers, runs=False)
            rows = self.known.rows
            if new := [w for w in words.distinct if w not in rows]:
                found = [self.search(w.decode().replace(" ", SPACE)) for w in new]
                flat = np.array([i for ids in found for i in ids], dtype="<i4")
                self.known.add(new, flat, np.array([len(ids) for ids in found]))
            row = np.fromiter(map(rows.__getitem__, words.distinct), np.int64, len(words.distinct))
            ids, ends = self.known.gather(row[words.which])
            last = np.append(0, ends)[np.cumsum(words.counts)].tolist()
            for (i, _), a, b in zip(group, [0, *last[:-1]], last):
                parts[i].append(ids[a:b])
        return [p[0] if len(p) == 1 else np.concatenate(p) for p in parts]

    def _bytes(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        shift = np.repeat(self.start[ids] - (np.cumsum(size) - size), size)
        return self.spelled[shift + np.arange(len(shift))].tobytes()

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of ``counts`` ids each; bytes that are no UTF-8 become U+FFFD, control ids nothing."""
        # Only so many at a time: one text may have any number.
        spelled = b"".join(self._bytes(ids[at : at + (1 << 17)]) for at in range(0, len(ids), 1 << 17))
        stops = np.append(0, np.cumsum(self.size[ids]))[np.append(0, np.cumsum(counts))].tolist()
        texts = [spelled[a:b].decode(errors="replace").replace(SPACE, " ") for a, b in zip(stops, stops[1:])]
        return [t[1:] if self.dummy_prefix and t.startswith(" ") else t for t in texts]

    def decode(self, ids: Iterable[int]) -> str:
        ids = np.fromiter(ids, np.int64)
        return self.decode_all(ids, np.array([len(ids)]))[0]


@lru_cache(maxsize=2)
def codec(name: str) -> PieceCodec:
    """The codec of a model file, by its public name or its path; kept while the worker lives."""
    return PieceCodec(name if os.path.isabs(name) else public_tokenizers.path(name))


def encode(df: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids`` (array of int) of every row's whole text; null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = one.encode(part.column(1).to_pylist())
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[id_col, "ids"])

    texts = df.select(F.col(id_col), text_or_empty(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"`{id_col}` {type_of(df, id_col)}, ids array<int>")


def decode(df: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, ids, text`` of every row's ids; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                counts = pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy(zero_copy_only=False)
                ids = part.column(1).flatten().to_numpy(zero_copy_only=False)
                texts = pa.array(one.decode_all(ids, counts), type=pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[id_col, "ids", "text"])

    ids = df.select(F.col(id_col), F.col(ids_col).cast("array<int>").alias("ids"))
    return ids.mapInArrow(run, f"`{id_col}` {type_of(df, id_col)}, ids array<int>, text string")
